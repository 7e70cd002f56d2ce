"""End-to-end jobs and the acceptance queries."""
