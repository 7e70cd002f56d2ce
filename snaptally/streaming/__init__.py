"""Incremental (Structured Streaming) form of the table statistics."""

from snaptally.streaming.table_stats_stream import compact_table_stats, current_table_stats, record_sizes_stream, start_table_stats

__all__ = ["compact_table_stats", "current_table_stats", "record_sizes_stream", "start_table_stats"]
