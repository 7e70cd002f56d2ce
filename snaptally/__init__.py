"""snaptally — statistics over dated dumps of JSON-lines tables, on PySpark.

Layout of a dump: ``{root}/{snapshot}/{table}/{part files}``. The library finds
the latest snapshot, lists its tables and files, and computes record counts and
sizes per table, path or file in one distributed pass; see ``README.md``.
"""

__version__ = "0.1.0"
