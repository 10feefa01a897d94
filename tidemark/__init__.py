"""tidemark: change-data replication and validation on Spark DataFrames.

The package parses change-event envelopes, journals them, applies
creates/updates/deletes to current and archive tables with set-based
DataFrame operations, rebuilds versioned tables as of a point in time,
derives stream offsets and load watermarks from a control table, and
proves source and target equal by two-way multiset difference.
"""

from tidemark.spec import TableSpec  # noqa: F401
