"""boardwalk: a Spark-native engine for real-time transit feeds.

Feed snapshots are split into trip updates and vehicle status, parsed with
fixed schemas, joined on trip identity and turned into a trip board, which is
appended to Parquet or kept as the latest row per trip, and queried."""

__version__ = "0.1.0"
