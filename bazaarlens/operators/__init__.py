"""DataFrame operators Spark has no single call for, built from its own joins,
aggregates, range partitioning and windows."""
