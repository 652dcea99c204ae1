"""Session settings the jobs are designed for.

On a cluster also set ``spark.checkpoint.dir`` to shared storage and
``spark.sql.shuffle.partitions`` to the largest shuffle in bytes divided by about
200 MB: adaptive execution merges partitions that turn out small, but only splits
those of skewed joins.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Re-plan on measured sizes: broadcast what turned out small, merge small
    # partitions, split partitions of hot join keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: int, name: str = "bazaarlens", **settings: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
