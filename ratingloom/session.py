"""Session builder for scripts and tests; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "ratingloom",
    master: str | None = None,
    **settings: str,
) -> SparkSession:
    """Get or create a session with UTC dates; AQE sizes the shuffles.

    No shuffle partition count is fixed here: pass ``spark.sql.shuffle.partitions``
    (dots as double underscores) where a small machine wants fewer.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Column calls need no call-site capture, which costs a few round trips each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Split a hot join key even where that costs the next operator a shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
