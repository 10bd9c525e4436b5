"""Session settings that the table algebra and the date logic depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Wall-clock independent dates, untouched partitions on overwrite, path columns as strings.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build(master: str | None = None, app: str = "canonlake", **extra: str) -> SparkSession:
    """A session with SETTINGS; ``master`` only for local use, a cluster gives its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | extra).getOrCreate()
