"""What several operators share: staged tables in the shared folder and ASCII-only lower case."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters x20 and x09 to x0D.
SPACES = " \t\n\x0b\f\r"
#: Settings while a table is staged: the shuffle files of a query go when it has ended, instead of when the driver next collects
#: garbage, and the texts of plans that the driver keeps for its listeners are cut, of which long chains of small steps make a great many.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxPlanStringLength": "10000"}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it; one of our own only on one machine, where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="canonlake-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/canonlake/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: it cuts lineage, survives lost
    executors, is computed once and gives the planner its true size. Shuffle files of the write go when it ends."""
    path, conf = new_path(df.sparkSession, label), df.sparkSession.conf
    before = {key: conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value) if value is not None else conf.unset(key)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def lookup(df: DataFrame, label: str, rows: int = 100_000) -> DataFrame:
    """A staged table that is broadcast into joins if it has at most ``rows`` rows, by count. A larger one is joined by
    its key as Spark sees fit, with skewed keys of the other side split."""
    table = staged(df, label)
    return F.broadcast(table) if table.count() <= rows else table


def lower_az(text: Column) -> Column:
    """Lower-case A-Z alone; ``lower`` does just that where every character is one byte."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]
