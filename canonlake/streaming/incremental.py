"""Incremental ingestion: new payload files only, upserted batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from canonlake.operators import algebra


def run_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> int:
    """Runs a stream over what there is now and stops; returns the micro-batches. ``write`` must be idempotent: a batch may come again after a crash."""
    batches = 0

    def each(batch: DataFrame, number: int) -> None:
        nonlocal batches
        batches += 1
        write(batch, number)

    stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start().awaitTermination()
    return batches


def run_counted(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append") -> dict[str, int]:
    """As ``run_available``, and tells the micro-batches, the rows that state holds at the end and those that came behind the watermark and were left out."""
    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(write).start()
    query.awaitTermination()
    steps = [p for p in query.recentProgress if p["stateOperators"]]
    late = sum(o["numRowsDroppedByWatermark"] for p in steps for o in p["stateOperators"])
    return {"batches": len(query.recentProgress), "late": late, "held": sum(o["numRowsTotal"] for o in steps[-1]["stateOperators"]) if steps else 0}


def new_files(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", per_batch: int = 25) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_batch).load(path)


def latest_upsert(store, table: str, keys: list[str], order: str, partition: dict[str, str], buckets: int = 16) -> Callable[[DataFrame, int], None]:
    """A writer that keeps the latest row of each key by ``order``, so batches may come in any order and more than once.

    Rows lie in ``buckets`` by hash of their key. A batch reads and rewrites only the buckets that it hits, in one job;
    their number is fixed, so a large table takes more of them.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string"))
        for name, value in partition.items():
            rows = rows.withColumn(name, F.lit(value))
        rows = store.staged(rows)
        hit = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most ``buckets`` names
        if hit:
            same = F.col("bucket").isin(hit)
            for name, value in partition.items():
                same = same & (F.col(name) == value)
            both = rows.unionByName(store.read_table(table).where(same), allowMissingColumns=True) if store.exists(table) else rows
            store.write_partitioned(table, store.staged(algebra.latest_per_key(both, keys, [F.col(order)])), [*partition, "bucket"])
        store.sweep()

    return write


def identities_then_points(store, identities: Callable[[DataFrame], DataFrame], points: Callable[[DataFrame], DataFrame], partition: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """A writer that stores who is who before what they scored: a crash in between leaves no points without a name, and the marker of a round is its points."""

    def write(batch: DataFrame, number: int) -> None:
        store.upsert("biwenger_players_history", identities(batch), ["id"], partition)
        store.upsert("fantasy_round_points", points(batch), ["round_id"], partition)

    return write


def matched(calendar: DataFrame, sheets: DataFrame, keys: list[str], start: str, at: str, within: str, late: str) -> DataFrame:
    """``calendar`` with the rows of ``sheets`` of the same keys that came from ``start`` on, up to ``within`` after it; without any, a row of nulls.

    Both may be streams, in files of any order: each waits in state for the other, no longer than it can still be met. A match without a sheet comes out when the watermark, ``late`` behind the
    newest row of the slower stream, has passed its time; rows behind the watermark are left out and counted by ``run_counted``. State lies in the checkpoint, so a
    restart goes on where it was. Two tables instead of streams give the same rows at once. Rows whose keys or times are null meet nothing.
    """
    left, right = calendar, sheets.withColumnsRenamed({c: f"__{c}" for c in [*keys, at]})
    if left.isStreaming:
        left, right = left.withWatermark(start, late), right.withWatermark(f"__{at}", late)
    same = (F.col(f"__{at}") >= F.col(start)) & (F.col(f"__{at}") <= F.col(start) + F.expr(f"INTERVAL {within}"))
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    clash = set(left.columns) & {c for c in right.columns}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    return left.join(right, same, "left_outer").drop(*[f"__{k}" for k in keys]).withColumnRenamed(f"__{at}", at)


def once(stream: DataFrame, keys: list[str], at: str, late: str) -> DataFrame:
    """Each key once, however often it comes within ``late``: a batch that is delivered twice, or a payload that is stored twice, changes nothing downstream.

    Keys wait in state until the watermark has passed them. A table has its duplicates dropped likewise, all of them.
    """
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys) if stream.isStreaming else stream.dropDuplicates(keys)


def windowed_counts(events: DataFrame, every: str = "1 day", late: str = "1 day", slide: str | None = None) -> DataFrame:
    """Counts and sums of (ts, event_type, value) by window and type, with late rows up to the watermark; windows overlap if they begin every ``slide``."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    return marked.groupBy(F.window("ts", every, slide).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("begin"), "event_type", "n", "total")
