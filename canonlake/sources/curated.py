"""Silver layer: named Parquet tables with Hive partitions, and writes that change them key by key."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canonlake.operators import algebra
from canonlake.sources.raw import base_uri


class CuratedStore:
    """Tables at ``curated/{table}/{key=value}/``. Partition values are text, in the path and when read back.

    Every write that depends on the stored rows is staged beside the table and moved in afterwards, so that
    a table is never overwritten while it is read. A note of each move is written first and deleted last; opening the store
    ends or undoes what a crash left half done, so the rows are the old or the new ones, never none. One process writes at a
    time. Only partitions that a write names are touched.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self._stages = spark, base_uri(base), []
        self._recover()

    def path(self, table: str, partition: dict[str, str] | None = None) -> str:
        steps = "".join(f"/{k}={v}" for k, v in (partition or {}).items())
        return f"{self.base}/curated/{table}{steps}"

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, table: str, partition: dict[str, str] | None = None) -> bool:
        where, files = self._at(self.path(table, partition))
        return files.exists(where)

    def read_table(self, table: str) -> DataFrame:
        """All partitions, with the columns of any of them and path columns as text."""
        if not self.exists(table):
            raise FileNotFoundError(f"no curated table {table}")
        # text path columns whatever the session says, so that "07" stays "07"
        key = "spark.sql.sources.partitionColumnTypeInference.enabled"
        before = self.spark.conf.get(key, "true")
        self.spark.conf.set(key, "false")
        try:
            return self.spark.read.option("mergeSchema", "true").parquet(self.path(table))
        finally:
            self.spark.conf.set(key, before)

    def read_tolerant(self, table: str, columns: dict[str, str]) -> DataFrame:
        """The named columns (name to type): a missing table has no rows, a missing column is null."""
        if not self.exists(table):
            return self.spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in columns.items()))
        found = self.read_table(table)
        return found.select(*[(F.col(c) if c in found.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])

    def read_partition(self, table: str, partition: dict[str, str]) -> DataFrame | None:
        """The rows of one partition without path columns; None if it is missing."""
        return self.spark.read.option("mergeSchema", "true").parquet(self.path(table, partition)) if self.exists(table, partition) else None

    def distinct_values(self, table: str, column: str, partition: dict[str, str]) -> set:
        """The non-null values of a partition, for small key sets that a driver loop needs."""
        found = self.read_partition(table, partition)
        return set() if found is None else {r[0] for r in algebra.distinct_values(found, column).toLocalIterator()}

    def staged(self, df: DataFrame) -> DataFrame:
        """``df`` written once beside the tables and read back: what follows starts from rows, not from a long plan. ``sweep`` removes it."""
        path = f"{self.base}/curated/_staging-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self._stages.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def sweep(self) -> None:
        for path in self._stages:
            where, files = self._at(path)
            files.delete(where, True)
        self._stages.clear()

    def _swap(self, df: DataFrame, target: str) -> None:
        """Stages ``df``, notes the move, moves ``target`` aside, puts the new rows in its place, drops the old ones and the note."""
        name = uuid.uuid4().hex
        df.write.parquet(f"{self.base}/curated/_staging-{name}")
        note, files = self._at(f"{self.base}/curated/_moves/{name}")
        out = files.create(note, True)
        try:
            out.write(bytearray(target.encode()))
        finally:
            out.close()
        self._finish(name, target)

    def _finish(self, name: str, target: str) -> None:
        """The steps of a move that are still to do; each may have been the last before a crash."""
        new, files = self._at(f"{self.base}/curated/_staging-{name}")
        aside, _ = self._at(f"{self.base}/curated/_staging-{name}-old")
        old, _ = self._at(target)
        note, _ = self._at(f"{self.base}/curated/_moves/{name}")
        if files.exists(new):
            files.mkdirs(old.getParent())
            if files.exists(old):
                if files.exists(aside):
                    raise OSError(f"{target} and its old rows in {aside} are both there")
                if not files.rename(old, aside):
                    raise OSError(f"could not move {target} aside")
            if not files.rename(new, old):
                raise OSError(f"could not move {new} to {target}; the old rows are in {aside}")
        files.delete(aside, True)
        files.delete(note, False)

    def _recover(self) -> None:
        """Ends the moves that have a note: their new rows were complete before it was written."""
        notes, files = self._at(f"{self.base}/curated/_moves")
        if not files.exists(notes):
            return
        for status in files.listStatus(notes):
            name = status.getPath().getName()
            if name.endswith(".crc") or name.startswith("."):
                continue
            source = files.open(status.getPath())
            try:
                target = bytes(b & 0xFF for b in source.readAllBytes()).decode()
            finally:
                source.close()
            if target:
                self._finish(name, target)
            else:  # the note itself was cut off: nothing has moved
                files.delete(status.getPath(), False)

    def write_table(self, table: str, df: DataFrame, partition: dict[str, str] | None = None) -> None:
        """Overwrites one partition, or an unpartitioned table; an empty frame leaves it there and empty."""
        self._swap(df.drop(*(partition or {})), self.path(table, partition))

    def write_partitioned(self, table: str, df: DataFrame, keys: list[str]) -> None:
        """Overwrites each partition that ``df`` has rows for, in one job; others stay as they are. Without rows nothing is written, not even an empty table."""
        if df.isEmpty():
            return
        df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(self.path(table))

    def upsert(self, table: str, df: DataFrame, keys: list[str], partition: dict[str, str], touched: DataFrame | None = None) -> None:
        """Deletes the batch's keys from the partition, then appends the batch; null keys are equal."""
        batch, existing = df.drop(*partition), self.read_partition(table, partition)
        self.write_table(table, batch if existing is None else algebra.keyed_replace(existing, batch, keys, touched), partition)

    def upsert_unique_partition(self, table: str, df: DataFrame, keys: list[str], partition: dict[str, str]) -> None:
        """As ``upsert``, and the batch's keys leave every other partition.

        The target is written first: a crash in between leaves a key twice, never nowhere, and the next
        run mends it. Only siblings that hold a key of the batch are rewritten; one may become empty and stays.
        """
        others = None
        if self.exists(table):
            whole = self.read_table(table)
            same = F.lit(True)
            for k, v in partition.items():
                same = same & (F.col(k) == v)
            hit = algebra.with_keys(whole.where(~same), df, keys).select(*partition).distinct()
            others = [r.asDict() for r in hit.collect()]  # names of partitions
        self.upsert(table, df, keys, partition)
        for sibling in others or []:
            self.write_table(table, algebra.without_keys(self.read_partition(table, sibling), df, keys), sibling)

    def retain_keys(self, table: str, keep: DataFrame, keys: list[str], partition: dict[str, str]) -> int:
        """Keeps the listed keys of a partition and returns how many rows went; nothing is rewritten if none does."""
        existing = self.read_partition(table, partition)
        if existing is None:
            return 0
        gone = algebra.without_keys(existing, keep, keys).count()
        if gone:
            self.write_table(table, algebra.with_keys(existing, keep, keys), partition)
        return gone

    def restamp(self, table: str, mapping: DataFrame, id_column: str, mapped_id: str, partition_keys: list[str], canonical: str = "canonical_id") -> int:
        """Recomputes canonical ids from ``mapping`` and rewrites only partitions in which one changed, all in one write; returns the rows of those."""
        if not self.exists(table):
            return 0
        whole = self.read_table(table)
        old = whole.withColumnRenamed(canonical, "__old") if canonical in whole.columns else whole.withColumn("__old", F.lit(None).cast("string"))
        new = self.staged(algebra.lookup(old, mapping, id_column, mapped_id, canonical, ""))
        changed = new.where(~F.coalesce("__old", F.lit("")).eqNullSafe(F.col(canonical))).select(*partition_keys).distinct()
        rows = self.staged(algebra.with_keys(new, changed, partition_keys).drop("__old"))
        rewritten = rows.count()
        if rewritten:
            self.write_partitioned(table, rows, partition_keys)
        return rewritten
