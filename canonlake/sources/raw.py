"""Bronze layer: immutable payloads at ``raw/{source}/{dataset}/fecha_descarga=YYYY-MM-DD/{name}.{extension}``."""

from __future__ import annotations

import os
import re
import shutil
import time
import uuid
from datetime import UTC, date, datetime, timedelta
from itertools import islice
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The partition column of the layout, a fixed value of the format.
DOWNLOADED = "fecha_descarga"
DAY_FOLDER = re.compile(rf"{DOWNLOADED}=(\d{{4}}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]))")
#: What opening one payload counts for, in bytes, when files are shared out to tasks: payloads are small, and a task takes many.
OPEN_COST = 65_536
#: Files of a day in the index, at least, if it has as many payloads.
PARTS = 8
#: What a task that opens payloads holds at once, in names and in bytes, but for a larger payload.
HELD_NAMES, HELD_BYTES = 10_000, 8 << 20
#: A folder that changed less than this many seconds ago may change again without showing it.
SETTLED_S = 0.05


def base_uri(uri: str) -> str:
    """A validated base: ``file:`` paths, ``s3://bucket/prefix``, read through s3a, and the cluster's own file systems."""
    parsed = urlparse(uri)
    if parsed.scheme == "file":
        return f"file://{parsed.path}".rstrip("/")
    if parsed.scheme in ("s3", "s3a"):
        if not parsed.netloc:
            raise ValueError(f"no bucket in {uri}")
        return f"s3a://{parsed.netloc}{parsed.path}".rstrip("/")
    if parsed.scheme in ("hdfs", "viewfs"):
        return uri.rstrip("/")
    raise ValueError(f"unknown scheme in {uri}: file, s3, hdfs and viewfs are supported")


def _named(files: DataFrame) -> DataFrame:
    """(name, fecha_descarga, payload) of text files by their paths; the name is empty where the path has no date."""
    path, pattern = F.regexp_replace(F.col("_metadata.file_path"), "%20", " "), rf"/{DOWNLOADED}=(\d{{4}}-\d{{2}}-\d{{2}})/([^/]+)\.[^/.]+$"
    return files.select(F.regexp_extract(path, pattern, 2).alias("name"), F.try_to_date(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")), "yyyy-MM-dd").alias(DOWNLOADED), F.col("value").alias("payload"))


def _opened(days: DataFrame, folder: str, extension: str) -> DataFrame:
    """(name, fecha_descarga, payload, day, stamp) of the files in the dated folders of ``days`` (day, stamp), below a folder that all machines share. Tasks list them and open them, so
    no name passes through the driver. Hidden files are ignored, as Spark's scans do."""
    ending, names, held = f".{extension}".encode(), HELD_NAMES, HELD_BYTES

    def listed(batches):
        for day, stamp in (pair for batch in batches for pair in zip(batch["day"].to_pylist(), batch["stamp"].to_pylist(), strict=True)):
            with os.scandir(os.fsencode(f"{folder}/{DOWNLOADED}={day}")) as found:
                files = (f.name for f in found if f.name.endswith(ending) and len(f.name) > len(ending) and f.name[:1] not in (b".", b"_") and f.is_file())
                while some := list(islice(files, names)):
                    yield pa.RecordBatch.from_pydict({"day": [day] * len(some), "stamp": [stamp] * len(some), "file": pa.array(some, pa.binary())})

    def opened(batches):
        for batch in batches:
            begin, size, bodies = 0, 0, []
            for i, (day, name) in enumerate(zip(batch["day"].to_pylist(), batch["file"].to_pylist(), strict=True)):
                with open(os.path.join(os.fsencode(f"{folder}/{DOWNLOADED}={day}"), name), "rb") as file:
                    bodies.append(file.read())
                size += len(bodies[-1])
                if size >= held or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([*batch.slice(begin, len(bodies)).select(["day", "stamp", "file"]).columns, pa.array(bodies, pa.binary())], ["day", "stamp", "file", "body"])
                    begin, size, bodies = i + 1, 0, []

    files = days.mapInArrow(listed, "day string, stamp long, file binary").repartition("day", "file")
    rows = files.mapInArrow(opened, "day string, stamp long, file binary, body binary")
    name = F.col("file").cast("string")
    return rows.select(F.left(name, F.length(name) - len(ending)).alias("name"), F.to_date("day").alias(DOWNLOADED), F.col("body").cast("string").alias("payload"), "day", "stamp")


class RawStore:
    """Writes payloads as they come and reads the latest one of each name.

    Beside the payloads lies an index, ``index/{source}/{dataset}/{extension}``: a Parquet table of what the dated folders hold, payloads included, so that a job reads a few
    large files sorted by name instead of very many small ones. Before a read it is extended by the folders that are new or have changed, and by no others; each payload
    is opened once in its life. The index can be deleted at any time: the payloads are the truth, and the next read builds it anew.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base_uri(base)
        self._written: set[tuple[str, str, str]] = set()  # (source, dataset, day) that this store wrote to; days, not names

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def save(self, source: str, dataset: str, name: str, payload: bytes, extension: str = "json", day: date | None = None) -> str:
        """One payload, written beside its place and renamed into it; the day is today in UTC if not given."""
        day = day or datetime.now(UTC).date()
        key = f"{self.base}/raw/{source}/{dataset}/{DOWNLOADED}={day.isoformat()}/{name}.{extension}"
        final, files = self._files(key)
        part, _ = self._files(f"{key}.part")
        out = files.create(part, True)
        try:
            out.write(bytearray(payload))
        finally:
            out.close()
        # one step, also over a payload of the same day, so a reader sees the old one or the new one
        hadoop, gateway = self.spark._jvm.org.apache.hadoop.fs, self.spark.sparkContext._gateway
        rename = getattr(hadoop, "Options$Rename")
        options = gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        hadoop.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration()).rename(part, final, options)
        self._written.add((source, dataset, day.isoformat()))
        return key

    def save_all(self, source: str, dataset: str, payloads: DataFrame, extension: str = "json", day: date | None = None) -> None:
        """Many payloads (name, payload) of one day, written where their rows lie if the base is a folder that all machines share, else one by one; a payload that comes again is replaced.

        In a shared folder a day's first payloads are written beside its folder, which then takes its place as a whole; later ones are renamed into it one by one.
        """
        day = day or datetime.now(UTC).date()
        folder = f"{self.base}/raw/{source}/{dataset}/{DOWNLOADED}={day.isoformat()}"
        where, files = self._files(folder)
        if not folder.startswith("file://"):
            files.mkdirs(where)
            for row in payloads.select("name", "payload").toLocalIterator():
                self.save(source, dataset, row.name, row.payload.encode(), extension, day)
            return
        final = folder.removeprefix("file://")
        first = not files.exists(where)
        path = os.path.join(os.path.dirname(final), f".{os.path.basename(final)}.{uuid.uuid4().hex}") if first else final
        files.mkdirs(self._files(f"file://{path}")[0])

        def write(rows) -> None:
            for row in rows:
                name = os.path.join(path, f"{row.name}.{extension}")
                if first:
                    try:
                        with open(name, "xb") as file:  # nobody reads here yet, so no renaming, for which tasks would wait on one another
                            file.write(row.payload.encode())
                        continue
                    except FileExistsError:  # a name that comes again, or a task that runs again
                        pass
                part = os.path.join(path, f".{row.name}.{uuid.uuid4().hex}.{extension}.part")
                with open(part, "wb") as file:
                    file.write(row.payload.encode())
                check = os.path.join(path, f".{row.name}.{extension}.crc")
                if os.path.exists(check):  # the sum that the file system keeps of a payload that ``save`` wrote
                    os.remove(check)
                os.replace(part, name)

        try:
            payloads.select("name", "payload").foreachPartition(write)
            if first:
                self._settle(path, final)
        finally:
            if first:
                shutil.rmtree(path, ignore_errors=True)
        self._written.add((source, dataset, day.isoformat()))

    @staticmethod
    def _settle(path: str, final: str) -> None:
        """A whole folder into its place; its files one by one where another writer has made the place meanwhile."""
        try:
            os.rename(path, final)
        except OSError:
            if not os.path.isdir(final):
                raise
            with os.scandir(path) as found:
                for file in found:
                    os.replace(file.path, os.path.join(final, file.name))

    def _days(self, source: str, dataset: str) -> dict[str, int]:
        """The dated folders of a dataset and when each last changed, in milliseconds: one listing of folders, and a name a day.

        Object stores do not tell when a folder changed. There the newest two days, and those that this store wrote to, count as changed now, older ones as never.
        """
        where, files = self._files(f"{self.base}/raw/{source}/{dataset}")
        if not files.exists(where):
            return {}

        def seen() -> dict[str, int]:
            named = ((DAY_FOLDER.fullmatch(f.getPath().getName()), f) for f in files.listStatus(where))
            return {m[1]: f.getModificationTime() for m, f in named if m}

        found = seen()
        if self.base.startswith("s3a://"):
            now, late = int(time.time() * 1000), set(sorted(found)[-2:])
            return {d: now if d in late or (source, dataset, d) in self._written else 0 for d in found}
        if any(time.time() * 1000 - changed < SETTLED_S * 1000 for changed in found.values()):
            time.sleep(SETTLED_S)
            found = seen()
        return found

    def _runs(self, path: str) -> dict[str, tuple[int, str]]:
        """Of each day in the index: when its folder had last changed, and where its rows lie. Later runs count, and only those that came to their end."""
        where, files = self._files(path)
        if not files.exists(where):
            return {}
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        ended = sorted(f.getPath().getParent().getName() for f in files.globStatus(hadoop.Path(f"{path}/run-*/_SUCCESS")))
        place = {run: i for i, run in enumerate(ended)}
        found: dict[str, tuple[int, int, str]] = {}
        for folder in files.globStatus(hadoop.Path(f"{path}/run-*/day=*/stamp=*")):
            at, day = folder.getPath(), folder.getPath().getParent()
            run = place.get(day.getParent().getName())
            if run is not None:
                name = day.getName().removeprefix("day=")
                found[name] = max(found.get(name, (-1, 0, "")), (run, int(at.getName().removeprefix("stamp=")), at.toString()))
        return {d: (stamp, at) for d, (_, stamp, at) in found.items()}

    def _extend(self, source: str, dataset: str, extension: str, path: str, changed: dict[str, int]) -> None:
        """One run over the changed folders. It is written to a folder of its own, so tables that were read before stay whole, and a run that breaks off counts for nothing."""
        own = self.spark.newSession()  # for two settings: how many small files make a task, and that a small day keeps its parts
        own.conf.set("spark.sql.files.openCostInBytes", str(OPEN_COST))
        own.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        place, stamps = f"{self.base}/raw/{source}/{dataset}", own.createDataFrame(list(changed.items()), "day string, stamp long")
        if place.startswith("file://"):
            rows = _opened(stamps, place.removeprefix("file://"), extension)
        else:
            folders = [f"{place}/{DOWNLOADED}={d}" for d in changed]
            rows = _named(own.read.option("pathGlobFilter", f"*.{extension}").text(folders, wholetext=True)).where(f"name <> '' AND {DOWNLOADED} IS NOT NULL")
            rows = rows.withColumn("day", F.date_format(DOWNLOADED, "yyyy-MM-dd")).join(F.broadcast(stamps), "day")
        # a day's rows go to a few parts, so that parsing them is shared out, and a large part is cut further into files of like size
        told = rows.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(PARTS))).hint("rebalance", "day", "part").drop("part")
        run = f"{path}/run-{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"
        told.sortWithinPartitions("day", "stamp", "name").write.partitionBy("day", "stamp").parquet(run)

    def payloads(self, source: str, dataset: str, extension: str = "json") -> DataFrame:
        """(name, fecha_descarga, payload) of every version of every name, from the index, which is brought up to date first.

        Folders without a date and other extensions are ignored. The driver holds an entry a day. New folders that all machines share are listed in tasks; in other stores the driver lists
        their files while they are read, as any scan does.
        """
        path, schema = f"{self.base}/index/{source}/{dataset}/{extension}", f"name string, {DOWNLOADED} date, payload string"
        days, known = self._days(source, dataset), self._runs(path)
        changed = {d: stamp for d, stamp in days.items() if d not in known or known[d][0] != stamp}
        if changed:
            self._extend(source, dataset, extension, path, changed)
            known = self._runs(path)
        # a folder whose files are all gone leaves no rows in the new run; those of an older one no longer count
        found = [at for d, (stamp, at) in known.items() if d in days and (d not in changed or stamp == changed[d])]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def latest(self, source: str, dataset: str, extension: str = "json", named: str = "", ends: str = "", among: DataFrame | set[str] | None = None) -> DataFrame:
        """(name, fecha_descarga, payload): the newest payload of each name that begins with ``named``, ends with ``ends`` and is in ``among``, if that is given: a few names, or the first column of a table.

        Which payloads are the newest is found from names and days alone; only theirs are read on.
        """
        rows = self.payloads(source, dataset, extension)
        if named:
            rows = rows.where(F.col("name").startswith(named))
        if ends:
            rows = rows.where(F.col("name").endswith(ends))
        if isinstance(among, DataFrame):
            rows = rows.join(among.select(F.col(among.columns[0]).cast("string").alias("name")), "name", "left_semi")
        elif among is not None:
            rows = rows.where(F.col("name").isin(sorted(among)))
        newest = rows.groupBy("name").agg(F.max(DOWNLOADED).alias(DOWNLOADED))
        return rows.join(newest, ["name", DOWNLOADED]).select("name", DOWNLOADED, "payload")

    def _newest(self, source: str, dataset: str, name: str, extension: str) -> tuple[date, str] | None:
        """The newest day of one name and its file, by asking the folders from the newest on; no listing of files and no index, so a crawl may ask for one name after another."""
        for day in sorted(self._days(source, dataset), reverse=True):
            path = f"{self.base}/raw/{source}/{dataset}/{DOWNLOADED}={day}/{name}.{extension}"
            where, files = self._files(path)
            if files.exists(where):
                return datetime.strptime(day, "%Y-%m-%d").date(), path
        return None

    def read_latest(self, source: str, dataset: str, name: str, extension: str = "json") -> str | None:
        found = self._newest(source, dataset, name, extension)
        return self.spark.read.text(found[1], wholetext=True).first().value if found else None

    def last_download(self, source: str, dataset: str, name: str, extension: str = "json") -> date | None:
        found = self._newest(source, dataset, name, extension)
        return found[0] if found else None

    def cached_or_fetched(self, source: str, dataset: str, name: str, fetch, extension: str = "json") -> str:
        """The stored payload if there is one, else what ``fetch`` returns, stored before it is interpreted."""
        stored = self.read_latest(source, dataset, name, extension)
        if stored is not None:
            return stored
        payload = fetch()
        self.save(source, dataset, name, payload, extension)
        return payload.decode()

    def stale(self, names: DataFrame, source: str, dataset: str, days: int | None, today: date, extension: str = "json") -> DataFrame:
        """Of ``names`` (column name), those without a download newer than ``days`` ago; None: without any download."""
        rows = self.payloads(source, dataset, extension)
        fresh = rows if days is None else rows.where(F.col(DOWNLOADED) > F.lit(today - timedelta(days=days)))
        return names.join(fresh.select("name"), "name", "left_anti")
