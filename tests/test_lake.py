"""Raw and curated layers on a local folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from canonlake.operators.integrity import IntegrityError
from canonlake.sources.curated import CuratedStore
from canonlake.sources.mapping_csv import MappingStore
from canonlake.sources.raw import RawStore, base_uri


@pytest.fixture
def base(tmp_path):
    return f"file://{tmp_path}"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_base_uri():
    assert base_uri("s3://bucket/a/") == "s3a://bucket/a"
    for bad in ("s3:///x", "ftp://x", "plain"):
        with pytest.raises(ValueError):
            base_uri(bad)


def test_raw_keeps_all_and_reads_the_latest(spark, base, tmp_path):
    raw = RawStore(spark, base)
    assert raw.latest("s", "d").count() == 0 and raw.read_latest("s", "d", "a") is None
    raw.save("s", "d", "a", b"old\nline", day=dt.date(2024, 1, 1))
    raw.save("s", "d", "a", b"new", day=dt.date(2024, 2, 1))
    raw.save("s", "d", "b", b"only", day=dt.date(2024, 1, 5))
    raw.save("s", "d", "b", b"<p>", extension="html", day=dt.date(2025, 1, 1))
    (tmp_path / "raw/s/d/nodate").mkdir()
    (tmp_path / "raw/s/d/nodate/c.json").write_text("{}")
    assert rows(raw.latest("s", "d").select("name", "payload")) == [("a", "new"), ("b", "only")]
    assert raw.payloads("s", "d").count() == 3
    assert raw.read_latest("s", "d", "a") == "new" and raw.last_download("s", "d", "a") == dt.date(2024, 2, 1)
    assert raw.cached_or_fetched("s", "d", "a", lambda: pytest.fail("was stored")) == "new"
    assert raw.cached_or_fetched("s", "d", "z", lambda: b"fetched") == "fetched" and raw.read_latest("s", "d", "z") == "fetched"
    names = spark.createDataFrame([("a",), ("b",), ("q",)], "name string")
    assert rows(raw.stale(names, "s", "d", 10, dt.date(2024, 2, 5))) == [("b",), ("q",)]
    assert rows(raw.stale(names, "s", "d", None, dt.date(2024, 2, 5))) == [("q",)]


def test_a_payload_of_the_same_day_is_replaced(spark, base, tmp_path):
    raw = RawStore(spark, base)
    for body in (b"one", b"two"):
        raw.save("s", "d", "a", body, day=dt.date(2024, 1, 1))
    raw.save_all("s", "d", spark.createDataFrame([("b", "x"), ("a", "three")], "name string, payload string"), day=dt.date(2024, 1, 1))
    assert rows(raw.latest("s", "d").select("name", "payload")) == [("a", "three"), ("b", "x")]
    assert not [f for f in (tmp_path / "raw/s/d/fecha_descarga=2024-01-01").iterdir() if f.name.endswith(".part")]


def runs(tmp_path, dataset="d", extension="json"):
    return sorted((tmp_path / f"index/s/{dataset}/{extension}").glob("run-*"))


def test_the_index_opens_each_payload_once(spark, base, tmp_path):
    raw = RawStore(spark, base)
    pair = "name string, payload string"
    raw.save_all("s", "d", spark.createDataFrame([(n, f"{n} one") for n in "abc"], pair), day=dt.date(2024, 1, 1))
    before = raw.latest("s", "d")
    assert rows(raw.latest("s", "d", among={"a", "q"}).select("name")) == [("a",)] and len(runs(tmp_path)) == 1
    raw.save_all("s", "d", spark.createDataFrame([("b", "b two"), ("e", "e two")], pair), day=dt.date(2024, 2, 1))
    # another store over the same base goes on where this one was; only the new folder is read
    other = RawStore(spark, base)
    asked = spark.createDataFrame([("b",), ("c",), ("c",), (None,), ("q",)], "name string")
    assert rows(other.latest("s", "d", among=asked).select("name", "payload")) == [("b", "b two"), ("c", "c one")]
    assert len(runs(tmp_path)) == 2 and [f.name for f in runs(tmp_path)[1].glob("day=*")] == ["day=2024-02-01"]
    # a table that was read before the folder changed still holds
    assert rows(before.select("payload")) == [("a one",), ("b one",), ("c one",)]
    # a late file in an old folder, and a payload that is gone
    raw.save("s", "d", "late", b"x", day=dt.date(2024, 1, 1))
    (tmp_path / "raw/s/d/fecha_descarga=2024-01-01/a.json").unlink()
    assert rows(other.latest("s", "d").select("name", "payload")) == [("b", "b two"), ("c", "c one"), ("e", "e two"), ("late", "x")]
    assert rows(other.latest("s", "d", named="l", ends="te").select("name")) == [("late",)]
    for name in ("b", "e"):
        (tmp_path / f"raw/s/d/fecha_descarga=2024-02-01/{name}.json").unlink()
    assert rows(other.latest("s", "d").select("name", "payload")) == [("b", "b one"), ("c", "c one"), ("late", "x")]


def test_a_broken_run_of_the_index_counts_for_nothing(spark, base, tmp_path):
    raw = RawStore(spark, base)
    raw.save("s", "d", "a", b"one", day=dt.date(2024, 1, 1))
    raw.save("s", "d", "b", b"two", day=dt.date(2024, 1, 2))
    assert raw.latest("s", "d").count() == 2
    (runs(tmp_path)[0] / "_SUCCESS").unlink()
    assert rows(raw.latest("s", "d").select("name", "payload")) == [("a", "one"), ("b", "two")] and len(runs(tmp_path)) == 2


def test_a_hundred_thousand_names(spark, base, tmp_path):
    raw, many = RawStore(spark, base), 100_000
    name = lambda k: F.format_string("n-%06d", k)
    every = spark.range(0, many, 1, 8)
    raw.save_all("s", "d", every.select(name("id").alias("name"), F.concat(F.lit("old "), "id").alias("payload")), day=dt.date(2024, 1, 1))
    raw.save_all("s", "d", every.where("id % 100 = 0").select(name("id").alias("name"), F.concat(F.lit("new "), "id").alias("payload")), day=dt.date(2024, 2, 1))
    told = raw.latest("s", "d").groupBy(F.substring("payload", 1, 3).alias("v")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("name").alias("names"))
    assert rows(told) == [("new", 1_000, 1_000), ("old", 99_000, 99_000)]
    odd = raw.latest("s", "d", among=every.where("id % 2 = 1").select(name("id").alias("name")))
    assert odd.count() == many // 2 and odd.where("payload like 'new%'").count() == 0
    asked = spark.range(many - 10, many + 10).select(name("id").alias("name"))
    assert raw.stale(asked, "s", "d", None, dt.date(2024, 2, 5)).count() == 10 and raw.stale(asked, "s", "d", 10, dt.date(2024, 2, 5)).count() == 20
    assert raw.read_latest("s", "d", "n-000100") == "new 100" and raw.last_download("s", "d", "n-000101") == dt.date(2024, 1, 1)
    assert len(runs(tmp_path)) == 1 and not [v for v in vars(raw).values() if hasattr(v, "__len__") and not isinstance(v, str) and len(v) > 2]


def frame(spark, data, schema="player_id int, value int"):
    return spark.createDataFrame(data, schema)


def test_upsert_replaces_keys_and_touches_one_partition(spark, base):
    store = CuratedStore(spark, base)
    one, two = {"competition": "x", "season": "07"}, {"competition": "y", "season": "07"}
    store.upsert("t", frame(spark, [(1, 10), (1, 11), (2, 20), (None, 1)]), ["player_id"], one)
    store.upsert("t", frame(spark, [(1, 5)]), ["player_id"], two)
    batch = frame(spark, [(1, 99, "n"), (None, 2, "n")], "player_id int, value int, extra string")
    for _ in range(2):  # the same batch again changes nothing
        store.upsert("t", batch, ["player_id"], one)
    assert rows(store.read_partition("t", one).select("player_id", "value", "extra")) == sorted([(1, 99, "n"), (2, 20, None), (None, 2, "n")], key=repr)
    whole = store.read_table("t")
    assert whole.count() == 4 and {r.season for r in whole.select("season").distinct().collect()} == {"07"}
    assert store.distinct_values("t", "player_id", one) == {1, 2}
    store.upsert("t", frame(spark, [(3, 3)]), ["player_id"], one, touched=frame(spark, [(2, 0)]).select("player_id"))
    assert store.distinct_values("t", "player_id", one) == {1, 3}


def test_unique_partition_moves_keys_and_leaves_empty_siblings(spark, base):
    store = CuratedStore(spark, base)
    at = lambda c: {"competition": c}
    store.write_table("t", frame(spark, [(1, 1)]), at("a"))
    store.write_table("t", frame(spark, [(2, 2), (1, 3)]), at("b"))
    store.upsert_unique_partition("t", frame(spark, [(1, 9)]), ["player_id"], at("c"))
    assert rows(store.read_table("t").select("player_id", "value", "competition")) == [(1, 9, "c"), (2, 2, "b")]
    assert store.read_partition("t", at("a")).count() == 0 and store.read_partition("t", at("q")) is None


def test_retain_and_partitioned_writes(spark, base):
    store = CuratedStore(spark, base)
    store.write_partitioned("t", frame(spark, [(1, 1, "a"), (2, 2, "a"), (3, 3, "b")], "player_id int, value int, p string"), ["p"])
    store.write_partitioned("t", frame(spark, [(4, 4, "b")], "player_id int, value int, p string"), ["p"])
    assert rows(store.read_table("t").select("player_id", "p")) == [(1, "a"), (2, "a"), (4, "b")]
    keep = frame(spark, [(1, 0)]).select("player_id")
    assert store.retain_keys("t", keep, ["player_id"], {"p": "a"}) == 1 and store.retain_keys("t", keep, ["player_id"], {"p": "a"}) == 0
    assert store.retain_keys("t", keep, ["player_id"], {"p": "zz"}) == 0
    with pytest.raises(FileNotFoundError):
        store.read_table("missing")
    assert store.read_tolerant("missing", {"a": "int"}).count() == 0
    assert rows(store.read_tolerant("t", {"player_id": "int", "absent": "string"})) == [(1, None), (4, None)]


def test_restamp_rewrites_changed_partitions_only(spark, base):
    store = CuratedStore(spark, base)
    store.write_partitioned("t", spark.createDataFrame([("1", "", "a"), ("2", "p2", "b")], "sid string, canonical_id string, p string"), ["p"])
    mapping = spark.createDataFrame([("1", "p1"), ("2", "p2")], "id string, canonical_id string")
    assert store.restamp("t", mapping, "sid", "id", ["p"]) == 1
    assert store.restamp("t", mapping, "sid", "id", ["p"]) == 0
    assert rows(store.read_table("t").select("sid", "canonical_id", "p")) == [("1", "p1", "a"), ("2", "p2", "b")]


def test_mapping_files(spark, tmp_path):
    store = MappingStore(spark, str(tmp_path / "m"))
    assert store.load("players").count() == 0
    good = spark.createDataFrame([("p00002", "a", "7", "auto", "d"), ("p00001", "a", "007", "manual", "d")], store.load("players").schema)
    store.save({"players": good, "sofascore-skips": store.load("sofascore-skips")})
    assert [r.id_en_fuente for r in store.load("players").collect()] == ["007", "7"]
    assert not (tmp_path / "m/sofascore-skips.csv").exists()
    for extra in [("p00003", "a", "7", "auto", "d"), ("p00001", "a", "8", "auto", "d"), ("x1", "b", "1", "auto", "d")]:
        with pytest.raises(IntegrityError):
            store.save({"players": good.union(spark.createDataFrame([extra], good.schema))})


def test_no_name_of_a_new_folder_passes_through_the_driver(spark, base):
    raw, many = RawStore(spark, base), 2_000
    raw.save_all("s", "d", spark.range(many).select(F.col("id").cast("string").alias("name"), F.lit("{}").alias("payload")), day=dt.date(2024, 1, 1))
    listed = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    before = listed.getCount()
    assert raw.payloads("s", "d").count() == many
    assert listed.getCount() - before < 100


def test_odd_names_and_bytes_of_a_folder(spark, base, tmp_path):
    raw, folder = RawStore(spark, base), tmp_path / "raw/s/d/fecha_descarga=2024-01-01"
    pair = "name string, payload string"
    odd = ["a b", "50%", "c#d", "e.f", "ñ", "g[1]", "_h", ".i"]
    raw.save_all("s", "d", spark.createDataFrame([(n, f"{n} ñ\r\n") for n in odd], pair), day=dt.date(2024, 1, 1))
    (folder / "other.html").write_text("x")
    (folder / "empty.json").write_bytes(b"")
    (folder / "cut.json").write_bytes(b"\xff{")
    (folder / "below.json").mkdir()
    found = {r.name: bytes(r.b) for r in raw.payloads("s", "d").select("name", F.col("payload").cast("binary").alias("b")).collect()}
    assert found == {n: f"{n} ñ\r\n".encode() for n in odd[:6]} | {"empty": b"", "cut": b"\xff{"}


def test_the_first_payloads_of_a_day_come_whole_or_not_at_all(spark, base, tmp_path):
    raw, pair, place = RawStore(spark, base), "name string, payload string", tmp_path / "raw/s/d"
    with pytest.raises(Exception, match="AttributeError"):
        raw.save_all("s", "d", spark.createDataFrame([("a", "x"), ("b", None)], pair).coalesce(1), day=dt.date(2024, 1, 1))
    assert not list(place.iterdir()) and raw.payloads("s", "d").count() == 0
    again = spark.createDataFrame([("a", "x")] * 40, pair).repartition(4)
    raw.save_all("s", "d", again, day=dt.date(2024, 1, 1))
    assert [f.name for f in place.iterdir()] == ["fecha_descarga=2024-01-01"] and rows(raw.payloads("s", "d").select("name", "payload")) == [("a", "x")]
    # another writer has made the folder meanwhile
    (place / "made").mkdir()
    (place / "made/a.json").write_text("newer")
    RawStore._settle(str(place / "made"), str(place / "fecha_descarga=2024-01-01"))
    assert rows(raw.payloads("s", "d").select("name", "payload")) == [("a", "newer")]
