"""Streams of files against the same rows in one go: any order of files, late rows, restarts, batches that come twice."""

import datetime as dt

import pytest

from canonlake.sources.curated import CuratedStore
from canonlake.streaming import incremental


def at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


CALENDAR, SHEETS = "match int, start timestamp", "match int, at timestamp, player int"


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, f"file://{folder}"
        self.store = CuratedStore(spark, f"{self.folder}/lake")
        for name, schema in (("calendar", CALENDAR), ("sheets", SHEETS)):
            put(spark, self.folder, name, [], schema)

    def run(self, write=None):
        side = lambda name, schema: incremental.new_files(self.spark, f"{self.folder}/{name}", schema)
        joined = incremental.matched(side("calendar", CALENDAR), side("sheets", SHEETS), ["match"], "start", "at", "3 HOURS", "2 hours")
        return incremental.run_counted(joined, f"{self.folder}/checkpoint", write or (lambda batch, number: self.store.write_table("out", batch, {"batch": f"{number:05}"})))

    def found(self):
        return sorted(tuple(r) for r in self.store.read_table("out").select("match", "player").where("match < 90").collect())


MATCHES = [[(1, at(0)), (2, at(1))], [(3, at(10)), (4, at(11))]]
PLAYED = [[(1, at(1), 11), (1, at(2), 12), (2, at(9), 21)], [(3, at(12), 31), (3, at(14), 32), (None, at(12), 1)]]
#: 2 and 32 came too long after the start; 4 has no sheet.
WANT = [(1, 11), (1, 12), (2, None), (3, 31), (4, None)]
#: Rows of a later day: the watermark passes what came before.
LATER = [(90, at(100))], [(90, at(100), 0)]


@pytest.mark.parametrize("order", [("c0", "s0", "c1", "s1"), ("s0", "c0", "s1", "c1")])
def test_files_in_either_order_and_a_restart_after_each(spark, tmp_path, order):
    lake = Lake(spark, tmp_path)
    for step in order:
        if step[0] == "c":
            put(spark, lake.folder, "calendar", MATCHES[int(step[1])], CALENDAR)
        else:
            put(spark, lake.folder, "sheets", PLAYED[int(step[1])], SHEETS)
        lake.run()
    put(spark, lake.folder, "calendar", LATER[0], CALENDAR)
    put(spark, lake.folder, "sheets", LATER[1], SHEETS)
    lake.run()
    assert lake.found() == WANT
    whole = incremental.matched(spark.createDataFrame(MATCHES[0] + MATCHES[1], CALENDAR), spark.createDataFrame(PLAYED[0] + PLAYED[1], SHEETS), ["match"], "start", "at", "3 HOURS", "2 hours")
    assert sorted(tuple(r) for r in whole.select("match", "player").collect()) == WANT
    # behind the watermark: left out, and counted
    put(spark, lake.folder, "sheets", [(4, at(12), 99), (4, at(13), 98)], SHEETS)
    assert lake.run()["late"] == 2
    assert lake.found() == WANT


def test_a_late_file_within_the_watermark_is_taken(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    put(spark, lake.folder, "calendar", MATCHES[1], CALENDAR)
    put(spark, lake.folder, "sheets", PLAYED[1], SHEETS)
    assert lake.run()["held"] > 0
    put(spark, lake.folder, "sheets", [(4, at(13), 41)], SHEETS)
    assert lake.run()["late"] == 0
    put(spark, lake.folder, "calendar", LATER[0], CALENDAR)
    put(spark, lake.folder, "sheets", LATER[1], SHEETS)
    lake.run()
    assert lake.found() == [(3, 31), (4, 41)]


def test_clashing_columns_are_named(spark):
    both = spark.createDataFrame([(1, at(0), 5)], "match int, start timestamp, player int")
    with pytest.raises(ValueError, match="player"):
        incremental.matched(both, spark.createDataFrame([], SHEETS), ["match"], "start", "at", "3 HOURS", "2 hours")


def test_a_key_that_comes_again_is_written_once(spark, tmp_path):
    folder, store = f"file://{tmp_path}", CuratedStore(spark, f"file://{tmp_path}/lake")
    run = lambda: incremental.run_counted(incremental.once(incremental.new_files(spark, f"{folder}/in", CALENDAR), ["match"], "start", "5 hours"), f"{folder}/checkpoint", lambda batch, n: store.write_table("out", batch, {"batch": f"{n:05}"}))
    found = lambda: sorted(r.match for r in store.read_table("out").select("match").collect())
    put(spark, folder, "in", [(1, at(0)), (1, at(0)), (2, at(1))], CALENDAR)
    run()
    put(spark, folder, "in", [(2, at(2)), (3, at(3))], CALENDAR)
    run()
    assert found() == [1, 2, 3]
    assert sorted(r.match for r in incremental.once(spark.createDataFrame([(1, at(0)), (1, at(9)), (2, at(1))], CALENDAR), ["match"], "start", "5 hours").collect()) == [1, 2]


def test_a_crash_between_identities_and_points(spark, tmp_path):
    """The batch comes again after the crash: no points without a name, nothing twice."""
    folder, store = f"file://{tmp_path}", CuratedStore(spark, f"file://{tmp_path}/lake")
    schema = "round_id int, id int, name string, points int"
    put(spark, folder, "in", [(7, 1, "Ana", 5), (7, 2, "Bea", 6)], schema)
    writer = incremental.identities_then_points(store, lambda b: b.select("id", "name").distinct(), lambda b: b.select("round_id", "id", "points"), {"season": "2023"})
    upsert = store.upsert

    def crash(table, *args, **kwargs):
        if table == "fantasy_round_points":
            raise RuntimeError("the machine is lost")
        upsert(table, *args, **kwargs)

    run = lambda: incremental.run_available(incremental.new_files(spark, f"{folder}/in", schema), f"{folder}/checkpoint", writer)
    store.upsert = crash
    with pytest.raises(Exception, match="lost"):
        run()
    assert store.read_table("biwenger_players_history").count() == 2 and not store.exists("fantasy_round_points")
    store.upsert = upsert
    run()
    put(spark, folder, "in", [(7, 1, "Ana", 9), (7, 2, "Bea", 6)], schema)  # the round again, corrected
    run()
    assert sorted(map(tuple, store.read_table("fantasy_round_points").select("round_id", "id", "points").collect())) == [(7, 1, 9), (7, 2, 6)]
    assert store.read_table("biwenger_players_history").count() == 2
