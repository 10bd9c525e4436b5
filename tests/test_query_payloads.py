"""Payloads that queries make: none grows with its table."""

import os

import pytest

from canonlake import domain_queries as queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


@pytest.fixture
def sizes(monkeypatch):
    """The largest number of events in a payload, at 50 keys a page."""
    seen = []
    exact = queries.as_payload

    def noted(rows, name, body):
        out = exact(rows, name, body)
        seen.append(max(r.payload.count("startTimestamp") for r in out.select("payload").collect()))
        return out

    monkeypatch.setattr(queries, "PAGE_KEYS", 50)
    monkeypatch.setattr(queries, "as_payload", noted)
    return seen


def test_finished_events_come_in_pages(spark, sizes):
    duckdb = pytest.importorskip("duckdb")
    found = queries.finished_events(spark, SF)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW orders AS SELECT * FROM '{SF}/orders.parquet'")
    want = con.sql(queries.query.__globals__["ORACLES"]["finished_events"])
    places = [found.columns.index(c) for c in want.columns]
    assert sorted(tuple(r[i] for i in places) for r in found.collect()) == sorted(want.fetchall())
    assert sizes and max(sizes) <= 50


@pytest.mark.parametrize("name", ["cup_minutes", "identity_catalog", "lineup_match_stats"])
def test_line_ups_meet_events_that_come_in_pages(spark, sizes, name):
    assert getattr(queries, name)(spark, SF).columns
    assert sizes and max(sizes) <= 50
