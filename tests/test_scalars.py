"""Scalar functions on single values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from canonlake.functions import scalars as S

CASES = [
    (S.normalize, "  Óscar  de la Peña-Ruiz ", "oscar de la pena ruiz"),
    (S.normalize, "Sørloth", "s rloth"),
    (S.normalize, "ﬁn ½", "fin 1 2"),
    (S.normalize, None, None),
    (S.name_tokens, "Óscar de la Fuente", ["fuente", "oscar"]),
    (S.team_tokens, "FC Barcelona", ["barcelona"]),
    (S.name_tokens, "de la", []),
    (S.season_start, "25/26", 2025),
    (S.season_start, "99/00", 1999),
    (S.season_start, "2025", 2025),
    (S.season_start, "x/26", None),
    (S.season_start, None, None),
    (S.slash_date, "12/04/2001", dt.date(2001, 4, 12)),
    (S.slash_date, "-", None),
    (S.slash_date, "31/02/2001", None),
    (S.iso_date, "2024-05-06T10:00:00Z", dt.date(2024, 5, 6)),
    (S.iso_date, "soon", None),
    (S.money, "€29.45m", 29_450_000),
    (S.money, "€1.30bn", 1_300_000_000),
    (S.money, "€900Th.", 900_000),
    (S.money, "€1,250", 1_250),
    (S.money, "-", None),
    (S.transfer_kind, "End of loan30/06", "end of loan"),
    (S.transfer_kind, "Loan fee: €1m", "loan"),
    (S.transfer_kind, "free transfer", "transfer"),
    (S.leading_int, "233 days", 233),
    (S.leading_int, "-", None),
    (S.int_or_null, "12", 12),
    (S.int_or_null, "1x", None),
    (S.club_of_link, "/real/startseite/verein/418", 418),
    (S.player_of_token, "https://x/y/profil/spieler/99", "99"),
    (S.decision_kind, " SÍ ", "yes"),
    (S.decision_kind, "1", "yes"),
    (S.decision_kind, "no-tm", "skip"),
    (S.decision_kind, "77", "id"),
    (S.decision_kind, "what", "unknown"),
    (S.decision_kind, "  ", None),
    (S.slug, "Ez Abde!", "ez-abde"),
    (S.slug, "??", "query"),
    (S.id_text, "12.0", "12"),
    (S.id_text, "x", None),
]


@pytest.mark.parametrize("fn,value,want", CASES, ids=lambda v: getattr(v, "__name__", str(v))[:30])
def test_value(spark, fn, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(fn(F.col("v"))).first()[0] == want


def test_packed_dates_and_results(spark):
    row = spark.range(1).select(
        S.short_packed_date(F.lit(250701)), S.short_packed_date(F.lit(251301)), S.long_packed_date(F.lit(19990228)), S.long_packed_date(F.lit(0)), S.long_packed_date(F.lit(None).cast("long")),
        S.result(F.lit(1), F.lit(2)), S.result(F.lit(None).cast("int"), F.lit(2)), S.result_of_flags(F.lit(False), F.lit(False)), S.season_label(F.lit(1999)), S.epoch_date(F.lit(0)),
        S.is_starting(F.lit(None).cast("boolean")), S.birth_compatible(F.lit(""), F.lit("2001-01-01")), S.birth_matches(F.lit(""), F.lit("")), S.compatible(F.array(F.lit("a")), F.array().cast("array<string>")),
    ).first()
    assert list(row) == [dt.date(2025, 7, 1), None, dt.date(1999, 2, 28), None, None, "loss", None, "draw", "99/00", dt.date(1970, 1, 1), False, True, False, False]


def test_canonical_ids_keep_all_their_digits(spark):
    numbers = [1, 99_999, 100_000, 123_456, 1_234_567]
    found = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", S.canonical_id("p", F.col("n"), 5).alias("i")).collect()
    assert {r.n: r.i for r in found} == {n: f"p{n:05d}" for n in numbers}
