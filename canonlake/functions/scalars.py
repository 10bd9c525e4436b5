"""Scalar functions over columns. All are null-safe; source data is read with try_ functions, never with casts that raise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words of person and club names that do not tell identities apart.
NAME_PARTICLES = ["al", "da", "das", "de", "del", "den", "der", "di", "dos", "e", "el", "la", "las", "le", "los", "van", "von", "y"]
CLUB_WORDS = ["ad", "b", "cd", "cf", "club", "cp", "de", "fc", "ii", "rc", "sad", "sd", "ud"]
# Units of money in texts such as "€29.45m" and "€900Th.".
MONEY_UNITS = {"bn": 1_000_000_000, "m": 1_000_000, "k": 1_000, "th": 1_000, "": 1}
#: An amount: its number and its unit, in any case.
MONEY_PATTERN = r"€\s*([\d.,]+)\s*(bn|m|k|th)?"
# Tokens of a human decision.
YES_TOKENS = ["1", "ok", "si", "sí", "true", "x", "y", "yes"]
SKIP_TOKENS = ["biwenger-only", "no-tm", "none", "skip", "solo-biwenger"]


@F.pandas_udf(T.StringType())
def _nfkd(text: pd.Series) -> pd.Series:
    return text.map(lambda s: s if s is None or s.isascii() else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))


def strip_accents(text: Column) -> Column:
    """NFKD without combining marks; letters that do not decompose stay. Spark has no such function, so texts that are not ASCII go through Arrow; of others only a null goes."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, text).otherwise(_nfkd(F.when(~plain, text)))


def normalize_ascii(text: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 as one space, trimmed. For text whose accents are stripped already."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def normalize(text: Column) -> Column:
    """Accents stripped, lower case, only a-z, 0-9 and single spaces."""
    return normalize_ascii(strip_accents(text))


def tokens(normal: Column, stop_words: list[str]) -> Column:
    """The distinct tokens of a normalised text, without stop words, in order; null text has none."""
    split = F.filter(F.split(F.coalesce(normal, F.lit("")), " "), lambda t: t != "")
    return F.array_sort(F.array_except(F.array_distinct(split), F.array(*[F.lit(w) for w in stop_words])))


def name_tokens(name: Column) -> Column:
    return tokens(normalize(name), NAME_PARTICLES)


def team_tokens(name: Column) -> Column:
    return tokens(normalize(name), CLUB_WORDS)


def compatible(a: Column, b: Column) -> Column:
    """Neither token set is empty and one holds the other."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ((F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0))


def season_of(day: Column) -> Column:
    """Start year of the season of a date; seasons begin on 1 July."""
    return F.year(day) - (F.month(day) < 7).cast("int")


def season_label(start: Column) -> Column:
    """2025 as "25/26"."""
    two = lambda n: F.lpad(F.pmod(n, F.lit(100)).cast("string"), 2, "0")
    return F.concat(two(start), F.lit("/"), two(start + 1))


def season_start(label: Column) -> Column:
    """Start year of "25/26", "2025" or "2025/2026"; two digits under 90 are of this century; null if unreadable."""
    head = F.split_part(F.trim(label), F.lit("/"), F.lit(1))
    number = F.when(F.rlike(head, F.lit("^(\\d{2}|\\d{4})$")), head.try_cast("int"))
    return F.when(F.length(head) == 4, number).when(number < 90, 2000 + number).otherwise(1900 + number)


def _valid_date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def short_packed_date(stamp: Column) -> Column:
    """A date packed as yymmdd of this century; null and impossible dates are null."""
    return _valid_date(2000 + F.floor(stamp / 10000), F.floor(stamp / 100) % 100, stamp % 100)


def long_packed_date(stamp: Column) -> Column:
    """A date packed as yyyymmdd; null, 0 and impossible dates are null."""
    return F.when(stamp > 0, _valid_date(F.floor(stamp / 10000), F.floor(stamp / 100) % 100, stamp % 100))


def slash_date(text: Column) -> Column:
    """dd/MM/yyyy, null for anything else."""
    return F.when(F.rlike(F.trim(text), F.lit("^\\d{1,2}/\\d{1,2}/\\d{4}$")), F.try_to_date(F.trim(text), "d/M/yyyy"))


def iso_date(text: Column) -> Column:
    """The date of an ISO date or date-time, null for anything else."""
    return F.when(F.rlike(text, F.lit("^\\d{4}-\\d{2}-\\d{2}")), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def epoch_date(seconds: Column) -> Column:
    """The UTC date of epoch seconds; the session's time zone is UTC."""
    return F.to_date(F.timestamp_seconds(seconds))


def result(own: Column, other: Column) -> Column:
    """win, loss or draw; null while a score is missing."""
    return F.when(own > other, "win").when(own < other, "loss").when(own == other, "draw")


def result_of_flags(won: Column, lost: Column) -> Column:
    """win before loss before draw."""
    return F.when(won, "win").when(lost, "loss").otherwise("draw")


def money(text: Column) -> Column:
    """The first amount in euros as a whole number, half to even; null without one."""
    pattern = f"(?i){MONEY_PATTERN}"
    number = F.regexp_replace(F.regexp_extract(text, pattern, 1), ",", "").try_cast("double")
    unit = F.lower(F.regexp_extract(text, pattern, 2))
    factor = F.create_map(*[x for u, n in MONEY_UNITS.items() for x in (F.lit(u), F.lit(n))])[unit]
    return F.bround(number * factor, 0).cast("long")


def transfer_kind(fee: Column) -> Column:
    """end of loan, loan or transfer, by the words of a fee. The words are plain ASCII, so only case is folded."""
    low = F.lower(fee)
    return F.when(F.contains(low, F.lit("end of loan")), "end of loan").when(F.contains(low, F.lit("loan")), "loan").otherwise("transfer")


def leading_int(text: Column) -> Column:
    """The first run of digits."""
    return F.regexp_extract(text, "(\\d+)", 1).try_cast("long")


def int_or_null(text: Column) -> Column:
    """A text of digits alone as a number."""
    return F.when(F.rlike(F.trim(text), F.lit("^\\d+$")), F.trim(text).try_cast("long"))


def club_of_link(link: Column) -> Column:
    """The club id of a link."""
    return F.regexp_extract(link, "/verein/(\\d+)", 1).try_cast("long")


def player_of_token(token: Column) -> Column:
    """The player id of a profile link or of digits alone, as text; null for anything else."""
    linked = F.regexp_extract(token, "/spieler/(\\d+)", 1)
    return F.when(linked != "", linked).when(F.rlike(F.trim(token), F.lit("^\\d+$")), F.trim(token))


def decision_kind(token: Column, allow_id: bool = True) -> Column:
    """yes, skip, id, unknown, or null for an empty decision."""
    low = F.lower(F.trim(token))
    known = F.when(low == "", F.lit(None).cast("string")).when(low.isin(YES_TOKENS), "yes").when(low.isin(SKIP_TOKENS), "skip")
    return known.when(player_of_token(token).isNotNull(), "id").otherwise("unknown") if allow_id else known.otherwise("unknown")


def birth_matches(a: Column, b: Column) -> Column:
    """Both dates known and equal, on the first ten characters."""
    return F.coalesce((a != "") & (F.substring(a, 1, 10) == F.substring(b, 1, 10)), F.lit(False))


def birth_compatible(a: Column, b: Column) -> Column:
    """Equal, or one unknown."""
    unknown = lambda c: c.isNull() | (c == "")
    return unknown(a) | unknown(b) | (F.substring(a, 1, 10) == F.substring(b, 1, 10))


def player_event(player: Column, event: Column) -> Column:
    return F.concat_ws("_", player.cast("string"), event.cast("string"))


def slug(text: Column) -> Column:
    """Lower case, anything but letters and digits as "-", none at the ends; "query" if nothing is left."""
    dashed = F.btrim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]", "-"), F.lit("-"))
    return F.when(F.coalesce(dashed, F.lit("")) == "", "query").otherwise(dashed)


def is_starting(substitute: Column) -> Column:
    """Only an explicit false is a start."""
    return substitute.eqNullSafe(F.lit(False))


def id_text(value: Column) -> Column:
    """An id that may have come as a floating number, as whole-number text; null if it is none."""
    return value.try_cast("double").try_cast("long").cast("string")


def canonical_id(prefix: str, number: Column, digits: int) -> Column:
    """The prefix and the number in ``digits`` digits, or more where it has more: none is cut off."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0")))


def canonical_number(identifier: Column) -> Column:
    return F.regexp_extract(identifier, "(\\d+)$", 1).try_cast("long")


def money_text(amount: Column) -> Column:
    """A whole number of euros in the source's notation, exact to the cent of its unit."""
    return F.when(amount >= 1_000_000, F.concat(F.lit("€"), (amount / 1_000_000).cast("decimal(18,6)").cast("string"), F.lit("m"))).otherwise(
        F.concat(F.lit("€"), (amount / 1_000).cast("decimal(18,3)").cast("string"), F.lit("k"))
    )


def duration_text(seconds: Column) -> Column:
    """A compact text: "30 s", "45 min", "2 min 5 s", "3 h", "2 h 30 min"."""
    whole = F.floor(seconds).cast("long")
    minutes, rest = F.floor(whole / 60), F.pmod(whole, F.lit(60))
    hours, left = F.floor(minutes / 60), F.pmod(minutes, F.lit(60))
    text = lambda n, unit: F.concat(n.cast("long").cast("string"), F.lit(f" {unit}"))
    of_minutes = F.when(rest == 0, text(minutes, "min")).otherwise(F.concat_ws(" ", text(minutes, "min"), text(rest, "s")))
    of_hours = F.when(left == 0, text(hours, "h")).otherwise(F.concat_ws(" ", text(hours, "h"), text(left, "min")))
    return F.when(whole < 60, text(whole, "s")).when(minutes < 60, of_minutes).otherwise(of_hours)


def minute_text(moment: Column) -> Column:
    """A time to the minute, a dash without one."""
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd HH:mm"), F.lit("\u2014"))
