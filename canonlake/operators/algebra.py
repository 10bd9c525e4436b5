"""Table algebra: pure functions from tables to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of keys under which nulls are equal."""
    cond = left[keys[0]].eqNullSafe(right[keys[0]])
    for k in keys[1:]:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def keys_of(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def without_keys(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is not in ``gone``; a null key equals a null key."""
    other = keys_of(gone, keys).alias("gone")
    return df.join(other, _same(df, other, keys), "left_anti")


def with_keys(df: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    other = keys_of(kept, keys).alias("kept")
    return df.join(other, _same(df, other, keys), "left_semi")


def keyed_replace(existing: DataFrame, batch: DataFrame, keys: list[str], touched: DataFrame | None = None) -> DataFrame:
    """``existing`` without the batch's keys, and the batch; columns are the union of both.

    ``touched`` names keys whose rows go even if the batch has none for them.
    """
    left = without_keys(existing, batch, keys)
    if touched is not None:
        left = without_keys(left, touched, keys)
    return left.unionByName(batch, allowMissingColumns=True)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``, which must decide ties.

    As a grouped maximum of one struct instead of a ranking, so rows of a hot key are combined before the shuffle.
    ``order`` entries are columns to maximise.
    """
    ranked = F.struct(*[o.alias(f"__o{k}") for k, o in enumerate(order)], F.struct(*[F.col(c) for c in df.columns]).alias("__row"))
    best = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max(ranked).alias("__best"))
    return best.select("__best.__row.*")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """As ``latest_per_key`` with columns to minimise."""
    ranked = F.struct(*[o.alias(f"__o{k}") for k, o in enumerate(order)], F.struct(*[F.col(c) for c in df.columns]).alias("__row"))
    best = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min(ranked).alias("__best"))
    return best.select("__best.__row.*")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct()


def current_plus_history(current: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """All current rows, and those of history whose key is not current."""
    return current.unionByName(without_keys(history, current, keys), allowMissingColumns=True)


def capped(df: DataFrame, order: list[Column], limit: int) -> tuple[DataFrame, DataFrame]:
    """The first ``limit`` rows in order (a report's own limit), and how many were deferred."""
    return df.orderBy(*order).limit(limit), df.agg(F.greatest(F.count(F.lit(1)) - limit, F.lit(0)).alias("deferred"))


def duplicate_groups(df: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Keys with more than one distinct member, with the members in order."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(member)).alias("members")).where(F.size("members") > 1)


def lookup(df: DataFrame, mapping: DataFrame, key: str, mapped_key: str, value: str, missing: str | None = None) -> DataFrame:
    """``df`` with ``value`` from a mapping with unique ``mapped_key``; a miss is null, or ``missing``.

    No broadcast hint: the mapping is broadcast if its size is under Spark's threshold, and shuffled beyond it.
    """
    named = mapping.select(F.col(mapped_key).alias("__k"), F.col(value).alias("__v"))
    out = df.join(named, df[key] == F.col("__k"), "left")
    return out.withColumn(value, F.col("__v") if missing is None else F.coalesce("__v", F.lit(missing))).drop("__k", "__v")


def pivot_max(df: DataFrame, keys: list[str], by: str, values: list[str], measure: str) -> DataFrame:
    """One column for each of the known ``values``, by conditional aggregation; keys are the union over all values."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(by) == v, F.col(measure))).alias(v) for v in values])


def shares_with_previous(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """``df`` with ``days_since`` the previous row of the key."""
    return df.withColumn("days_since", F.date_diff(day, F.lag(day).over(Window.partitionBy(*keys).orderBy(day))))
