"""Grouped summaries. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.functions.columns import named, parse_flag, quoted


def distinct_dim(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct combinations of some columns, in their own order."""
    return df.select(*map(named, columns)).distinct().orderBy(*map(named, columns))


def zero_count(df: DataFrame, keys: Sequence[str], measure: str, alias: str) -> DataFrame:
    """Rows per key whose measure is zero, most first; keys without one are absent."""
    return (
        df.filter(named(measure) == 0)
        .groupBy(*map(named, keys))
        .agg(F.count(named(measure)).alias(alias))
        .orderBy(named(alias).desc(), *map(named, keys))
    )


def zero_count_sql(df: DataFrame, keys: Sequence[str], measure: str, alias: str) -> DataFrame:
    """``zero_count`` in SQL text, for callers who work on views."""
    by, total = ", ".join(map(quoted, keys)), quoted(alias)
    return df.sparkSession.sql(
        f"SELECT {by}, count({quoted(measure)}) AS {total} FROM {{rows}}"
        f" WHERE {quoted(measure)} = 0 GROUP BY {by} ORDER BY {total} DESC, {by}",
        rows=df,
    )


def pin_boolean(df: DataFrame, column: str) -> DataFrame:
    """Make a true/false column boolean, whatever type the scan gave it."""
    if df.schema[column].dataType.simpleString() == "boolean":
        return df
    return df.withColumn(column, parse_flag(named(column)))


def outcome_count(
    df: DataFrame, flag: str, outcome: bool, keys: Sequence[str], alias: str, sort_by: str
) -> DataFrame:
    """Rows per key with one outcome, by ``sort_by`` descending."""
    kept = pin_boolean(df, flag).filter(named(flag) if outcome else ~named(flag))
    return _by_key(kept.groupBy(*map(named, keys)).agg(F.count("*").alias(alias)), keys, sort_by)


def outcome_counts(
    df: DataFrame, flag: str, keys: Sequence[str], true_alias: str, false_alias: str
) -> DataFrame:
    """Both outcomes per key in one scan and one shuffle."""
    pinned = pin_boolean(df, flag)
    return (
        pinned.filter(named(flag).isNotNull())
        .groupBy(*map(named, keys))
        .agg(
            F.count_if(named(flag)).alias(true_alias),
            F.count_if(~named(flag)).alias(false_alias),
        )
    )


def one_outcome(counts: DataFrame, keys: Sequence[str], alias: str, sort_by: str) -> DataFrame:
    """One side of ``outcome_counts``: the keys that have such a row at all."""
    kept = counts.filter(named(alias) > 0).select(*map(named, keys), named(alias))
    return _by_key(kept, keys, sort_by)


def _by_key(df: DataFrame, keys: Sequence[str], sort_by: str) -> DataFrame:
    rest = [named(key) for key in keys if key != sort_by]
    return df.orderBy(named(sort_by).desc(), *rest)
