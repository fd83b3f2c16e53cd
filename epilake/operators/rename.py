"""Projections: renames, drops, sorted reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epilake.functions.columns import named


class MissingColumnsError(ValueError):
    """Columns that an operator needs are not in its input."""


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    present = {column.lower() for column in df.columns}
    missing = [name for name in names if name.lower() not in present]
    if missing:
        raise MissingColumnsError(f"missing columns {missing!r}; the input has {df.columns!r}")


def rename_strict(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns, in one projection; every source column must be there.

    A plain rename ignores names that do not match, for example when a header
    lost its trailing blank, and the error shows up far downstream. A new name
    that another column already has is an error, too.
    """
    require_columns(df, names)
    sources = {name.lower() for name in names}
    kept = [column.lower() for column in df.columns if column.lower() not in sources]
    result = kept + [name.lower() for name in names.values()]
    doubled = sorted({name for name in result if result.count(name) > 1})
    if doubled:
        raise MissingColumnsError(f"renaming would give several columns {doubled!r}")
    new = {name.lower(): target for name, target in names.items()}
    return df.select(*[named(c).alias(new.get(c.lower(), c)) for c in df.columns])


def sort_desc(df: DataFrame, column: str) -> DataFrame:
    """Largest first, NULL last; the other columns break ties.

    The ties matter for size as well as for repeatable output: the range
    partitioning of the sort can then divide the rows of one frequent value.
    Full copies of one row are divided by the input split they come from,
    which is the same when a task runs again.
    """
    ties = [named(other).desc_nulls_last() for other in df.columns if other != column]
    split = df.withColumn("__split", F.spark_partition_id())
    return split.orderBy(named(column).desc_nulls_last(), *ties, "__split").drop("__split")
