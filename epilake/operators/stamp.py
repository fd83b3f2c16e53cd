"""Dates: parsing, stamping, and counting what did not parse."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from epilake.functions.columns import named, parse_date


def stamp(df: DataFrame, column: str, run_date: dt.date | None = None) -> DataFrame:
    """Add the run date. Without one it is today's date of the session zone."""
    value: Column = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return df.withColumn(column, value)


def parse_date_column(
    df: DataFrame, column: str, *patterns: str, rejects: Observation | None = None
) -> DataFrame:
    """Replace a text column by the date it states, NULL where it states none.

    ``rejects`` receives ``rejected``, the number of texts that did not parse,
    as a by-product of whatever action runs the result: no second scan. It is
    for reports: tasks that run again after a lost executor count again.
    """
    if df.schema[column].dataType.simpleString() == "date":
        return df
    text = named(column).cast("string")
    if rejects is None:
        return df.withColumn(column, parse_date(text, *patterns))
    # Parsed below the observation, so that both use the one result.
    parsed = df.withColumn("__parsed", parse_date(text, *patterns))
    lost = F.count_if(text.isNotNull() & F.col("__parsed").isNull())
    observed = parsed.observe(rejects, lost.alias("rejected"))
    return observed.withColumn(column, F.col("__parsed")).drop("__parsed")
