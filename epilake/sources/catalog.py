"""The JSON catalogue of sources, and the plan of what to land."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType

from epilake.functions.columns import dated_url, plain_url, route

# ``Atualizacao`` names the update rhythm; see ``in_period`` for its two shapes.
CATALOG_SCHEMA = "base STRING, source STRING, dataset STRING, type STRING, Atualizacao STRING"
CATALOG_SCHEMA_PERIODS = CATALOG_SCHEMA.replace("Atualizacao STRING", "Atualizacao ARRAY<STRING>")

ROUTES = {"csv": "csv", "zip": "zip"}


def read_catalog(spark: SparkSession, path: str, schema: str = CATALOG_SCHEMA) -> DataFrame:
    """The catalogue file: a JSON array with one object per source."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def in_period(column: Column, data_type: DataType, period: str) -> Column:
    """Whether the rhythm contains the period: a substring, or a list element."""
    if isinstance(data_type, ArrayType):
        return F.array_contains(column, period)
    return F.contains(column, F.lit(period))


def landing_plan(
    catalog: DataFrame, period: str, run_date: dt.date, run_id: str
) -> DataFrame:
    """What one run has to land: dataset, route, url, process_date, uuid.

    Entries of another period or of a type without a route are left out, and an
    entry that is listed twice is landed once. One
    run date serves every entry, so url and batch can never disagree about it.
    """
    when = F.lit(run_date).cast("date")
    base, source, kind = F.col("base"), F.col("source"), F.col("type")
    due = in_period(F.col("Atualizacao"), catalog.schema["Atualizacao"].dataType, period)
    return (
        catalog.filter(due)
        .withColumn("route", route(kind, ROUTES))
        .filter(F.col("route").isNotNull())
        .select(
            "dataset",
            "route",
            F.when(F.col("route") == "csv", dated_url(base, source, kind, when))
            .otherwise(plain_url(base, source, kind))
            .alias("url"),
            F.date_format(when, "yyyyMMdd").alias("process_date"),
            F.lit(run_id).alias("uuid"),
        )
        .distinct()
    )
