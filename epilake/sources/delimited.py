"""Scans of delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from epilake.sources.dialect import CsvDialect

#: Column of landed batches with the whole text of a record whose field count is wrong, else NULL.
MALFORMED = "_registro_malformado"


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    dialect: CsvDialect,
    schema: StructType | str | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Scan files that share one dialect, as one job however many there are.

    Without ``schema`` the names come from the header (one line is read) and
    every column is text; typing is a later, explicit step. ``corrupt_column``
    keeps the raw text of records whose field count is wrong.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.options(**dialect.read_options()).option("mode", "PERMISSIVE")
    if corrupt_column is not None:
        if schema is None:
            schema = reader.csv(paths).schema
        elif isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(paths)


def discover_schema(
    spark: SparkSession,
    paths: str | Sequence[str],
    dialect: CsvDialect,
    sampling_ratio: float = 1.0,
) -> StructType:
    """Types that the text of the files suggests.

    Reads the data once more, so it is for looking at new datasets and for
    writing a registry entry, not for the daily path.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.options(**dialect.read_options())
        .option("inferSchema", "true")
        .option("samplingRatio", str(sampling_ratio))
        .csv(paths)
        .schema
    )
