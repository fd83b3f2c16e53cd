"""File sinks of the raw and curated layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from epilake.functions.columns import named
from epilake.layout import Batch, LakeLayout
from epilake.sinks.history import DATE_COLUMN, date_schema, read_all_dates, record_schema
from epilake.sources.delimited import MALFORMED, read_delimited
from epilake.sources.dialect import CsvDialect


def write_rows(df: DataFrame, path: str, fmt: str, dialect: CsvDialect, max_records: int = 0) -> None:
    """Replace one directory. Every task writes its own part files.

    ``max_records`` bounds the rows of a file; 0 leaves them unbounded.
    """
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records)
    if fmt == "csv":
        writer.options(**dialect.write_options()).csv(path)
    else:
        writer.format(fmt).save(path)


def write_batch(df: DataFrame, layout: LakeLayout, batch: Batch) -> int:
    """Land a batch; returns its malformed records. It stays invisible until its pointer is written."""
    counted = Observation()
    bad = F.count_if(named(MALFORMED).isNotNull()) if MALFORMED in df.columns else F.count_if(F.lit(False))
    rows = df.observe(counted, bad.alias("malformed"))
    path = layout.batch_path(batch)
    write_rows(rows, path, layout.raw_format, layout.raw_dialect, layout.max_records)
    return counted.get.get("malformed", 0)


def write_curated(df: DataFrame, layout: LakeLayout, output: str, process_date: str) -> DataFrame:
    """Replace one output of one date and return what to derive further from.

    The new rows are staged and take the place of the date's earlier ones when
    the job has succeeded; a job that fails leaves those as they were. An empty
    result clears an earlier one. The returned frame scans the Parquet just
    written, which is narrower and cheaper than the source; text layers return
    the input itself. The types are kept beside the output.
    """
    if DATE_COLUMN in {column.lower() for column in df.columns}:
        raise ValueError(f"{DATE_COLUMN!r} is the name of the output's date")
    spark, path = df.sparkSession, layout.curated_path(output, process_date)
    written = Observation()
    writer = (
        df.observe(written, F.count("*").alias("rows"))
        .withColumn(DATE_COLUMN, F.lit(process_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", layout.max_records)
        .partitionBy(DATE_COLUMN)
    )
    if layout.curated_format == "csv":
        writer = writer.options(**layout.curated_dialect.write_options())
    writer.format(layout.curated_format).save(layout.output_path(output))
    if not written.get.get("rows", 0):  # no rows, no partition to replace
        empty = spark.createDataFrame([], df.schema)
        write_rows(empty, path, layout.curated_format, layout.curated_dialect)
    record_schema(spark, layout, output, process_date, df.schema)
    return spark.read.schema(df.schema).parquet(path) if layout.curated_format == "parquet" else df


def _read_date(spark: SparkSession, layout: LakeLayout, output: str, date: str, infer: bool) -> DataFrame:
    path = layout.curated_path(output, date)
    if layout.curated_format == "parquet":
        return spark.read.parquet(path)
    return read_delimited(spark, path, layout.curated_dialect, date_schema(spark, layout, output, date, infer))


def read_curated(
    spark: SparkSession,
    layout: LakeLayout,
    output: str,
    process_date: str | None = None,
    infer: bool = True,
) -> DataFrame:
    """One output of one date, or of all dates with ``process_date`` as a column.

    Over all dates a column is there if any date has it, NULL where a date
    lacks it, in a type that holds every date's values exactly: a wider number,
    or text where no number does. Types come from the records that the writes
    left; dates of other programs are looked into, and text outputs among them
    are text, or inferred with ``infer``.
    """
    if process_date is not None:
        return _read_date(spark, layout, output, process_date, infer)
    return read_all_dates(spark, layout, output, infer)
