"""Control files: one small pointer per dataset to its current batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.layout import Batch, LakeLayout
from epilake.sources.delimited import read_delimited
from epilake.sources.dialect import CONTROL

# Both are text: a date such as 20221103 must not turn into a number.
POINTER_SCHEMA = "process_date STRING, uuid STRING"


class ControlFileError(LookupError):
    """A dataset has no usable control file."""


def parse_pointer(line: Column) -> Column:
    """The pointer in one line of a control file, as a struct."""
    return F.from_csv(line, POINTER_SCHEMA, CONTROL.record_options())


def latest_pointers(pointers: DataFrame, key: str, *first: str) -> DataFrame:
    """The greatest (process_date, uuid) per key, among those greatest in the columns of ``first``."""
    newest = F.max(F.struct(*first, "process_date", "uuid")).alias("newest")
    return pointers.groupBy(key).agg(newest).select(key, "newest.process_date", "newest.uuid")


def read_control_files(
    spark: SparkSession, layout: LakeLayout, datasets: Sequence[str]
) -> DataFrame:
    """All pointers of some datasets, in one scan: dataset, process_date, uuid, sequence, written.

    ``sequence`` is the number in the name of the pointer's file, and 0 for the
    files of other programs, which have none.
    """
    paths = [layout.control_path(dataset) for dataset in datasets]
    scan = read_delimited(spark, paths, CONTROL, POINTER_SCHEMA)
    # The path is percent-encoded, and a literal plus sign in it is not a blank.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    dataset = F.regexp_extract(path, r"/Control_file_([^/]+)\.txt(?:/[^/]*)?$", 1)
    number = F.regexp_extract(path, r"/(\d{19})\.csv$", 1)
    sequence = F.when(number != "", number.cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("sequence")
    written = F.col("_metadata.file_modification_time").alias("written")
    return scan.select(dataset.alias("dataset"), "process_date", "uuid", sequence, written)


def _found(spark: SparkSession, layout: LakeLayout, datasets: Sequence[str]) -> dict[str, Batch]:
    pointers = read_control_files(spark, layout, datasets).filter(
        F.col("process_date").isNotNull() & F.col("uuid").isNotNull()
    )
    rows = latest_pointers(pointers, "dataset", "sequence", "written").collect()
    return {row["dataset"]: Batch(**row.asDict()) for row in rows}


def latest_batches(
    spark: SparkSession, layout: LakeLayout, datasets: Sequence[str]
) -> dict[str, Batch]:
    """The current batch of each dataset, all from one job.

    The pointer file with the greatest number counts; among files without one,
    the latest, and in it the greatest date and id. Only the pointers reach the
    driver: one row per dataset.
    """
    found = _found(spark, layout, datasets)
    empty = [dataset for dataset in datasets if dataset not in found]
    if empty:
        raise ControlFileError(f"control file without a pointer for {empty!r}")
    return found


def current_batches(
    spark: SparkSession, layout: LakeLayout, datasets: Sequence[str]
) -> tuple[dict[str, Batch], dict[str, Exception]]:
    """The current batches there are, and why each other dataset has none.

    One job, unless control files are missing; then one for each dataset.
    """
    try:
        found, reasons = _found(spark, layout, datasets), {}
    except AnalysisException:
        found, reasons = {}, {}
        for dataset in datasets:
            try:
                found |= _found(spark, layout, [dataset])
            except AnalysisException as error:
                reasons[dataset] = error
    for dataset in datasets:
        if dataset not in found and dataset not in reasons:
            reasons[dataset] = ControlFileError(f"control file without a pointer for {[dataset]!r}")
    return found, reasons
