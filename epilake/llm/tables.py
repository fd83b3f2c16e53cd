"""Small helpers that several operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: work done once, and lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``function`` on every Arrow batch of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)
        pa.default_memory_pool().release_unused()  # workers outlive their tasks

    return df.mapInArrow(run, schema)


def anonymous(docs: DataFrame, *kept: str) -> DataFrame:
    """``docs`` with its columns named by place, but for those of ``kept``: no name can clash with one that is added."""
    return docs.toDF(*[c if c in kept else f"c{place}" for place, c in enumerate(docs.columns)])


def crc_class(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def shared_file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """A file system for a folder that all executors share, from its URI or plain path."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def with_row_ids(docs: DataFrame) -> DataFrame:
    """``docs`` and ``row_id``, a number of its own for every row: its ``doc_id``, or a place in a stored copy where ids repeat or are NULL."""
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1)
    if ids.isEmpty() and docs.where("doc_id IS NULL").limit(1).isEmpty():
        return docs.withColumn("row_id", F.col("doc_id"))
    return stored(docs.withColumn("row_id", F.monotonically_increasing_id()), "numbered")
