from __future__ import annotations

import zlib

import pytest
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark: SparkSession):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang, source)``, over a few partitions."""

    def make(*rows: tuple, partitions: int = 3) -> DataFrame:
        full = [(*r, *(("en", "a")[len(r) - 2 :]), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


def crc_class(doc_id: int, modulus: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % modulus
