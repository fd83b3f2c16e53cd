"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster the session comes from the submitter; nothing in the package
    depends on the settings made here except the UTC session zone.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("epilake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Every call returns a new path, so reruns never read or remove older data.
    Nothing here removes one either: a result may still be read from it. Whoever
    owns the folder clears it between runs. Only a local session may fall back
    to a temporary folder of the machine.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="epilake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
