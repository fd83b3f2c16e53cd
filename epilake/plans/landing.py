"""Landing: from catalogue entries to batches with pointers."""

from __future__ import annotations

import datetime as dt
import uuid
from collections import defaultdict
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from epilake.layout import Batch, LakeLayout
from epilake.sinks.files import write_batch
from epilake.sinks.pointers import record_header, write_pointer
from epilake.sources.archive import ArchiveStore, read_zipped_delimited
from epilake.sources.catalog import landing_plan
from epilake.sources.control import current_batches
from epilake.sources.delimited import MALFORMED, read_delimited
from epilake.sources.dialect import CsvDialect
from epilake.sources.headers import Header
from epilake.sources.registry import REGISTRY, DatasetSpec, inferred, read_landed


class LandingError(RuntimeError):
    """Some datasets did not land (``failed``); the others did (``landed``)."""

    def __init__(self, landed: list[Batch], failed: dict[str, Exception]):
        self.landed, self.failed = landed, failed
        detail = "; ".join(f"{name}: {str(error).splitlines()[0]}" for name, error in failed.items())
        super().__init__(f"landed {len(landed)}, failed {len(failed)}: {detail}")


def land(
    spark: SparkSession,
    layout: LakeLayout,
    catalog: DataFrame,
    period: str,
    run_date: dt.date | None = None,
    run_id: str | None = None,
    specs: Mapping[str, DatasetSpec] = REGISTRY,
    store: ArchiveStore | None = None,
    recursive: bool = False,
    spread: int | None = None,
    at_once: int = 4,
    profile: bool = False,
) -> list[Batch]:
    """Land what the catalogue has for one period.

    The url of an entry is a path on any Hadoop file system; archives are opened
    through ``store``, and with ``recursive`` an archive's url may be a folder of
    archives. All files of a dataset are parsed with its own dialect in one
    job, kept as text, and written in parallel; only then does the dataset's
    pointer move. Records with too many or too few fields keep their whole text
    in a column of their own and are counted in the batch. ``spread`` is that
    of ``read_zipped_delimited``. A dataset that fails keeps its old pointer
    and does not stop the others; a ``run_id`` that already names the current
    batch is such a failure.

    ``at_once`` datasets land side by side, as jobs of their own, so that a small
    one does not wait for a large one's last tasks. The columns of a batch are
    kept with its pointer, and ``Batch.drift`` says what changed since the batch
    before; with ``profile`` that includes the types that the values suggest, at the
    price of one more pass over the landed batch.
    """
    run_date = run_date or dt.datetime.now(dt.timezone.utc).date()
    reused = run_id is not None
    run_id = run_id or str(uuid.uuid4())

    # One row per catalogue entry: the plan is small, the files are not.
    urls: dict[str, dict[str, list[str]]] = defaultdict(lambda: defaultdict(list))
    for row in landing_plan(catalog, period, run_date, run_id).collect():
        urls[row["dataset"]][row["route"]].append(row["url"])
    current = current_batches(spark, layout, sorted(urls))[0] if reused and urls else {}

    def read(route: str, paths: list[str], dialect: CsvDialect) -> DataFrame:
        if route == "zip":
            return read_zipped_delimited(spark, paths, dialect, MALFORMED, recursive, store, spread)
        return read_delimited(spark, paths, dialect, corrupt_column=MALFORMED)

    def one(dataset: str) -> Batch | Exception:
        batch = Batch(dataset, f"{run_date:%Y%m%d}", run_id)
        spec = specs.get(dataset, DatasetSpec(dataset, {}))
        try:
            if current.get(dataset) == batch:
                raise ValueError(f"batch {run_id!r} of {batch.process_date} is the current one already")
            rows = reduce(DataFrame.unionByName, [read(route, paths, spec.dialect) for route, paths in urls[dataset].items()])
            malformed = write_batch(rows, layout, batch)
            types = dict(rows.dtypes)
            if profile:
                types |= inferred(read_landed(spark, layout, batch), DatasetSpec(dataset, {})).columns
            header = Header(tuple((name, types[name]) for name in rows.columns if name != MALFORMED))
            drift = record_header(spark, layout, batch, header)
            write_pointer(spark, layout, batch)
            return replace(batch, malformed=malformed, drift=drift)
        except (PySparkException, Py4JJavaError, ValueError) as error:
            return error

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        done = dict(zip(urls, pool.map(inheritable_thread_target(spark)(one), urls), strict=True))
    landed = [batch for batch in done.values() if isinstance(batch, Batch)]
    failed = {dataset: error for dataset, error in done.items() if isinstance(error, Exception)}
    if failed:
        raise LandingError(landed, failed)
    return landed
