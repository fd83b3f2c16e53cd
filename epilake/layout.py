"""Where things lie in the lake. Roots are URIs of any Hadoop file system."""

from __future__ import annotations

from dataclasses import dataclass, field

from epilake.sources.dialect import STAGED, CsvDialect
from epilake.sources.headers import Drift

FORMATS = ("parquet", "csv")


@dataclass(frozen=True)
class Batch:
    """One landed snapshot of a dataset.

    ``malformed`` counts records with a wrong number of fields; ``drift`` says how its
    columns differ from those of the batch before, None if there was none to compare with.
    """

    dataset: str
    process_date: str
    uuid: str
    malformed: int = field(default=0, compare=False)
    drift: Drift | None = field(default=None, compare=False)


@dataclass(frozen=True)
class LakeLayout:
    """Roots and formats of the raw and curated layers.

    Parquet is the default for both layers: scans prune columns and skip row
    groups, and NULL stays distinct from the empty string. ``csv`` keeps the
    layers readable by plain text tools; every part file carries the header.
    ``max_records`` starts a new file after so many rows, for tasks whose
    output is out of proportion, such as that of one large archive.
    """

    raw: str
    curated: str
    raw_format: str = "parquet"
    curated_format: str = "parquet"
    raw_dialect: CsvDialect = field(default=STAGED)
    curated_dialect: CsvDialect = field(default=STAGED)
    max_records: int = 20_000_000

    def __post_init__(self) -> None:
        for name in (self.raw_format, self.curated_format):
            if name not in FORMATS:
                raise ValueError(f"unknown layer format {name!r}; use one of {FORMATS}")

    def dataset_path(self, dataset: str) -> str:
        return f"{self.raw.rstrip('/')}/{dataset}"

    def batch_path(self, batch: Batch) -> str:
        folder = f"{self.dataset_path(batch.dataset)}/{batch.process_date}/{batch.uuid}"
        return f"{folder}/{batch.dataset}.{self.raw_format}"

    def control_path(self, dataset: str) -> str:
        return f"{self.dataset_path(dataset)}/Control_file_{dataset}.txt"

    def pointer_path(self, dataset: str, sequence: int) -> str:
        """The pointer file of one landing; greater numbers are later."""
        return f"{self.control_path(dataset)}/{sequence:019d}.csv"

    def header_path(self, batch: Batch) -> str:
        """Where the columns of a landed batch are kept; readers of the pointers skip names with ``_``."""
        return f"{self.control_path(batch.dataset)}/_header-{batch.process_date}-{batch.uuid}.json"

    def output_path(self, output: str) -> str:
        return f"{self.curated.rstrip('/')}/{output}"

    def schema_path(self, output: str, process_date: str) -> str:
        """Where the types of a text output are kept; readers of the output skip names with ``_``."""
        return f"{self.output_path(output)}/_schema/process_date={process_date}"

    def curated_path(self, output: str, process_date: str) -> str:
        return f"{self.output_path(output)}/process_date={process_date}"
