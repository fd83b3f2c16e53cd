"""Pointers to current batches: numbered files, each created by one landing alone."""

from __future__ import annotations

import csv
import re

from pyspark.sql import SparkSession

from epilake.layout import Batch, LakeLayout
from epilake.sinks.storage import create_file, file_names, read_file, remove_file
from epilake.sources.dialect import CONTROL
from epilake.sources.headers import Drift, Header

_NUMBERED = re.compile(r"(\d{19})\.csv")


def _line(*values: str) -> str:
    mark, escape = CONTROL.quote, CONTROL.escape
    quoted = [mark + v.replace(escape, escape * 2).replace(mark, escape + mark) + mark for v in values]
    return CONTROL.sep.join(quoted) + "\n"


def _last(names: list[str]) -> int:
    return max((int(found.group(1)) for found in map(_NUMBERED.fullmatch, names) if found), default=0)


def write_pointer(spark: SparkSession, layout: LakeLayout, batch: Batch) -> int:
    """Make a landed batch the current one; returns the number of its pointer. The commit point of a landing.

    The pointer is a new file beside the earlier ones, named by the next number
    that no other landing has taken, and the greatest number counts: neither
    clocks nor time stamps of the store decide, and there is no moment without a
    pointer. A plain file that another program left in the folder's place is
    replaced.
    """
    folder = layout.control_path(batch.dataset)
    names = file_names(spark, folder)
    if names is None:
        remove_file(spark, folder)
        names = []
    number, text = _last(names) + 1, _line(batch.process_date, batch.uuid)
    while not create_file(spark, layout.pointer_path(batch.dataset, number), text):
        number += 1
    return number


def last_batch(spark: SparkSession, layout: LakeLayout, dataset: str) -> Batch | None:
    """The batch of the greatest numbered pointer, without a job; None if there is no such pointer."""
    number = _last(file_names(spark, layout.control_path(dataset)) or [])
    text = read_file(spark, layout.pointer_path(dataset, number)) if number else None
    rows = [row for row in csv.reader([text], delimiter=CONTROL.sep, escapechar=CONTROL.escape) if row] if text else []
    return Batch(dataset, *rows[0][:2]) if rows and len(rows[0]) >= 2 else None


def record_header(spark: SparkSession, layout: LakeLayout, batch: Batch, header: Header) -> Drift | None:
    """Keep the columns of a batch, before its pointer is written; returns how they differ from those of the current batch.

    None if there is no current batch, or none whose columns were kept.
    """
    create_file(spark, layout.header_path(batch), header.to_json(), overwrite=True)
    current = last_batch(spark, layout, batch.dataset)
    text = read_file(spark, layout.header_path(current)) if current else None
    return header.drift_from(Header.from_json(text)) if text else None
