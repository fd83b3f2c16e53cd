"""Column expressions that several operators share."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters the name holds."""
    return F.col(quoted(name))


#: Stands for a date with a time of day: blank or ``T`` between them, fractions and a zone allowed.
ISO_TIME = "iso date and time"
_ISO_SHAPE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}([.]\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?$"


def parse_date(column: Column, *patterns: str) -> Column:
    """The date in a text, by the pattern that fits it; NULL if none does.

    Malformed text gives NULL under ANSI mode too, where ``to_date`` raises.
    A text is parsed only by a pattern of its own shape (each letter of the
    pattern stands for one digit), since a failed parse costs an exception.
    With ``ISO_TIME`` the date is the one written, whatever the zone.
    """
    chain = None
    for pattern in patterns:
        if pattern == ISO_TIME:
            valid = column.try_cast("timestamp_ntz").isNotNull()
            shape, value = _ISO_SHAPE, F.when(valid, F.try_to_date(F.substring(column, 1, 10), "yyyy-MM-dd"))
        else:
            shape = "^" + re.sub("[A-Za-z]", r"\\d", pattern) + "$"
            value = F.try_to_date(column, pattern)
        chain = (F if chain is None else chain).when(column.rlike(shape), value)
    return chain


def parse_int(column: Column, target: str = "bigint") -> Column:
    """A whole number in a text, ``12.0`` included; NULL for other text and for numbers too large.

    The shape test gives what ``try_cast`` alone would, without an exception
    for every value that is not a number.
    """
    text = column.cast("string")
    whole = text.rlike(r"^[\x00-\x20]*[+-]?[0-9]+([.]0*)?[\x00-\x20]*$")
    return F.when(whole, F.regexp_replace(text, r"[.]0*[\x00-\x20]*$", "").try_cast(target))


def parse_flag(column: Column) -> Column:
    """A boolean from ``true/false/1/0`` in any case; NULL for other text."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin("true", "1"), F.lit(True)).when(text.isin("false", "0"), F.lit(False))


def dated_url(base: Column, source: Column, kind: Column, when: Column) -> Column:
    """``{base}{yyyy}/{MM}/{yyyyMMdd}_{source}.{kind}``, all parts of one date."""
    return F.concat(base, F.date_format(when, "yyyy/MM/yyyyMMdd"), F.lit("_"), source, F.lit("."), kind)


def plain_url(base: Column, source: Column, kind: Column) -> Column:
    """``{base}{source}.{kind}``, for files that are published undated."""
    return F.concat(base, source, F.lit("."), kind)


def route(column: Column, cases: Mapping[str, str]) -> Column:
    """The route of the first case that equals the value; NULL for any other."""
    chain = None
    for value, target in cases.items():
        chain = (F if chain is None else chain).when(column == value, F.lit(target))
    return chain
