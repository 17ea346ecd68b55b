"""Null-safe text assembly and pattern matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from biblioscope.functions.patterns import java_pattern


def ci_match(text: Column, pattern: str | None) -> Column:
    """Case-insensitive search for ``pattern`` anywhere in ``text``.

    Patterns are the database's (``patterns``); what is none there raises ``ValueError``.  A NULL pattern matches
    nothing, and a NULL text gives NULL, so that a filter on either the match or its negation drops the row.
    """
    if pattern is None:
        return F.lit(None).cast("boolean")
    return text.rlike(java_pattern(pattern))


def skip_null_concat(*parts: Column) -> Column:
    """Concatenation in which a NULL part counts as empty text."""
    return F.concat_ws("", *parts)


def normalised(text: Column) -> Column:
    """Key for matching typed-in names: surrounding spaces and letter case ignored."""
    return F.lower(F.trim(text))


def call_number(prefix: Column, number: Column, volume: Column, copy: Column, fallback: Column) -> Column:
    """Shelf call number of an item, or ``fallback`` where the item has none.

    The copy is shown only when it differs from ``1``; an unknown copy is not shown.
    """
    volume_part = F.when(volume.isNotNull(), skip_null_concat(F.lit(" "), volume))
    copy_part = F.when(copy != "1", skip_null_concat(F.lit(" c."), copy))
    own = F.trim(skip_null_concat(prefix, F.lit(" "), number, volume_part, copy_part))
    return F.when(number.isNull(), fallback).otherwise(own)


def class_list_call_number(prefix: Column, number: Column, volume: Column, copy: Column) -> Column:
    """Call number as the class list prints it: the number twice, blanks kept for absent parts."""
    blank = F.lit(" ")
    return F.trim(skip_null_concat(prefix, blank, number, blank, number, blank, volume, blank, copy))


def record_link(hrid: Column, record_url: str) -> Column:
    """Catalogue address of a record; ids starting with ``b`` are addressed by 8 characters."""
    short = F.when(hrid.startswith("b"), F.left(hrid, F.lit(8))).otherwise(hrid)
    return skip_null_concat(F.lit(record_url), short)
