"""Splitting and hashing of strings as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 1 << 32


def split_words(text: Column, delimiter: str = " ") -> Column:
    """Split on a one-character delimiter; empty pieces at the end are dropped, others are kept.

    A text made of delimiters only has no pieces; the empty text has one empty piece.
    """
    if len(delimiter) != 1:
        raise ValueError("the delimiter must be one character")
    body = F.rtrim(text, F.lit(delimiter))
    pieces = F.split(body, re.escape(delimiter))
    only_delimiters = (body == "") & (text != "")
    return F.when(only_delimiters, F.array().cast("array<string>")).otherwise(pieces)


def string_hash(text: Column) -> Column:
    """The signed 32-bit polynomial hash (factor 31) over UTF-16 units, as an int."""

    def step(h: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")
        high = F.floor((code - 0x10000) / F.lit(0x400)) + 0xD800
        low = (code - 0x10000) % 0x400 + 0xDC00
        one_unit = h * 31 + code
        two_units = (h * 31 + high) * 31 + low
        return F.when(code > 0xFFFF, two_units).otherwise(one_unit) % TWO_32

    folded = F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), step)
    signed = F.when(folded >= TWO_32 // 2, folded - TWO_32).otherwise(folded)
    return F.when(text == "", F.lit(0)).otherwise(signed).cast("int")


def to_long(text: Column) -> Column:
    """Trimmed text to bigint, also with a trailing ``L``; unreadable text becomes null."""
    return F.regexp_replace(F.trim(text), "[lL]$", "").try_cast("bigint")
