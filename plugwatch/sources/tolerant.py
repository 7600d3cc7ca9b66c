"""Records out of JSON files that are broken in part.

Spark reads a file that holds one JSON array as a whole, and gives it up as a whole where one
element is broken. Here the text of such a file is cut into its elements: those before and
after the broken one come back, and what can't be read is told with its place and a reason.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Functions that run in tasks travel with the job, so executors need not have the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTS_DDL = "array<struct<position:bigint,record:string,reason:string>>"
_SPACE = re.compile(r"[\s,]*")
# Where a record may start again: after a comma, a bracket or a line break.
_START = re.compile(r"[,\[\n]\s*(?=\{)")
_BLANK = re.compile(r"\s*")


def _value(text: str, at: int) -> tuple[object, int] | None:
    """The JSON value at ``at`` and its end, if it is whole and something fit follows."""
    try:
        value, end = json.JSONDecoder().raw_decode(text, at)
    except (ValueError, RecursionError):
        return None
    after = _BLANK.match(text, end).end()
    return (value, end) if after == len(text) or text[after] in ",]{" else None


def _resume(text: str, at: int, fields: frozenset[str]) -> int:
    """The next place from ``at`` where a whole record starts: an object with one of the ``fields``,
    so that one nested in a broken record is not taken for a record."""
    for m in _START.finditer(text, at):
        found = _value(text, m.end())
        if found and isinstance(found[0], dict) and not fields.isdisjoint(found[0]):
            return m.end()
    return len(text)


def split_records(text: str, fields: frozenset[str]) -> Iterator[tuple[int, str, str | None]]:
    """``(position, text, reason)`` of each element of a JSON array, or of objects one after the
    other. ``reason`` is null for a record, else ``broken``, ``not a record``, ``encoding`` (bytes
    that are no UTF-8, decoded as lone surrogates) or ``after the end``. Positions are characters of
    the text. A blank text has no elements."""
    at = _SPACE.match(text).end()
    array = text[at:at + 1] == "["
    at += array
    while True:
        at = _SPACE.match(text, at).end()
        if at >= len(text):
            return
        if array and text[at] == "]":
            rest = text[at + 1:]
            if rest.strip():
                yield at + 1, rest, "after the end"
            return
        found = _value(text, at)
        if found:
            value, end = found
            reason = None if isinstance(value, dict) else "not a record"
            if any("\udc80" <= c <= "\udcff" for c in text[at:end]):
                reason = "encoding"
        else:
            end, reason = _resume(text, at + 1, fields), "broken"
        yield at, text[at:end].rstrip(", \t\r\n"), reason
        at = end


def split_parts(text: Column, fields: list[str]) -> Column:
    """``split_records`` of a column of texts, as an array; null for null."""
    known = frozenset(fields)

    def one(data: bytes | None):
        if data is None:
            return None
        told = split_records(bytes(data).decode("utf-8", "surrogateescape"), known)
        return [{"position": at, "record": part.encode("utf-8", "replace").decode(), "reason": reason}
                for at, part, reason in told]

    @F.pandas_udf(PARTS_DDL)
    def split(texts: pd.Series) -> pd.Series:
        return pd.Series([one(t) for t in texts], dtype="object")

    return split(text.cast("binary"))
