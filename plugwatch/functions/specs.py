"""Voltage, current and power mentions in free text, with their input/output context.

Everything is an in-row expression: no rows are exploded and nothing is shuffled. One
``regexp_replace`` per quantity rewrites each match into a record that carries the match's
groups and its surroundings, so each chunk is scanned once per quantity.

The expressions are SQL text, which Spark parses in one step; as nested Python lambdas each
of their many nodes would be a call into the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.functions.text import SPACE, chunks
from plugwatch.schemas import SPEC_DDL

# --- Fixed values: patterns (i: any case, U: Unicode classes, s: dot matches newline) ---
# Quotes are written as \x27 and \x22 so that patterns fit into SQL literals.
_S = rf"{SPACE}*"
_QUOTE = r"[\x27\x22]"
_DASH = r"[\-–—]"
_NUM3, _NUM4, _NUM2 = r"\d{1,3}(?:\.\d+)?", r"\d{1,4}(?:\.\d+)?", r"\d{1,2}(?:\.\d+)?"
_VUNIT = r"(v|vac|vdc|⎓)"
VOLTS = (
    r"(?:\b(?:ac|dc)\b[^\w]{0,3})?(?:"
    rf"({_NUM3}){_S}{_VUNIT}?{_S}(?:{_DASH}|/){_S}({_NUM3}){_S}{_VUNIT}?"
    rf"|({_NUM3}){_S}{_VUNIT}"
    rf"|(?:(?:rated{SPACE}+)?voltage){_S}[:\-]?{_S}({_NUM4}){_S}{_VUNIT}?"
    rf"|{_QUOTE}?name{_QUOTE}?{_S}[:=]{_S}{_QUOTE}?voltage{_QUOTE}?{_S},{_S}"
    rf"{_QUOTE}?value{_QUOTE}?{_S}[:=]{_S}{_QUOTE}?"
    rf"({_NUM4}){_S}{_VUNIT}?{_QUOTE}?)"
)
AMPS = rf"({_NUM2})(?:{_S}(?:{_DASH}|/){_S}({_NUM2}))?{_S}(ma|a)\b"
WATTS = rf"({_NUM4})(?:{_S}(?:{_DASH}|/){_S}({_NUM4}))?{_S}(kw|w)\b"
HERTZ = rf"(?iU)\d{{2,3}}(?:{_S}(?:{_DASH}|/){_S}\d{{2,3}})?{_S}hz\b"
INPUT_CUES = (
    rf"(?iU)\b(?:input|in|ac{_S}in|dc{_S}in|mains|supply|source|wall|cigarette{_S}lighter"
    rf"|vehicle|car|truck|plug{_S}in)\b"
)
OUTPUT_CUES = (
    rf"(?iU)\b(?:output|out|port|charging|charge|usb(?:[-\s]?(?:c\d?|a\d?))|type[-\s]?c\d?"
    rf"|type[-\s]?a\d?|pd(?:{_S}\d+(?:\.\d+)?)|pps|qc{_S}\d(?:\.\d)?)\b"
)
AC_CUES = rf"(?iU)\b(?:ac|vac|50/60{_S}hz|hz)\b"
DC_CUES = r"(?iU)\b(?:dc|usb|⎓)\b"
PORT = rf"(?iU)\b(?:usb[-\s]?[ca]{_S}(?:\d+)?)\b|\b[ca]\d\b"
PORT_PARTS = rf"(?U)^(?:USB[-\s]?)?([CA]){_S}(\d*)$"
WINDOW = 40
INPUT_WEIGHT, OUTPUT_WEIGHT, AC_WEIGHT, DC_WEIGHT = 3.0, 3.0, 1.5, 1.0
# -----------------------------------------------------------------------------------------

# Record and field marks: Unicode noncharacters, which are never part of text.
_RECORD, _FIELD = chr(0xFDD0), chr(0xFDD1)
# The digits of other scripts that \d matches and Spark's number casts do not read.
_DIGIT_ZEROS = (0x0660, 0x06F0, 0x0966, 0xFF10)
_OTHER_DIGITS = "".join(chr(zero + i) for zero in _DIGIT_ZEROS for i in range(10))


def _record_pattern(core: str) -> str:
    """``core`` with two more groups around it: the text up to ``WINDOW`` characters before
    and after the match.

    The look-behind is tried only where ``core`` matches. Its alternative U+10FFFF never
    occurs in text; a look-behind with a supplementary character counts code points, not
    UTF-16 units, as the window must.
    """
    silent = re.sub(r"\((?!\?)", "(?:", core)
    before = rf"(?<=(\A.{{0,{WINDOW - 1}}}|.{{{WINDOW}}}|" + "\U0010FFFF))"
    return rf"(?iUs)(?={silent}){before}{core}(?=(.{{0,{WINDOW}}}))"


def _records(chunk: str, core: str, fields: tuple[str, ...]) -> str:
    """SQL for one string array per match: its surroundings, then ``fields`` (group
    references)."""
    n = len(re.findall(r"\((?!\?)", core))
    # Group 1 is the text before, the groups of ``core`` follow, then the text after.
    shifted = [re.sub(r"\d+", lambda m: str(int(m.group()) + 1), f) for f in fields]
    record = _RECORD + _FIELD.join([f"$1$0${n + 2}", *shifted]) + _RECORD
    pieces = f"split(regexp_replace({chunk}, r'{_record_pattern(core)}', '{record}'), '{_RECORD}')"
    return (f"transform(filter({pieces}, (piece, i) -> i % 2 = 1),"
            f" piece -> split(piece, '{_FIELD}'))")


def port_label_sql(chunk: str) -> str:
    """SQL for the first USB port named in a chunk as ``USB-C1``, ``USB-A``, …, or null."""
    return (f"nullif(regexp_replace(upper(regexp_extract({chunk}, r'{PORT}', 0)),"
            f" r'{PORT_PARTS}', 'USB-$1$2'), '')")


def context_base_sql(window: str, port: str) -> str:
    """SQL for ``input``, ``output`` or ``unspecified`` from the cues around a match."""
    def cue(pattern: str, weight: float) -> str:
        return f"if({window} rlike r'{pattern}', {weight}D, 0D)"

    balance = (f"{cue(INPUT_CUES, INPUT_WEIGHT)} + {cue(AC_CUES, AC_WEIGHT)}"
               f" - {cue(OUTPUT_CUES, OUTPUT_WEIGHT)} - {cue(DC_CUES, DC_WEIGHT)}")
    # The one-element array binds the balance, so that the cues are searched once.
    return (
        f"transform(array({balance}), b -> CASE WHEN b > 0 THEN 'input'"
        f" WHEN b < 0 OR {port} IS NOT NULL THEN 'output'"
        f" WHEN {window} rlike r'{HERTZ}' OR contains(upper({window}), 'VAC') THEN 'input'"
        f" ELSE 'unspecified' END)[0]"
    )


def context_key_sql(base: str, port: str) -> str:
    return f"concat_ws(':', {base}, {port})"


def _scaled(number: str, factor: str, digits: int) -> str:
    """SQL for the scaled number as the shortest decimal text with at least one decimal."""
    ascii_number = f"translate({number}, '{_OTHER_DIGITS}', '{'0123456789' * len(_DIGIT_ZEROS)}')"
    value = f"round(cast({ascii_number} AS double) {factor}, {digits})"
    return (f"regexp_replace(cast(cast({value} AS decimal(30,{digits})) AS string),"
            r" r'(\.\d+?)0+$', '$1')")


def _unit_value(unit: str, scaled_unit: str, factor: str, digits: int) -> str:
    ends = [f"if(lower(f[3]) = '{scaled_unit}', {_scaled(f'f[{i}]', factor, digits)}, f[{i}])"
            for i in (1, 2)]
    return f"concat({ends[0]}, if(f[2] = '', '', concat('-', {ends[1]})), ' {unit}')"


# quantity -> (pattern, record fields, SQL from the record ``f`` to the value text)
QUANTITIES = {
    "voltage_info": (
        VOLTS, ("$1$5$7$9", "$3", "$2$6$8$10", "$4"),
        "concat(f[1], if(f[2] = '', '', concat('-', f[2])), ' ',"
        " upper(coalesce(nullif(f[3], ''), nullif(f[4], ''), 'V')))",
    ),
    "amperage_info": (AMPS, ("$1", "$2", "$3"), _unit_value("A", "ma", "/ 1000D", 4)),
    "wattage_info": (WATTS, ("$1", "$2", "$3"), _unit_value("W", "kw", "* 1000D", 3)),
}


def spec_chunks(text: Column) -> Column:
    """The chunks that can hold a match (those with a digit), each with its port label."""
    unmarked = F.translate(
        F.coalesce(text, F.lit("")), _RECORD + _FIELD, "\N{REPLACEMENT CHARACTER}" * 2)
    with_digit = F.filter(chunks(unmarked), lambda ch: ch.rlike(r"(?U)\d"))
    return F.transform(with_digit, lambda ch: F.struct(
        ch.alias("chunk"), F.call_function("nullif", F.regexp_replace(
            F.upper(F.regexp_extract(ch, PORT, 0)), PORT_PARTS, "USB-$1$2"), F.lit("")
        ).alias("port")))


def spec_matches(chunk_array: str, quantity: str) -> Column:
    """All matches of one quantity in text order: ``array<struct<context, value>>``.

    ``chunk_array`` names a column made by :func:`spec_chunks`.
    """
    core, fields, value = QUANTITIES[quantity]
    context = context_key_sql(context_base_sql("f[0]", "c.port"), "c.port")
    return F.expr(
        f"flatten(transform(`{chunk_array}`, c -> transform({_records('c.chunk', core, fields)},"
        f" f -> named_struct('context', {context}, 'value', {value}))))"
    )


def by_context(matches: str) -> Column:
    """Contexts in first-seen order, each with its distinct values in first-seen order."""
    return F.expr(
        f"transform(array_distinct(transform(`{matches}`, m -> m.context)), k -> named_struct("
        f"'context', k, 'values', array_distinct(transform("
        f"filter(`{matches}`, m -> m.context = k), m -> m.value))))"
    )


def merge_specs(given: str, found: str) -> Column:
    """Given specs, overridden per context by the found ones, then the new contexts.

    Null when both are empty.
    """
    g, f = (f"coalesce({c}, from_json('[]', '{SPEC_DDL}'))" for c in (given, found))
    same = f"filter({f}, x -> x.context = s.context)"
    merged = (
        f"concat(transform({g}, s -> coalesce(get({same}, 0), s)),"
        f" filter({f}, s -> NOT exists({g}, x -> x.context = s.context)))"
    )
    return F.expr(f"get(filter(array({merged}), m -> size(m) > 0), 0)")


def with_found_specs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Set the three spec columns to what the text says, ``[]`` for nothing."""
    found = df.withColumn("_chunks", spec_chunks(F.col(text_col)))
    found = found.withColumns({q: spec_matches("_chunks", q) for q in QUANTITIES})
    return found.withColumns({q: by_context(q) for q in QUANTITIES}).drop("_chunks")


def expand_specs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the specs found in ``text_col`` to the given spec columns; the text wins."""
    if text_col not in df.columns:
        raise KeyError(f"column {text_col!r} not found")
    given = {f"_given_{q}": F.col(q) for q in QUANTITIES if q in df.columns}
    found = with_found_specs(df.withColumns(given) if given else df, text_col)
    merged = {
        q: merge_specs(f"_given_{q}" if f"_given_{q}" in given else "NULL", q)
        for q in QUANTITIES
    }
    return found.withColumns(merged).drop(*given)


def specs_json(c: Column) -> Column:
    """Spec column as the JSON text of an object ``{context: [value, …]}``."""
    def quoted(x: Column) -> Column:
        # A one-element array gives JSON escaping of a plain string.
        text = F.to_json(F.array(x))
        return F.substring(text, F.lit(2), F.length(text) - 2)

    entries = F.transform(c, lambda e: F.concat(
        quoted(e["context"]), F.lit(": ["),
        F.array_join(F.transform(e["values"], quoted), ", "), F.lit("]")))
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def specs_from_json(c: Column) -> Column:
    """Read the JSON object text back; the order of contexts is the order in the text."""
    return F.transform(
        F.map_entries(F.from_json(c, "map<string,array<string>>")),
        lambda e: F.struct(e["key"].alias("context"), e["value"].alias("values")),
    )
