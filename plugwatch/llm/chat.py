"""Chat formatting by schema fingerprinting.

Records come as JSON text in whatever layout their source has. The nested field paths of a record
are hashed; the hash selects a declarative mapping, which gives canonical turns (role, text).
Records of an unknown layout are kept and named, never guessed at. Only column expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"

# The control strings of the template, and those of other common templates, which
# a tokenizer may take as control when they stand in a text. All begin with "<" or "[".
START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"
ESCAPED = r"([<\[])(\\*)(\||/?s>|/?INST\])"
UNESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"

# A variant holds 128 MiB, and its parser takes strings of 20 million characters. No shorter record
# meets these limits.
LARGE = 20_000_000
NAME_OR_VALUE = r'(?s)("(?:[^"\\]++|\\.)*+"\s*+:)|(")(?:[^"\\]++|\\.)*+(")'
EQUAL = r"(\{[^{}\[\]]*+\})(?:\s*+,\s*+\1)++"
FIELD = re.compile(r"variant_get\(v, '\$\.([\w.]+)', '[^']*'\)")


@dataclass(frozen=True)
class Layout:
    """A mapping: the paths a record must and may have, and SQL for its turns.

    A path joins field names by "."; "[]" after a name stands for the items of an array.
    ``turns`` is SQL over the variant ``v`` that gives ``array<struct<role, text>>``. For a record
    that no variant holds, its calls of the form ``variant_get(v, '$.path', 'type')`` are read
    from the text instead.
    """

    name: str
    must: tuple[str, ...]
    turns: str
    may: tuple[str, ...] = ()

    def variants(self) -> list[tuple[str, ...]]:
        return [self.must + extra for n in range(len(self.may) + 1)
                for extra in combinations(self.may, n)]


def _get(path: str, kind: str = "string") -> str:
    return f"variant_get(v, '$.{path}', '{kind}')"


def _list(path: str, role: str, text: str, roles: dict[str, str] | None = None) -> str:
    """``roles``: what the layout calls them, and what they are."""
    kind = f"array<struct<{role}:string,{text}:string>>"
    named = "CASE " + "".join(f"WHEN x.{role} = '{a}' THEN '{b}' " for a, b in roles.items()) + (
        f"ELSE x.{role} END") if roles else f"x.{role}"
    return (f"transform(coalesce({_get(path, kind)}, array()), x -> "
            f"named_struct('role', {named}, 'text', x.{text}))")


def _pair(first: str, second: str) -> str:
    return (f"array(named_struct('role', 'user', 'text', {first}),"
            f" named_struct('role', 'assistant', 'text', {second}))")


LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"),
           _list("messages", "role", "content")),
    Layout("no messages", ("messages[]",), f"cast(array() as {TURNS})"),
    Layout("conversations", ("conversations[].from", "conversations[].value"),
           _list("conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
    Layout("prompt", ("prompt", "response"), _pair(_get("prompt"), _get("response"))),
    Layout("completion", ("prompt", "completion"), _pair(_get("prompt"), _get("completion"))),
    Layout("instruction", ("instruction", "output"), _pair(
        f"concat_ws('\\n\\n', {_get('instruction')}, nullif({_get('input')}, ''))",
        _get("output")), may=("input",)),
    Layout("question", ("question", "answer"), _pair(_get("question"), _get("answer")),),
    Layout("system prompt", ("system", "prompt", "response"), (
        f"concat(array(named_struct('role', 'system', 'text', {_get('system')})),"
        f" {_pair(_get('prompt'), _get('response'))})")),
)

def _expected(paths: tuple[str, ...], leaf: str = "") -> str:
    """The paths in the notation that Spark gives a variant's schema in, without leaf types."""
    tree: dict = {}
    for path in paths:
        node = tree
        for name in path.replace("[]", ".[]").split("."):
            node = node.setdefault(name, {})

    def show(node: dict) -> str:
        if not node:
            return leaf
        if "[]" in node:
            return f"ARRAY<{show(node['[]'])}>"
        return "OBJECT<" + ", ".join(
            f"{k}: {show(v)}" for k, v in sorted(node.items())) + ">"
    return show(tree)


def field_paths(v: Column) -> Column:
    """The nested field paths of a variant: its schema without the types of its leaves."""
    return F.regexp_replace(
        F.schema_of_variant(v), r"\b(STRING|BIGINT|BOOLEAN|DOUBLE|FLOAT|DECIMAL\([^)]*\)|VOID"
        r"|DATE|TIMESTAMP(_NTZ)?|BINARY|UUID|VARIANT)(?=[,>]|$)", "")


def fingerprint(v: Column) -> Column:
    return F.xxhash64(field_paths(v))


def bare(record: Column) -> Column:
    """A record with empty strings as values, and equal neighbours in an array once: the same
    field paths in little text."""
    return F.regexp_replace(
        F.regexp_replace(record, NAME_OR_VALUE, "$1$2$3"), EQUAL, "$1")


def _from_text(layout: Layout, record_col: str) -> str:
    """SQL for the turns of a record that no variant holds; null if it is no JSON."""
    schema = _expected(layout.must + layout.may, "STRING").replace("OBJECT<", "STRUCT<")
    schema = schema[:-1] + ", _corrupt_record: STRING>"
    name = record_col.replace("`", "``")
    read = f"from_json(`{name}`, '{schema}', map('maxStringLen', '{2**31 - 1}'))"
    turns = FIELD.sub(lambda m: f"{read}.{m[1]}", layout.turns)
    if re.search(r"\bv\b", turns):
        turns = f"raise_error('the layout {layout.name} cannot read a record of this size')"
    return f"if({read}._corrupt_record IS NULL, {turns}, NULL)"


def canonical(df: DataFrame, record_col: str = "record",
              layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``turns`` and ``layout`` to the records.

    A record that is null, is no JSON or has an unknown layout has null turns, and null, "broken"
    or "unknown" as layout. A null role or text becomes empty. Records without turns have an
    empty array. Columns of ``df`` named turns, layout or like the inner ones are replaced.

    A record too large for a variant is told by its ``bare`` form, and its turns are read from the
    text, where a number as text stays as it is written. If not even the bare form can be held,
    that is an error.
    """
    known = [(layout, _expected(paths)) for layout in layouts for paths in layout.variants()]
    seen = [paths for _, paths in known]
    if len(set(seen)) < len(seen):
        raise ValueError("two layouts have the same paths")
    record = F.col(f"`{record_col}`")
    rows = df.withColumn("v", F.try_parse_json(record)).withColumn(
        "big", F.col("v").isNull() & (F.length(record) >= LARGE))
    rows = rows.withColumn("bare", F.when(F.col("big"), bare(record))).withColumn(
        "v", F.when(F.col("big"), F.try_parse_json("bare")).otherwise(F.col("v"))).withColumn(
        "print", fingerprint(F.col("v")))
    turns = F.when(F.col("v").isNull(), F.when(
        F.length("bare") >= LARGE, F.raise_error(F.lit("a record is too large to be read"))
        .cast(TURNS)))
    name = F.when(record.isNull(), F.lit(None)).when(F.col("v").isNull(), F.lit("broken"))
    for layout, paths in known:
        here = F.col("print") == F.xxhash64(F.lit(paths))
        turns = turns.when(here & F.col("big"), F.expr(_from_text(layout, record_col))
                           .cast(TURNS)).when(here, F.expr(layout.turns).cast(TURNS))
        name = name.when(here & F.col("big") & F.col("listed").isNull(), F.lit("broken")).when(
            here, F.lit(layout.name))
    return rows.withColumn("listed", turns).withColumn(
        "layout", name.otherwise(F.lit("unknown"))).withColumn(
        "turns", F.transform("listed", lambda t: F.struct(
            F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    ).drop("v", "big", "bare", "print", "listed")


def records(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows by turn as one JSON record per conversation: (id, record).

    Turns follow ``turn``; null turns come first, and ties are ordered by role and text, so that
    the result doesn't depend on the order of rows. Repeated rows are repeated turns. Rows
    without an identity form one conversation. A conversation is one record of the output, so its
    turns meet in one row.
    """
    c = lambda name: F.col(f"`{name}`")
    turn = F.struct(c(turn_col).alias("turn"), F.coalesce(c(role_col), F.lit("")).alias("role"),
                    F.coalesce(c(text_col), F.lit("")).alias("text"))
    listed = df.groupBy(c(id_col).alias(id_col)).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    messages = F.transform("t", lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("content")))
    return listed.select(id_col, F.to_json(F.struct(messages.alias("messages"))).alias("record"))


def escape(text: Column) -> Column:
    """``text`` without control strings: each gets a backslash after its first character, after
    any backslashes that stand there already, so that ``unescape`` gives the text back."""
    return F.regexp_replace(text, ESCAPED, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPED, "$1$2$3")


def render(turns: Column) -> Column:
    """The turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(START), escape(t["role"]), F.lit(SEP), escape(t["text"]), F.lit(END))), "")


def loss_spans(turns: Column, roles: tuple[str, ...] = ("assistant",)) -> Column:
    """Where in ``render(turns)`` the texts to learn from lie: (start, length) in characters."""
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        head = F.length(escape(t["role"])) + len(START) + len(SEP)
        size = F.length(escape(t["text"])).cast("long")
        span = F.array(F.struct((acc["at"] + head).cast("long").alias("start"),
                                size.alias("length")))
        return F.struct(
            (acc["at"] + head + size + len(END)).cast("long").alias("at"),
            F.when(t["role"].isin(*roles), F.concat(acc["spans"], span))
            .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc["spans"])


def read_back(formatted: Column) -> Column:
    """The turns of a text that ``render`` made."""
    quoted = lambda s: s.replace("|", "\\|")
    whole = F.regexp_replace(formatted, f"{quoted(END)}$", "")
    parts = F.filter(F.split(whole, f"({quoted(END)})?{quoted(START)}"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.split(p, quoted(SEP))[0]).alias("role"),
        unescape(F.split(p, quoted(SEP))[1]).alias("text")))


def masked(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def format_chat(df: DataFrame, record_col: str = "record") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans`` to the records; both null if there are no turns."""
    rows = canonical(df, record_col)
    return rows.withColumn("formatted", render(F.col("turns"))).withColumn(
        "loss_spans", loss_spans(F.col("turns")))
