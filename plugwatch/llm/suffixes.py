"""Removal of every byte run that stands more than once in the corpus, by prefix doubling.

A run of ``length`` bytes repeats if all of it starts at another position too. Sorting all positions
by that many bytes would move the corpus many times over, so the positions that are sorted are a
sample which the text itself picks: of each run, the place (*mark*) of the least name of ``grain``
bytes among its first ``width`` starts. Equal runs pick equal marks, so the runs of a mark are
told apart only among the marks that agree with it.

Names of 1, 2, 4, … bytes are doubled inside a task, each from the pair of names half as long. Then
Spark sorts the pairs of names of the marks, at lengths that grow from ``length - width + 1`` to
``length``, and ranks them anew each round:

* the *core* of a mark is what all of its runs share. Where no other mark has it, none of the runs
  repeats, and the mark is done;
* its *whole* is what its runs cover together. Where another mark has it, all of the runs repeat,
  and the mark is done too, past the threshold;
* what is left is cut into narrower sets of runs, whose cores are longer, down to single runs.

A whole is told by two names (of 64 bits each), one of them that of its core. Within a task equal
names are merged before they are sorted, so a passage in a third of all documents is one
record per task. Texts are written once to a table bucketed by document, which every round reads as
it lies.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plugwatch.session import work_dir

LENGTH = 400
# Bytes of text for each bucket of the stored table, and the most buckets it may have.
BUCKET_BYTES, MOST_BUCKETS = 16_000_000, 20_000
# Starts looked at together, and marks held before they are merged and passed on: bound a task's memory.
SLAB, HELD = 1 << 20, 300_000
# How many sets of runs one set is cut into from round to round.
STEP = 16

CORE, WHOLE, SPAN, KNOWN = 0, 1, 2, 3
NAMES = "kind int, n1 long, n2 long, row long, at int, reach int, n int"
_FIELDS = [("kind", pa.int32()), ("n1", pa.int64()), ("n2", pa.int64()), ("row", pa.int64()),
           ("at", pa.int32()), ("reach", pa.int32()), ("n", pa.int32())]
MARKS = "marks array<struct<kind:int,at:int,reach:int,total:int,lead:boolean>>"
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * _ODD
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_BYTE_NAMES = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD2)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a pair of names."""
    return _mixed(a * _ODD2 + b)


def _power(n: int) -> int:
    """The largest power of two up to ``n``, which is 1 or more."""
    return 1 << (n.bit_length() - 1)


def widths(length: int) -> list[int]:
    """How many neighbouring runs are told apart together, round by round."""
    width = min(_power(max(1, length * 2 // 3)), 1 << 15)
    found = [width]
    while found[-1] > 1:
        found.append(max(1, found[-1] // STEP))
    return found


def _doubled(data: np.ndarray, sizes: set[int]) -> dict[int, np.ndarray]:
    """The names of all runs of each of the ``sizes`` (powers of two)."""
    names, size, kept = _BYTE_NAMES[data], 1, {}
    while True:
        if size in sizes:
            kept[size] = names
        if size >= max(sizes):
            return kept
        names = _pair(names[:-size], names[size:])
        size *= 2


def _marked(names: np.ndarray, width: int) -> np.ndarray:
    """For each start, the place of the least name of the ``width`` starts from it, the first of
    equal ones."""
    low = np.uint64((1 << 24) - 1)
    keys, size = (names & ~low) | np.arange(len(names), dtype=np.uint64), 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return (keys & low).astype(np.int64)


def _first_and_count(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row whether it is the first with its keys, and how many rows have them."""
    order = np.lexsort(keys)
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(order)))
    first, count = np.zeros(len(order), dtype=bool), np.empty(len(order), dtype=np.int64)
    first[order[starts]] = True
    count[order] = np.repeat(sizes, sizes)
    return first, count


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined where they overlap or touch, in order."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(new)[1:], len(starts))[:int(new.sum())] - 1
    return starts[new], ends[last]


class _Round:
    """Cuts sets of runs to ``width`` and names them; gives records to sort, and what is settled."""

    def __init__(self, length: int, width: int):
        self.length, self.width = length, width
        self.whole = widths(length)[0]
        self.grain = _power(max(1, min(16, length // 8)))
        self.core = length - width + 1
        self.sizes = {self.grain, _power(self.core), _power(length)}
        self.slab, self.slab_size, self.held, self.held_size = [], 0, [], 0

    def named(self, names, row, at, low, high):
        """The sets of runs from ``low`` to ``high``, cut to ``width``, with their names."""
        first, last = (at - high) // self.width, (at - low) // self.width
        n = last - first + 1
        i = np.repeat(np.arange(len(at)), n)
        j = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        at = at[i]
        low = np.maximum(low[i], at - (j + 1) * self.width + 1)
        high = np.minimum(high[i], at - j * self.width)
        size, core = _power(self.length), at - j * self.width
        full, shift = names[size], self.length - size
        if self.width == 1:
            n1, n2 = full[low], full[low + shift]
        else:
            short, part = names[_power(self.core)], self.core - _power(self.core)
            n1 = _pair(_pair(short[core], short[core + part]), j.astype(np.uint64))
            n2 = _pair(_pair(full[low], full[low + shift]),
                       _pair(full[high + shift], (high - low).astype(np.uint64)))
        return row[i], at, low, high, n1.view(np.int64), n2.view(np.int64)

    def look(self):
        """Names what the slab holds."""
        if not self.slab:
            return
        pieces, self.slab, self.slab_size = self.slab, [], 0
        names = _doubled(np.frombuffer(b"".join(p[2] for p in pieces), np.uint8), self.sizes)
        sizes = np.array([len(p[2]) for p in pieces])
        offsets = np.cumsum(sizes) - sizes
        row, base = (np.array([p[k] for p in pieces], dtype=np.int64) for k in (0, 1))
        if pieces[0][3] is None:
            starts = sizes - self.length + 1
            piece = np.repeat(np.arange(len(pieces)), starts)
            start = np.arange(len(piece)) - np.repeat(np.cumsum(starts) - starts, starts) + offsets[piece]
            mark = _marked(names[self.grain], self.whole)[start]
            new = np.ones(len(mark), dtype=bool)
            new[1:] = (mark[1:] != mark[:-1]) | (piece[1:] != piece[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(mark)) - 1
            piece, at, low, high = piece[first], mark[first], start[first], start[last]
        else:
            n = np.array([len(p[3][0]) for p in pieces])
            piece = np.repeat(np.arange(len(pieces)), n)
            at, low, high = (np.concatenate([p[3][k] for p in pieces]) for k in range(3))
            at, low, high = (x - base[piece] + offsets[piece] for x in (at, low, high))
        row_of, shift = row[piece], (base - offsets)[piece]
        i = np.arange(len(piece))
        i, at, low, high, n1, n2 = self.named(names, i, at, low, high)
        self.held.append((row_of[i], at + shift[i], low + shift[i], high + shift[i], n1, n2))
        self.held_size += len(i)

    def add(self, row, base, data, sets=None):
        self.slab.append((row, base, data, sets))
        self.slab_size += len(data)
        if self.slab_size >= SLAB:
            self.look()
            if self.held_size >= HELD:
                yield self.flush()

    def flush(self):
        row, at, low, high, n1, n2 = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.held_size = [], 0
        reach = (at - low) << 16 | (at - high)
        first, count = _first_and_count(n2, n1)
        again = (count > 1) & ~first
        parts = [self._rows(WHOLE, n1, n2, row, at, reach, count, first)]
        spans = [(r, *merged(low[m], high[m] + self.length)) for r, m in _by_row(row, again)]
        if spans:
            rows = np.concatenate([np.full(len(s[1]), s[0]) for s in spans])
            starts, ends = (np.concatenate([s[k] for s in spans]) for k in (1, 2))
            parts.append(self._settled(SPAN, rows, starts, ends - starts))
        if self.width > 1:
            lead, shared = _first_and_count(n1)
            parts.append(self._rows(CORE, n1, np.zeros_like(n1), row, at, reach, shared, lead))
            known = ~lead & (count == 1)
            parts.append(self._settled(KNOWN, row[known], at[known], reach[known]))
        return pa.concat_tables(parts).combine_chunks().to_batches()

    def _rows(self, kind, n1, n2, row, at, reach, n, keep):
        some = [x[keep] for x in (n1, n2, row, at, reach, n)]
        return pa.table([pa.array(x, t) for x, (_, t) in zip(
            [np.full(len(some[0]), kind), *some], _FIELDS)], schema=pa.schema(_FIELDS))

    def _settled(self, kind, row, at, reach):
        """Rows that are not sorted; as their names are their own, they fall anywhere."""
        return self._rows(kind, row, at, row, at, reach, np.zeros_like(row), slice(None))


def _by_row(row, some):
    """Each row and the places of its marks among ``some``."""
    at = np.flatnonzero(some)
    at = at[np.argsort(row[at], kind="stable")]
    for group in np.split(at, np.flatnonzero(np.diff(row[at])) + 1):
        if len(group):
            yield row[group[0]], group


def _open_sets(marks) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Of a document's marks, the sets of runs (at, low, high) that the next round cuts: those
    whose core repeats and whose whole doesn't, and one of each repeated whole, which others
    may match in part."""
    kind, at, reach, total, lead = marks
    key = at << 32 | reach
    core, whole = kind == CORE, kind == WHOLE
    open_ = key[core | (kind == KNOWN)]
    open_ = open_[~np.isin(open_, key[whole])]
    led, size = key[whole & lead], total[whole & lead]
    order = np.argsort(key[core])
    place = np.searchsorted(key[core][order], led)
    place[place == len(order)] = 0
    found = key[core][order][place] == led if len(order) else np.zeros(len(led), bool)
    # Where its whole core group is of that whole, there is no one else to match.
    alone = found & (total[core][order][place] == size) if len(order) else found
    todo = np.concatenate([open_, led[~alone]])
    at, reach = todo >> 32, todo & 0xFFFFFFFF
    return (at, at - (reach >> 16), at - (reach & 0xFFFF)) if len(todo) else None


def _struct_columns(marks: pa.ListArray):
    values = marks.values
    return np.asarray(marks.offsets), [
        values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)
    ] + [values.field(4).to_numpy(zero_copy_only=False)]


def _name(length: int, width: int):
    """Records of all texts (first round), or of the open sets of runs of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo = _Round(length, width)
        for batch in batches:
            data, rows = batch.column(1), batch.column(0).to_pylist()
            if batch.num_columns > 2:
                offsets, columns = _struct_columns(batch.column(2))
            for i, row in enumerate(rows):
                if batch.num_columns == 2:
                    text = data[i].as_py()
                    for at in range(0, len(text) - length + 1, SLAB):
                        for out in todo.add(row, at, text[at:at + SLAB + length - 1]):
                            yield from out
                    continue
                sets = _open_sets([c[offsets[i]:offsets[i + 1]] for c in columns])
                if sets is None:
                    continue
                text, (at, low, high) = data[i].as_py(), sets
                slab = low // SLAB
                for part in np.unique(slab):
                    m = slab == part
                    start, stop = int(low[m].min()), int(high[m].max()) + length
                    for out in todo.add(row, start, text[start:stop], (at[m], low[m], high[m])):
                        yield from out
        todo.look()
        if todo.held:
            yield from todo.flush()

    return run


def _ranked(names: DataFrame) -> DataFrame:
    """What the sorted names tell: (row, kind, at, reach, total, lead) of names that stand more
    than once, and of what was settled. ``lead`` is one row of each name."""
    same = Window.partitionBy("kind", "n1", "n2")
    return names.select(
        "*", F.sum("n").over(same).alias("total"),
        F.min(F.struct("row", "at", "reach")).over(same).alias("least")
    ).where(f"kind >= {SPAN} or total > 1").select(
        "row", F.struct(
            "kind", "at", "reach", F.least("total", F.lit(2**31 - 1)).cast("int").alias("total"),
            (F.struct("row", "at", "reach") == F.col("least")).alias("lead")).alias("mark"))


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``row``, and read back. Joins of such
    tables on ``row`` shuffle neither."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.repartition(buckets, "row").write.bucketBy(buckets, "row").option(
        "path", work_dir(spark)).option("compression", "zstd").saveAsTable(name)
    table = spark.table(name)
    # The frame knows its files; only the name in the catalog goes.
    spark.sql(f"DROP TABLE {name}")
    return table


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, data, out = batch.column(0), batch.column(1), []
            offsets, (kind, at, reach, *_) = _struct_columns(batch.column(2))
            whole = kind == WHOLE
            low = np.where(whole, at - (reach >> 16), at)
            high = np.where(whole, at - (reach & 0xFFFF) + length, at + reach)
            useful = whole | (kind == SPAN)
            for i in range(batch.num_rows):
                text = data[i].as_py()
                m = slice(offsets[i], offsets[i + 1])
                u = useful[m]
                if not u.any():
                    out.append((len(text), 0, 0, text))
                    continue
                starts, ends = merged(low[m][u], high[m][u])
                edges = zip([0, *ends.tolist()], [*starts.tolist(), len(text)])
                out.append((len(text), int((ends - starts).sum()), len(starts),
                            b"".join(text[a:b] for a, b in edges)))
            n_bytes, n_removed, n_spans, kept = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``df``: (id, n_bytes, n_removed, n_spans, kept), ``kept`` the bytes
    that stay.

    A byte goes if a run of ``length`` bytes covers it that also starts anywhere else: in
    another row, or elsewhere in the same one, overlapping or not. All copies go, the first one
    too. Texts are UTF-8 (or binary) and judged on the input; what stays may be cut inside a
    character, so it is binary. Runs never cross rows. Every row is a document of its own: rows that
    repeat identity and text are each other's copies. A null text is empty; one shorter than
    ``length`` keeps all. Identities may be null and of any type. Other columns are not looked at; an
    empty table gives an empty one. Texts are held in a task one at a time, and named in blocks.
    """
    if length < 2:
        raise ValueError("runs of two bytes at least")
    data = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    docs = df.select(F.monotonically_increasing_id().alias("row"),
                     F.col(f"`{id_col}`").alias("id"), data.alias("data"))
    size = docs.agg(F.sum(F.octet_length("data").cast("long"))).first()[0] or 0
    buckets = max(1, min(MOST_BUCKETS, size // bucket_bytes))
    store, states = _bucketed(docs, buckets), []
    for width in widths(length):
        source = store.select("row", "data")
        if states:
            source = source.join(states[-1].hint("shuffle_hash"), "row")
        names = source.mapInArrow(_name(length, width), NAMES)
        states.append(_bucketed(_ranked(names).groupBy("row").agg(
            F.collect_list("mark").alias("marks")), buckets))
    done = store
    for i, state in enumerate(states):
        done = done.join(state.hint("shuffle_hash").withColumnRenamed("marks", f"m{i}"), "row", "left")
    none = F.array().cast(MARKS.removeprefix("marks "))
    marks = F.concat(*[F.coalesce(F.col(f"m{i}"), none) for i in range(len(states))])
    kind = docs.schema["id"].dataType.simpleString()
    return done.select("id", "data", marks.alias("marks")).mapInArrow(
        _cut(length), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    ).withColumnRenamed("id", id_col)
