"""Removal of passages that stand earlier in the corpus.

Every run of ``WINDOW`` words that also starts earlier, in a document with a smaller identity or
earlier in the same one, is taken out, as one maximal span where such runs overlap.

The reference is the corpus itself. Its windows are dealt out to shards by minimizer: the least of
the hashes of the ``PART``-word runs inside a window. Equal windows have equal minimizers, so
they meet in one shard, and neighbouring windows mostly share one, so that a shard gets a short
record for a run of windows instead of one for each. A window is told by the 64 bits of its
minimizer, the place of the minimizer in it, and a second hash of 64 bits over all its words, which
tells the windows of one minimizer and place apart.

Of windows that repeat within one batch of a task only the first goes to a shard: the others are
settled at once. So a passage that fills a third of all documents reaches its shard
once per batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, PART = 20, 8
# Words that a task looks at before it passes its windows on; bounds its memory.
BATCH_WORDS = 1_500_000
# Characters of the corpus for each shard: about 0.7 million windows, some 50 MB in a task.
SHARD_CHARS = 4_000_000

SENT = "shard int, cell binary"
RUNS = "id long, row_id long, start int, size int"
RUN_NAMES = ("id", "row_id", "start", "size")
RUN_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
# Stands for a null identity, which comes before all others.
NO_ID = -(1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _run_hashes(words: np.ndarray, size: int, salt: int) -> np.ndarray:
    """A hash for every run of ``size`` words."""
    n = len(words) - size + 1
    total = np.full(n, salt, dtype=np.uint64)
    for i in range(size):
        total = (total ^ words[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return _mixed(total)


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))


def windows(hashes: np.ndarray, window: int = WINDOW, part: int = PART):
    """For each window of the words: minimizer hash, where it lies in the window, and a second
    hash over all words."""
    parts = _run_hashes(hashes, part, 1)
    n, wide = len(hashes) - window + 1, window - part + 1
    best, place = parts[:n].copy(), np.zeros(n, dtype=np.uint8)
    for i in range(1, wide):
        here = parts[i:i + n]
        less = here < best
        best[less] = here[less]
        place[less] = i
    # The words outside the minimizer are covered through the first and the last runs and, as
    # these overlap in the middle, every word of the window is in one of three runs.
    second = _run_hashes(hashes, part, 2)
    rest = np.zeros(n, dtype=np.uint64)
    for i in sorted({*range(0, window - part + 1, part), window - part}):
        rest = (rest ^ second[i:i + n]) * np.uint64(0xD6E8FEB86659FD93)
        rest ^= rest >> np.uint64(32)
    return best, place, _mixed(rest)


CELL = np.dtype([("min", "<u8"), ("row", "<i8"), ("id", "<i8"), ("start", "<i4"), ("n", "u1")])
"""A run of windows with one minimizer: the minimizer, the row, its identity (as order), the first
window's start, and the number of windows; 8 bytes for each window follow, and a byte for the
place of the minimizer in the first one."""


def _pack(best, place, rest, row, ident, start):
    """The windows, in order, as runs: cells, the first window's place of each, and the windows'
    second hashes."""
    anchor = start + place
    new = np.ones(len(best), dtype=bool)
    new[1:] = (np.diff(start) != 1) | (np.diff(anchor) != 0) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    cells = np.zeros(len(first), dtype=CELL)
    cells["min"], cells["row"], cells["id"] = best[first], row[first], ident[first]
    cells["start"] = start[first]
    cells["n"] = np.diff(np.append(first, len(best)))
    return cells, place[first], rest


def _grouped(cells, places, rests, shards):
    """Blobs by shard: cells, then places, then windows, each as one array."""
    shard = (_mixed(cells["min"]) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    ends = np.cumsum(cells["n"].astype(np.int64))
    begins = ends - cells["n"]
    cut = np.flatnonzero(np.diff(shard[order])) + 1
    rests = rests.astype("<u8")
    for group in np.split(order, cut):
        n = cells["n"][group].astype(np.int64)
        inside = np.repeat(begins[group] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        yield int(shard[group[0]]), b"".join((
            np.int64(len(group)).tobytes(), cells[group].tobytes(), places[group].tobytes(),
            rests[inside].tobytes()))


def _opened(blobs):
    """All windows of the blobs: min, place, rest, row, id, start."""
    cells, places, rests = [], [], []
    for blob in blobs:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        at = 8 + n * CELL.itemsize
        cells.append(np.frombuffer(blob, CELL, n, 8))
        places.append(np.frombuffer(blob, np.uint8, n, at))
        rests.append(np.frombuffer(blob, "<u8", -1, at + n))
    cells, places = np.concatenate(cells), np.concatenate(places)
    n = cells["n"].astype(np.int64)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = lambda x: np.repeat(x, n)
    return (wide(cells["min"]), (wide(places) - inside).astype(np.uint8), np.concatenate(rests),
            wide(cells["row"]), wide(cells["id"]), (wide(cells["start"]) + inside).astype(np.int64))


def _later(best, place, rest, row, ident, start):
    """Which windows also start earlier, by identity, row and start."""
    key = best ^ _mixed(rest + place)
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    at = order[np.append(same, False) | np.append(False, same)]
    later = np.zeros(len(best), dtype=bool)
    if not len(at):
        return later
    # Only what shares its key is compared in full.
    at = at[np.lexsort((start[at], row[at], ident[at], place[at], rest[at], best[at]))]
    new = np.ones(len(at), dtype=bool)
    new[1:] = ((best[at[1:]] != best[at[:-1]]) | (rest[at[1:]] != rest[at[:-1]])
               | (place[at[1:]] != place[at[:-1]]))
    first = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
    later[at] = (start[at] != start[first]) | (row[at] != row[first]) | (ident[at] != ident[first])
    return later


def _as_runs(ident, row, start, window):
    """Spans of words covered by the windows, merged where they touch: (id, row, start, size)."""
    order = np.lexsort((start, row, ident))
    ident, row, start = ident[order], row[order], start[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = ((row[1:] != row[:-1]) | (ident[1:] != ident[:-1])
               | (start[1:] - start[:-1] > window))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row))[:len(first)] - 1
    return ident[first], row[first], start[first], start[last] + window - start[first]


def _send(window: int, part: int, shards: int):
    """Cuts batches of documents into windows; gives blobs for shards, and spans settled here."""
    def flush(docs):
        found = [windows(h, window, part) for _, _, h in docs]
        size = [len(f[0]) for f in found]
        best, place, rest = (np.concatenate(x) for x in zip(*found))
        row = np.repeat(np.array([d[0] for d in docs], dtype=np.int64), size)
        ident = np.repeat(np.array([d[1] for d in docs], dtype=np.int64), size)
        start = np.concatenate([np.arange(n) for n in size])
        later = _later(best, place, rest, row, ident, start)
        all_of = (best, place, rest, row, ident, start)
        blobs = list(_grouped(*_pack(*(x[~later] for x in all_of)), shards))
        runs = _as_runs(ident[later], row[later], start[later], window)
        none = [None] * len(blobs)
        spread = (runs[1] % shards).tolist()  # settled spans go along in any shard
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([s for s, _ in blobs] + spread, pa.int32()),
            "cell": pa.array([c for _, c in blobs] + [None] * len(runs[0]), pa.binary()),
            **{k: pa.array(none + x.tolist(), t) for k, x, t in zip(RUN_NAMES, runs, RUN_TYPES)}})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, held = [], 0
        for batch in batches:
            for row, ident, text in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                if len(words) < window:
                    continue
                docs.append((row, NO_ID if ident is None else ident, word_hashes(words)))
                held += len(words)
                if held >= BATCH_WORDS:
                    yield flush(docs)
                    docs, held = [], 0
        if docs:
            yield flush(docs)

    return send


def _settle(window: int):
    """Finds in the blobs of each shard the windows that are not the first of their kind."""
    def ended(blobs):
        best, place, rest, row, ident, start = _opened(blobs)
        later = _later(best, place, rest, row, ident, start)
        runs = _as_runs(ident[later], row[later], start[later], window)
        return pa.RecordBatch.from_pydict({
            k: pa.array(x, t) for k, x, t in zip(RUN_NAMES, runs, RUN_TYPES)})

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs, now = [], None
        for batch in batches:
            sent = batch.column(1).is_valid()
            yield batch.filter(pc.invert(sent)).select(RUN_NAMES)
            batch = batch.filter(sent)
            for shard, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                if blobs and shard != now:
                    yield ended(blobs)
                    blobs = []
                now = shard
                blobs.append(cell.as_py())
        if blobs:
            yield ended(blobs)

    return settle


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        kept, n_words, n_removed = [], [], []
        for text, spans in zip(frame["text"], frame["spans"]):
            words = left = (text or "").encode("utf-8", "surrogatepass").split()
            if spans is not None and len(spans):
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for span in spans:
                    gone[span["start"]] += 1
                    gone[span["start"] + span["size"]] -= 1
                stay = (np.cumsum(gone)[:-1] == 0).tolist()
                left = [w for w, s in zip(words, stay) if s]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
        yield pd.DataFrame({
            "id": frame["id"], "n_words": n_words, "n_removed": n_removed, "kept": kept})


def repeated_spans(rows: DataFrame, window: int = WINDOW, part: int = PART,
                   shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Spans of words to remove, for rows of (id long, row_id long, text): (id, row_id, spans).
    Earlier means a smaller id, then a smaller row_id, then an earlier start."""
    chars = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    sent = rows.select("row_id", "id", "text").mapInArrow(
        _send(window, part, 1 + chars // shard_chars), f"{SENT}, {RUNS}")
    runs = sent.repartition("shard").sortWithinPartitions("shard").mapInArrow(_settle(window), RUNS)
    # As a set, so that rows repeated without end don't fill it.
    return runs.groupBy("id", "row_id").agg(F.collect_set(F.struct("start", "size")).alias("spans"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, part: int = PART,
                   shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row per row of ``df``: (id, n_words, n_removed, kept), ``kept`` the words that stay.

    Words are runs without ASCII white space, unchanged. Windows are judged on the input. A null
    text has no words; a text of fewer than ``window`` words keeps all. Null identities come
    before all others. Rows that repeat identity and text are one document, and each is cut
    alike; of rows that share only the identity the one with the smaller hash comes first.
    Identities must be integers. Other columns are not looked at; an empty table gives an
    empty one.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ident = F.col(f"`{id_col}`").cast("long")
    rows = df.select(ident.alias("id"), F.xxhash64(ident, text).alias("row_id"), text.alias("text"))
    spans = repeated_spans(rows, window, part, shard_chars).select(
        F.col("id").alias("sid"), F.col("row_id").alias("srow"), "spans")
    joined = rows.join(spans, (F.col("row_id") == F.col("srow")) & (
        F.coalesce("id", F.lit(NO_ID)) == F.col("sid")), "left")
    return joined.select("id", "text", "spans").mapInPandas(
        _cut, "id long, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
