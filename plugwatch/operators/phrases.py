"""Which of very many phrases stand in a text: a filter of bounded size picks the places, a join decides.

Neither side is held whole by a task. The phrases set bits of a filter, and each task reads its
texts once: names of 1, 2, 4, 8 and 16 bytes are doubled as in prefix doubling, and the places where
the filter knows the start of a phrase, and then the whole of it by its two ends, are candidates. What stands there is
joined with the phrases, so that the filter alone decides nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.operators.joins import join_unique
from plugwatch.session import stored

# Functions that run in tasks travel with the job, so executors need not have the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bits of the filter for each phrase, and powers of two for the least and most it may have (32 MB).
PHRASE_BITS, LEAST_BITS, MOST_BITS = 256, 15, 28
# Bytes of text looked at together.
SLAB = 1 << 20
# Candidates of each text and kind that are joined first; the others are where all of these were wrong.
FIRST = 4
_LONGEST_NAME = 16
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
CANDIDATES = "text_key binary, kind int, value binary, more boolean"
_FIELDS = pa.schema([("text_key", pa.binary()), ("kind", pa.int32()), ("value", pa.binary()), ("more", pa.bool_())])


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * _ODD
    x = x ^ (x >> np.uint64(29))
    x = x * _ODD2
    return x ^ (x >> np.uint64(32))


def _names(data: np.ndarray) -> dict[int, np.ndarray]:
    """The names of all runs of 1, 2, 4, 8 and 16 bytes."""
    names, size, found = _mixed(data.astype(np.uint64) + np.uint64(1)), 1, {}
    while len(names):
        found[size] = names
        if size == _LONGEST_NAME:
            break
        names = _mixed(names[:-size] * _ODD2 + names[size:])
        size *= 2
    return found


def _start_size(length: int) -> int:
    """The size of the name that a phrase of so many bytes is first known by."""
    return min(_LONGEST_NAME, 1 << (length.bit_length() - 1))


def _whole(start: np.ndarray, end: np.ndarray, length: int, kind: int) -> np.ndarray:
    """The names of runs of ``length`` as phrases of a kind, from the names of their two ends."""
    return _mixed(_mixed(start * _ODD2 + end) + np.uint64(length * 4 + kind))


def _slots(names: np.ndarray, bits: int) -> np.ndarray:
    return (names >> np.uint64(64 - bits)).astype(np.int64)


def _phrase_slots(bits: int, kinds: tuple[int, ...]):
    """The bits that phrases set: one for the start, two for the whole of each of its kinds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = []
            for value, of in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size = _start_size(len(value))
                names = np.concatenate([_names(np.frombuffer(end, np.uint8))[size]
                                        for end in (value[:size], value[-size:])])
                slots.append(_slots(names[:1], bits))
                for kind in kinds:
                    if of & kind:
                        whole = _whole(names[:1], names[1:], len(value), kind)
                        slots += [_slots(whole, bits), _slots(_mixed(whole ^ _ODD), bits)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.unique(np.concatenate(slots)) if slots else [], pa.int64())], ["slot"])

    return run


def _filter(phrases: DataFrame, bits: int, kinds: tuple[int, ...]) -> bytes:
    """The filter of 2**bits bits, put together by Spark in pages of 4 KB."""
    slots = phrases.mapInArrow(_phrase_slots(bits, kinds), "slot long").select(
        (F.col("slot") + 1).alias("slot"))
    pages = slots.groupBy(F.bitmap_bucket_number("slot").alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    whole = bytearray(1 << (bits - 3))
    for page in pages:
        at = (page["page"] - 1) * len(page["bits"])
        whole[at:at + len(page["bits"])] = page["bits"]
    return bytes(whole)


def _slabs(texts: list[bytes], longest: int) -> Iterator[list[tuple[int, bytes]]]:
    """Texts in lists of some ``SLAB`` bytes; longer ones are cut so that no phrase is."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - longest + 1), SLAB):
            part = text[at:at + SLAB + longest - 1]
            held.append((i, part))
            size += len(part)
            if size >= SLAB:
                yield held
                held, size = [], 0
    if held:
        yield held


def _candidates(known: bytes, bits: int, lengths: tuple[int, ...], kinds: tuple[int, ...], first: int | None):
    """Rows of ``CANDIDATES`` for (key, text, kinds that are looked for); of each text and kind the
    ``first`` places alone, and whether there are ``more``."""
    by_size: dict[int, list[int]] = {}
    for length in lengths:
        by_size.setdefault(_start_size(length), []).append(length)
    table = np.frombuffer(known, np.uint8)

    def hit(names: np.ndarray) -> np.ndarray:
        slots = _slots(names, bits)
        return (table[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)

    def look(pieces, wanted):
        data = b"".join(part for _, part in pieces)
        sizes = np.array([len(part) for _, part in pieces])
        ends = np.cumsum(sizes)
        names, none = _names(np.frombuffer(data, np.uint8)), np.zeros(0, np.int64)
        found = {kind: [(none, none, none)] for kind in kinds}
        for size, some in by_size.items():
            if size not in names:
                continue
            start = np.flatnonzero(hit(names[size]))
            piece = np.searchsorted(ends, start, "right")
            room = ends[piece] - start
            for length in some:
                fits = room >= length
                at, of = start[fits], piece[fits]
                for kind in kinds:
                    whole = _whole(names[size][at], names[size][at + (length - size)], length, kind)
                    m = hit(whole) & (wanted[of] & kind != 0)
                    m[m] = hit(_mixed(whole[m] ^ _ODD))
                    found[kind].append((of[m], at[m], np.full(int(m.sum()), length)))
        for kind in kinds:
            of, at, length = (np.concatenate(x) for x in zip(*found[kind]))
            order = np.lexsort((at, of))
            of, at, length = of[order], at[order], length[order]
            begin = np.searchsorted(of, of, "left")
            if first is None:
                keep, more = np.ones(len(of), bool), np.zeros(len(of), bool)
            else:
                keep = np.arange(len(of)) - begin < first
                more = np.searchsorted(of, of, "right") - begin > first
            told = {(pieces[p][0], data[a:a + n], bool(x)) for p, a, n, x in zip(
                *(y[keep].tolist() for y in (of, at, length, more)))}
            yield kind, told

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            wanted = batch.column(2).to_numpy(zero_copy_only=False)
            for pieces in _slabs(texts, max(lengths)):
                for kind, told in look(pieces, wanted[[i for i, _ in pieces]]):
                    if told:
                        rows, values, more = zip(*told)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([keys[i] for i in rows], pa.binary()),
                             pa.array([kind] * len(rows), pa.int32()), pa.array(values, pa.binary()),
                             pa.array(more, pa.bool_())], schema=_FIELDS)

    return run


def text_key(text: Column) -> Column:
    """What :func:`kinds_in_texts` tells texts apart by."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def kinds_in_texts(texts: DataFrame, phrases: DataFrame, kinds: tuple[int, ...]) -> DataFrame:
    """(text_key, kinds) of the texts (the one column of ``texts``) that hold a phrase, with the bits of the
    kinds of all that they hold. ``phrases`` are (value, kinds), each value once and none empty.

    The work grows with the texts and with the phrases, and not with their product. The driver holds
    the filter and the lengths of the phrases.
    """
    phrases = stored(phrases.select(F.col("value").cast("binary").alias("value"), "kinds"))
    lengths = tuple(sorted(r[0] for r in phrases.select(F.octet_length("value")).distinct().collect()))
    bits = min(MOST_BITS, max(LEAST_BITS, (phrases.count() * PHRASE_BITS).bit_length()))
    known = _filter(phrases, bits, kinds)
    text = F.col(f"`{texts.columns[0]}`")
    every = sum(kinds)
    rows = texts.where(text.isNotNull() & (text != "")).select(
        text_key(text).alias("text_key"), text.cast("binary").alias("text"), F.lit(every).alias("wanted"))

    def found_in(candidates: DataFrame) -> DataFrame:
        # A phrase in very many texts is a hot key, which Spark splits.
        held = join_unique(candidates.select("text_key", "kind", "value"), phrases, ["value"], "inner")
        return held.where("kinds & kind <> 0").select("text_key", "kind").distinct()

    some = stored(rows.mapInArrow(_candidates(known, bits, lengths, kinds, FIRST), CANDIDATES))
    found = stored(found_in(some))
    # Texts with more places than were joined, none of which was right.
    open_ = stored(some.where("more").select("text_key", "kind").distinct().join(
        found, ["text_key", "kind"], "left_anti").groupBy("text_key").agg(F.bit_or("kind").alias("wanted")))
    if open_.take(1):
        rest = join_unique(rows.drop("wanted"), open_, ["text_key"], "inner").select("text_key", "text", "wanted")
        found = found.unionByName(found_in(
            rest.mapInArrow(_candidates(known, bits, lengths, kinds, None), CANDIDATES)))
    return found.groupBy("text_key").agg(F.bit_or("kind").alias("kinds"))
