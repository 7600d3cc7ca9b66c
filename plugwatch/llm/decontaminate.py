"""Benchmark decontamination by SimHash windows.

For every item, the windows of a document that have as many words as the item get a SimHash
over their weighted word shingles. A multi-index over blocks of the items' fingerprints gives
every item within a radius of bits, and the exact weighted similarity of the shingles decides.

A window that shares no shingle with an item has similarity zero. So only windows that hold one of
the items' shingles are hashed; that leaves out nothing and spares almost all of a clean text.

Items are the stated query set. They are read in blocks of bounded size, one pass over the documents for
each, so that neither the driver nor a task holds more than ``BLOCK_CHARS`` of them.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugwatch.session import stored

SHINGLE, SIMILARITY = 5, 0.8
# At similarity 0.8 the mean distance of two fingerprints is 19 of 128 bits, with a standard deviation of
# 4; unrelated ones are 64 apart.
BITS, RADIUS = 128, 44
PIECE = 8
BLOCK_CHARS = 4_000_000

_WORD = re.compile(r"\w+")
MATCHES = "array<struct<item_id:string,similarity:double,start:int,words:int>>"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str], size: int = SHINGLE) -> list[str]:
    """All runs of ``size`` words; the whole sequence if it is shorter."""
    return [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def signs(shingles: list[str]) -> np.ndarray:
    """A row of +1 and -1 for the bits of each shingle's hash."""
    raw = b"".join(xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass")) for s in shingles)
    bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, BITS)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Sums of signs as fingerprints, one row of bytes each."""
    return np.packbits(sums > 0, axis=-1)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity; a shingle weighs as often as it occurs."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / (a.total() + b.total() - both) if a or b else 0.0


class Index:
    """The items of one block, found by shingle and by fingerprint."""

    def __init__(self, items: list[tuple[str, str]], least: float = SIMILARITY,
                 radius: int = RADIUS) -> None:
        self.least, self.radius = least, radius
        self.items, self.by_shingle = [], defaultdict(set)
        for ident, text in items:
            words = words_of(text)
            if not words:
                continue
            shingles = shingles_of(words)
            for s in set(shingles):
                self.by_shingle[s].add(len(words))
            self.items.append((ident, len(words), Counter(shingles)))
        self.vocabulary = {w for s in self.by_shingle for w in s.split(" ")}
        self.short = sorted({s.count(" ") + 1 for s in self.by_shingle} - {SHINGLE})
        self.prints = np.array([fingerprints(signs(list(c.elements())).sum(0))
                                for _, _, c in self.items], dtype=np.uint8).reshape(-1, BITS // 8)
        # Of the 16 pieces of two fingerprints at most r bits apart, one has at most r // 16 bits apart.
        near = radius // (BITS // PIECE)
        values = np.arange(1 << PIECE, dtype=np.uint8)
        close = np.bitwise_count(values[:, None] ^ values[None, :]) <= near
        self.pieces = [[np.flatnonzero(close[v][self.prints[:, p]]) for v in values]
                       for p in range(BITS // PIECE)] if len(self.prints) else []

    def within(self, fp: np.ndarray) -> np.ndarray:
        """All items at most ``radius`` bits from a fingerprint."""
        found = np.unique(np.concatenate([self.pieces[p][v] for p, v in enumerate(fp)]))
        apart = np.bitwise_count(self.prints[found] ^ fp).sum(1)
        return found[apart <= self.radius]

    def anchors(self, words: list[str]) -> dict[int, set[int]]:
        """Where shingles of items begin in a document, with their sizes, by the items' lengths."""
        known = [w in self.vocabulary for w in words]
        out = defaultdict(set)
        for size in [SHINGLE, *self.short]:
            run = 0
            for i, k in enumerate(known):
                run = run + 1 if k else 0
                if run >= size:
                    s = " ".join(words[i - size + 1:i + 1])
                    if s in self.by_shingle:
                        for n in self.by_shingle[s]:
                            out[n].add((i - size + 1, size))
        return out

    def matches(self, text: str | None) -> list[dict]:
        """The items that some window of ``text`` resembles, each with its best first window."""
        words = words_of(text)
        best: dict[int, tuple[float, int, int]] = {}
        for n, anchors in sorted(self.anchors(words).items()):
            n_doc = min(n, len(words))
            starts = sorted({s for a, size in anchors for s in range(
                max(0, a + size - n_doc), min(a, len(words) - n_doc) + 1)})
            if not starts:
                continue
            size = min(SHINGLE, n_doc)
            # Neighbouring windows share their shingles' bits through running sums.
            cut = np.flatnonzero(np.diff(starts) > n_doc) + 1
            for part in np.split(np.array(starts), cut):
                low, high = int(part[0]), int(part[-1]) + n_doc
                shingles = shingles_of(words[low:high], size)
                sums = np.vstack((np.zeros((1, BITS), np.int32), np.cumsum(signs(shingles), 0)))
                width = n_doc - size + 1
                for start in part - low:
                    fp = fingerprints(sums[start + width] - sums[start])
                    near = [i for i in self.within(fp) if self.items[i][1] == n]
                    if not near:
                        continue
                    window = Counter(shingles[start:start + width])
                    for i in near:
                        s = similarity(window, self.items[i][2])
                        if s >= self.least and s > best.get(i, (0.0,))[0]:
                            best[i] = (s, int(start) + low, n_doc)
        return [{"item_id": self.items[i][0], "similarity": s, "start": at, "words": n}
                for i, (s, at, n) in sorted(best.items())]


def _blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list]:
    """The items in blocks of about ``block_chars`` characters."""
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("id"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).distinct()
    chars = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = 1 + chars // block_chars
    for b in range(blocks):
        yield [(r["id"], r["text"]) for r in rows.filter(
            F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).sort("id", "text").collect()]


def _udf(spark: SparkSession, items: list, least: float, radius: int):
    shared = spark.sparkContext.broadcast(items)
    held: list[Index] = []

    @F.pandas_udf(MATCHES)
    def matches(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(Index(shared.value, least, radius))
        return pd.Series([held[0].matches(t) for t in texts])

    return matches


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text", least: float = SIMILARITY,
                 radius: int = RADIUS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and item it contains: (id, item_id, similarity, start_word, n_words).

    A document contains an item if one of its windows with as many words (the whole document, if
    that is shorter) has a weighted similarity of at least ``least`` in shingles of five words;
    an item of fewer words is one shingle. Words are compared in lower case and without
    punctuation. Of several windows the most similar one is told, the first of equal ones. Texts
    that are null or have no words match nothing. Items that repeat identity and text are one;
    documents that are repeated are told repeatedly. Empty tables give an empty one.
    """
    kind = items.select(F.col(f"`{item_id}`")).schema[0].dataType
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    found = [
        rows.select(id_col, F.explode(_udf(docs.sparkSession, block, least, radius)("text")).alias("m"))
        for block in _blocks(items, item_id, item_text, block_chars)
    ]
    return reduce(DataFrame.union, found).select(
        id_col, F.col("m.item_id").cast(kind).alias("item_id"), "m.similarity",
        F.col("m.start").alias("start_word"), F.col("m.words").alias("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", least: float = SIMILARITY,
                  radius: int = RADIUS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that contain no item, with their columns. Nothing is shuffled."""
    for n, block in enumerate(_blocks(items, item_id, item_text, block_chars)):
        docs = stored(docs) if n else docs  # one block at a time in a task
        matches = _udf(docs.sparkSession, block, least, radius)
        docs = docs.filter(F.size(matches(F.col(f"`{text_col}`"))) == 0)
    return docs
