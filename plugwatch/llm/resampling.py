"""Importance resampling of a corpus towards a target, by hashed runs of words.

The texts of a batch are joined with a separator between them, and one pass of a pattern finds the
words of all of them. The place of each word among the offsets of the texts (``searchsorted``) tells
whose it is, which masks the runs that would cross from one text to the next. Hashed to buckets, the
runs of a batch are counted at once (``bincount``).

The corpus and the target are counted in full, a vector of ``buckets`` numbers for each task. A bucket
gains as it is more frequent in the target; a document is worth the mean gain of its runs. Gumbel
noise from a hash of the identity turns the highest scores into a sample without replacement.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plugwatch.llm.common import id_text
from plugwatch.session import stored

BUCKETS, GRAMS, SEED, PERCENT, LEAST_WORDS = 10_000, 1, 2024, 10, 20
# All but ASCII letters in lower case, digits and what is not ASCII parts words.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
SEPARATOR = b"\x00"
# Bytes of text that are joined; bounds a task's memory. A longer text comes in parts of that size.
JOINED = 2_000_000
# Distinct runs whose hash a task keeps.
KNOWN_WORDS = 500_000


def _parts(text: bytes, grams: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts cut between words; each but the first starts with the last
    ``grams - 1`` words before it, and comes with their number, so that no run is lost or counted
    twice."""
    at, old, cut = 0, 0, 0
    while True:
        gap = GAP.search(text, cut + JOINED) if len(text) - cut > JOINED else None
        part = text[at:gap.start()] if gap else text[at:]
        yield part, old
        if not gap:
            return
        cut = gap.start()
        starts = [m.start() for m in WORD.finditer(part)][-(grams - 1):] if grams > 1 else []
        old = len(starts)
        at = at + starts[0] if starts else cut


def _batches(texts: Iterator[bytes], grams: int):
    """Parts of texts, joined up to a size: lists of (number of the text, part, old words)."""
    held, size = [], 0
    for i, text in enumerate(texts):
        for part, old in _parts(text.lower(), grams):
            held.append((i, part, old))
            size += len(part)
            if size >= JOINED:
                yield held
                held, size = [], 0
    if held:
        yield held


class _Hashes(dict):
    """The CRC-32 of runs of words, each computed once while there is room."""

    def __missing__(self, word: bytes) -> int:
        found = crc32(word)
        if len(self) < KNOWN_WORDS:
            self[word] = found
        return found


def runs(parts: list[tuple[int, bytes, int]], grams: int, buckets: int, known: _Hashes):
    """(part, bucket) of every run of 1 to ``grams`` words, and the words of each part."""
    joined = SEPARATOR.join(p[1] for p in parts)
    sizes = np.array([len(p[1]) + 1 for p in parts])
    offsets = np.cumsum(sizes) - sizes
    found = list(WORD.finditer(joined))
    words = [m.group() for m in found]
    starts = np.fromiter((m.start() for m in found), np.int64, len(found))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    old = np.array([p[2] for p in parts])
    place = np.arange(len(words)) - np.searchsorted(owner, owner)
    parts_of, hashes = [], []
    for n in range(1, grams + 1):
        last = len(words) - n + 1
        if last <= 0:
            break
        # A run that crosses texts, or lies in the words a part repeats, is none.
        whole = (owner[:last] == owner[n - 1:]) & (place[n - 1:] >= old[owner[n - 1:]])
        at = np.flatnonzero(whole)
        said = (words[i] if n == 1 else b" ".join(words[i:i + n]) for i in at.tolist())
        hashes.append(np.fromiter(map(known.__getitem__, said), np.int64, len(at)))
        parts_of.append(owner[at])
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(parts), np.int64)
    n_words = np.bincount(parts_of[0], minlength=len(parts))
    return np.concatenate(parts_of), np.concatenate(hashes) % buckets, n_words


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (t.as_py() or b"" for t in column)


def _count(grams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(buckets, dtype=np.int64), _Hashes()
        for batch in batches:
            for parts in _batches(_texts(batch.column(0)), grams):
                total += np.bincount(runs(parts, grams, buckets, known)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    return run


def _bytes(text_col: str) -> Column:
    return F.col(f"`{text_col}`").cast("binary")


def counts(df: DataFrame, text_col: str = "text", grams: int = GRAMS,
           buckets: int = BUCKETS) -> np.ndarray:
    """How many runs of all texts fall into each bucket. Null texts have none; repeated rows
    count each time. At most ``buckets`` sums come to the driver."""
    if grams < 1 or buckets < 1:
        raise ValueError("one word and one bucket at least")
    told = df.select(_bytes(text_col)).mapInArrow(_count(grams, buckets), "bucket int, n long")
    total = np.zeros(buckets, dtype=np.int64)
    for row in told.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a run of each bucket is worth, in thousandths, rounded down: the logarithm of the
    target's share against the corpus's, each with one run more in every bucket."""
    n, all_of, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float((t + 1) * (all_of + n)) / float((s + 1) * (all_target + n))))
        for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def _weigh(worth: np.ndarray, grams: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            size = batch.num_rows
            words, features, gain = (np.zeros(size, dtype=np.int64) for _ in range(3))
            for parts in _batches(_texts(batch.column(1)), grams):
                part, bucket, n_words = runs(parts, grams, len(worth), known)
                number = np.array([p[0] for p in parts])
                np.add.at(words, number, n_words)
                # Sums of whole numbers far below 2**53.
                features += np.bincount(number[part], minlength=size)
                gain += np.bincount(number[part], worth[bucket], minlength=size).astype(np.int64)
            weight = np.where(features > 0, gain // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x) for x in (words, features, weight)]],
                ["id", "n_words", "n_features", "weight"])

    return run


def weigh(df: DataFrame, worth: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          grams: int = GRAMS, seed: int = SEED) -> DataFrame:
    """One row per row of ``df``: (id, n_words, n_features, weight, score), whole numbers.

    ``weight`` is the mean gain of the runs, rounded down, 0 without any. ``score`` adds Gumbel
    noise from the identity's hash, so equal identities get equal noise; a null identity counts as
    the empty text there. Other columns are not looked at.
    """
    kind = df.schema[id_col].dataType.simpleString()
    told = df.select(F.col(f"`{id_col}`").alias("id"), _bytes(text_col).alias("text")).mapInArrow(
        _weigh(worth, grams), f"id {kind}, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text("id")), 256)
    point = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(point))).cast("long")
    return told.withColumn("score", F.col("weight") + noise).withColumnRenamed("id", id_col)


def draw(weighed: DataFrame, id_col: str = "doc_id", percent: int = PERCENT,
         least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``weigh`` with ``rank``: 1, 2, 3, … for the ``percent`` of the rows with
    ``least_words`` or more that score highest, null for the others. Ties go to the smaller identity
    (a null one comes first), then to the smaller other columns; rows equal in all are told apart at
    will. An empty table gives an empty one.

    Scores are whole numbers of a narrow range whatever the size (the noise has 26,000 values),
    so their counts give the first rank of each score, and ranks are then counted within a score.
    Equal rows are one row with a count until they have their ranks.
    """
    columns = [id_col, "n_words", "n_features", "weight", "score"]
    told = stored(weighed.select(*columns))
    may = F.col("n_words") >= least_words
    size = told.filter(may).count() * percent // 100
    by_score = told.filter(may).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    first = by_score.select("score", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before")) \
        .filter(F.col("before") < size).withColumn("may", F.lit(True))
    alike = told.withColumn("may", may).groupBy(*columns, "may").agg(F.count(F.lit(1)).alias("n"))
    placed = alike.join(first, ["score", "may"], "left")
    drawn = placed.filter("before is not null")
    within = Window.partitionBy("score").orderBy(
        F.asc_nulls_first(f"`{id_col}`"), "n_words", "n_features", "weight"
    ).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0))
    ranked = drawn.withColumn("start", start).unionByName(
        placed.filter("before is null").withColumn("start", F.lit(None).cast("long")))
    each = ranked.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    rank = F.col("start") + F.col("i")
    return each.select(*columns, F.when(rank <= size, rank).alias("rank"))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS,
             seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows of ``df``, weighed and drawn: see :func:`weigh` and :func:`draw`."""
    worth = gains(counts(df, text_col, grams, buckets), counts(target, target_text, grams, buckets))
    return draw(weigh(df, worth, id_col, text_col, grams, seed), id_col, percent, least_words)
