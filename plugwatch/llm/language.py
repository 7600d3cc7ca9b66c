"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts counts the character runs of one to ``LONGEST``
letters that both have, over the root of the product of how many each has. A bounded sample gives
landmarks for a Nyström map of the kernel, and one ridge regression per language is solved in that
space. As kernel values, map and regression are all linear in which runs a text has, the three
matrices are multiplied once, and a batch of texts is scored by one product of its sparse
presence matrix with a dense matrix of one column per language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plugwatch.llm.sampling import keyed_texts, sample

LONGEST = 4
# A run of letters is known by this many bits of a hash.
RUN_BITS = 18
UNKNOWN = "und"
# Bounds of what is learned from: documents per language, in all, and characters of each.
PER_LANGUAGE, SAMPLE, SAMPLE_CHARS = 400, 8000, 20_000
LANDMARKS = 64  # per language
RIDGE = 1e-3
# Characters looked at at once: bounds a task's memory for a very long text.
BLOCK = 1 << 20

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)),
                                   dtype=bool, count=0x110000))
    return _LETTER[0]


def runs(text: str, seen: np.ndarray) -> np.ndarray:
    """Which runs of letters a text has, as sorted numbers. Lower case; whatever is no letter or
    mark counts as one blank. ``seen`` is a blank array of ``2 ** RUN_BITS`` that is blank afterwards."""
    for at in range(0, len(text), BLOCK):
        piece = text[max(0, at - LONGEST):at + BLOCK].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        codes = np.where(letter, codes, 32)
        stay = letter.copy()
        stay[1:] |= letter[:-1]
        codes = codes[stay].astype(np.uint64)
        hashed = np.zeros(len(codes), dtype=np.uint64)
        for n in range(1, LONGEST + 1):
            if len(codes) < n:
                break
            hashed = (hashed[:len(codes) - n + 1] + codes[n - 1:]) * np.uint64(0x9E3779B97F4A7C15)
            hashed ^= hashed >> np.uint64(29)
            seen[((hashed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - RUN_BITS)).astype(np.int64)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class Model:
    """``weights``: a row per run, a column per language."""

    languages: list[str]
    weights: np.ndarray

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        """The regressions' values of texts of which each has some run."""
        starts = np.cumsum([0, *(len(f) for f in found[:-1])])
        total = np.add.reduceat(self.weights[np.concatenate(found)], starts, axis=0)
        return total / np.sqrt([len(f) for f in found])[:, None]


def fit(pairs: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learns from (language, text) pairs."""
    pairs = [(lang, text) for lang, text in pairs if has_letter(text)]
    languages = sorted({lang for lang, _ in pairs})
    if not languages:
        return Model([], np.zeros((1 << RUN_BITS, 0), np.float32))
    seen = np.zeros(1 << RUN_BITS, dtype=bool)
    found = [runs(text, seen) for _, text in pairs]
    marks, taken = [], dict.fromkeys(languages, 0)
    for i, (lang, _) in enumerate(pairs):
        if taken[lang] < landmarks:
            taken[lang] += 1
            marks.append(i)
    known = np.unique(np.concatenate([found[i] for i in marks]))
    column = np.full(1 << RUN_BITS, -1)
    column[known] = np.arange(len(known))
    has = np.zeros((len(known), len(marks)), dtype=np.float32)
    for m, i in enumerate(marks):
        has[column[found[i]], m] = 1 / np.sqrt(len(found[i]))

    def kernel(f: np.ndarray) -> np.ndarray:
        at = column[f]
        return has[at[at >= 0]].sum(0) / np.sqrt(len(f))

    k = np.array([kernel(f) for f in found], dtype=np.float64)
    values, vectors = np.linalg.eigh(k[marks])
    good = values > 1e-8 * values[-1]
    mapping = vectors[:, good] / np.sqrt(values[good])  # Nyström: K_mm^(-1/2) on its own axes
    z = k @ mapping
    y = np.array([[1.0 if lang == own else -1.0 for lang in languages] for own, _ in pairs])
    size = np.array([1.0 / sum(a == own for a, _ in pairs) for own, _ in pairs])[:, None]
    solved = np.linalg.solve(z.T @ (z * size) + ridge * np.eye(z.shape[1]), z.T @ (y * size))
    weights = np.zeros((1 << RUN_BITS, len(languages)), dtype=np.float32)
    weights[known] = has @ (mapping @ solved)
    return Model(languages, weights)


def train(df: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          per_language: int = PER_LANGUAGE) -> Model:
    """A model from a sample of the rows: at most ``per_language`` documents of each language,
    ``SAMPLE`` in all, of ``SAMPLE_CHARS`` characters at most. Only language and text are
    learned from; the identity only chooses the sample. A language has a text if it has a letter."""
    c = lambda name: F.col(f"`{name}`")
    languages = df.agg(F.count_distinct(c(lang_col))).first()[0]
    slots = max(1, min(per_language, SAMPLE // max(1, languages)))
    texts = keyed_texts(df.select(id_col, text_col), c(id_col), c(text_col), SAMPLE_CHARS)
    labels = df.filter(F.length(c(text_col)) <= SAMPLE_CHARS).select(
        F.xxhash64(c(id_col).cast("string")).alias("h"), c(lang_col).alias("label"))
    return fit(sample(labels, texts, slots))


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) to ``df``; columns of these names are replaced.

    The language with the highest value wins, the first in order of those equal. ``und`` with
    score 0 if the text is null or has no letter, or nothing was learned.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.weights))

    @F.pandas_udf("lang_pred string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(*shared.value)
        seen = np.zeros(1 << RUN_BITS, dtype=bool)
        for texts in batches:
            lang, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
            # A few hundred texts at once bound the size of the gathered rows.
            good = [i for i, t in enumerate(texts) if model.languages and has_letter(t)]
            for at in range(0, len(good), 256):
                part = good[at:at + 256]
                f = model.scores([runs(texts.iloc[i], seen) for i in part])
                best = f.argmax(1)
                lang[part] = np.array(model.languages, dtype=object)[best]
                score[part] = np.clip((f[np.arange(len(part)), best] + 1) / 2, 0, 1)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    told = df.withColumn("lang_pred", guess(F.col(f"`{text_col}`")))
    return told.withColumn("score", F.col("lang_pred.score")).withColumn(
        "lang_pred", F.col("lang_pred.lang_pred"))


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the identity as text leaves ``part``; a null one counts as empty."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % parts == part
