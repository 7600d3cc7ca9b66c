"""Toxic spans and documents with a linear-chain conditional random field.

The field has two states per word, clean and toxic. A word's emission comes from hashed features
of the word, its beginnings and endings, so inflected forms of a known stem count too; transitions
let toxic words attract each other. Labels are given for documents, so words are labelled first:
a word of a toxic document is toxic if it, or its beginning, is told from clean documents by a
likelihood-ratio test. The field is then fitted to these labelled words. Forward-backward marginals
give offending spans, and aggregate to a document's score through a logistic regression that is
fitted to documents the field was not.

Forward and backward passes run over all words of a batch at once: the chain is cut into about
sqrt(n) pieces, whose products of 2x2 matrices are formed side by side. At a document's first word
the matrix forgets what came before, so documents of any length and number share one chain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugwatch.llm.sampling import keyed_texts, sample

FEATURE_BITS = 18
STARTS, ENDS = (3, 4, 5, 6), (3, 4)
# Bounds of what is learned from: documents of each label, and characters of each.
PER_LABEL, SAMPLE_CHARS = 2048, 20_000
THRESHOLD = 0.7
# Evidence for a toxic word: likelihood ratio, and least share of toxic documents at equal sizes.
EVIDENCE, PRECISION = 18.0, 0.9
STEPS, RATE, DECAY = 40, 0.4, 1e-4
# Words whose emissions a task remembers, and words of one chain: bound its memory.
MEMORY, CHAIN = 300_000, 1_000_000
# Words of the sample that the fit looks at at once: bounds the driver's memory.
FIT_WORDS = 200_000

_WORD = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Hashed features: the word, its beginnings and endings."""
    names = ["=" + word, *("<" + word[:n] for n in STARTS if len(word) > n),
             *(">" + word[-n:] for n in ENDS if len(word) > n), f"#{min(len(word), 12)}"]
    return [crc32(n.encode("utf-8", "surrogatepass")) & ((1 << FEATURE_BITS) - 1) for n in names]


def chain(m: list[np.ndarray]) -> np.ndarray:
    """Ratios v1 / v0 of the row vectors v = (1, 1) M_1 ... M_t, for each t; ``m`` has the entries
    00, 01, 10, 11 of the matrices."""
    n = len(m[0])
    rows = int(np.ceil(np.sqrt(n)))
    cols = -(-n // rows)
    wide = []
    for entry, fill in zip(m, (1.0, 0.0, 0.0, 1.0)):
        full = np.full(rows * cols, fill)
        full[:n] = entry
        wide.append(np.ascontiguousarray(full.reshape(cols, rows).T))
    a, b, c, d = wide
    p, q, r, s = np.ones(cols), np.zeros(cols), np.zeros(cols), np.ones(cols)
    for k in range(rows):
        p, q, r, s = p * a[k] + q * c[k], p * b[k] + q * d[k], r * a[k] + s * c[k], r * b[k] + s * d[k]
        size = 1 / (p + q + r + s)
        p, q, r, s = p * size, q * size, r * size, s * size
    ratio, x = np.empty(cols), 1.0
    for i, (p_, q_, r_, s_) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist())):
        ratio[i] = x
        x = (q_ + x * s_) / (p_ + x * r_)
    out = np.empty((rows, cols))
    for k in range(rows):
        ratio = (b[k] + ratio * d[k]) / (a[k] + ratio * c[k])
        out[k] = ratio
    return out.T.reshape(-1)[:n]


def marginals(emission: np.ndarray, first: np.ndarray, trans: np.ndarray):
    """Probability that each word is toxic, and for each word the probabilities of the four
    transitions into it (none for a first word). ``trans``: logs of 00, 01, 10, 11, and of the start in
    the toxic state."""
    e = np.exp(np.clip(emission, -20, 20))
    t00, t01, t10, t11, start = np.exp(trans)
    forward = chain([np.where(first, 1.0, t00), e * np.where(first, start, t01),
                     np.where(first, 1.0, t10), e * np.where(first, start, t11)])
    # Backward from the end: the matrix into the next word, transposed; ones after a last word.
    last = np.append(first[1:], True)
    nxt = np.append(e[1:], 1.0)
    back = chain([np.where(last, 1.0, t00)[::-1], np.where(last, 1.0, t10)[::-1],
                  np.where(last, 1.0, t01 * nxt)[::-1], np.where(last, 1.0, t11 * nxt)[::-1]])[::-1]
    both = forward * back
    p = both / (1 + both)
    before = np.append(1.0, forward[:-1])
    pairs = np.stack([np.full(len(e), t00), t01 * e * back, before * t10, before * t11 * e * back])
    pairs = np.where(first, 0.0, pairs / pairs.sum(0))
    return p, pairs


def label_words(docs: list[np.ndarray], toxic: np.ndarray, types: list[str]) -> np.ndarray:
    """Which words are told to be toxic, themselves or by their first four or five letters.
    ``docs`` are word numbers."""
    sizes = int((~toxic).sum()), int(toxic.sum())
    bad = np.zeros(len(types), dtype=bool)
    for n in (None, 4, 5):
        names: dict[str, int] = {}
        part = np.array([names.setdefault(w[:n], len(names)) if n is None or len(w) > n else -1
                         for w in types])
        counts = np.zeros((2, len(names)))
        for ids, t in zip(docs, toxic):
            own = np.unique(part[ids])
            counts[int(t), own[own >= 0]] += 1
        told = _evident(counts[1], counts[0], sizes[1], sizes[0])
        bad |= (part >= 0) & told[part] if len(told) else False
    return bad


def _evident(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Whether a toxic and b clean documents, of n1 and n0, tell that a word is toxic."""
    share = (a / max(1, n1)) / np.maximum(a / max(1, n1) + b / max(1, n0), 1e-12)
    whole = np.maximum(a + b, 1)
    log = lambda x, n: np.where(x > 0, x * np.log(np.maximum(x, 1) / whole * (n0 + n1) / max(1, n)), 0)
    return (share >= PRECISION) & (2 * (log(a, n1) + log(b, n0)) >= EVIDENCE)


def _distinct(pairs: list[tuple[bool, str]]) -> tuple[list[np.ndarray], np.ndarray, list[str]]:
    """The texts as word numbers, their labels, and the words; without texts that have no word, and
    without near copies of earlier ones, whose words would count again and again: two of four
    minima over the hashes of word triples are equal."""
    seen, docs, toxic, known = set(), [], [], {}
    for label, text in pairs:
        words = words_of(text)
        if not words:
            continue
        h = np.array([crc32(" ".join(words[i:i + 3]).encode("utf-8", "surrogatepass"))
                      for i in range(max(1, len(words) - 2))], dtype=np.uint64)
        marks = [(k, int((h * np.uint64(m) & np.uint64(0xFFFFFFFF)).min()))
                 for k, m in enumerate((1, 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))]
        if sum(m in seen for m in marks) < 2:
            docs.append(np.fromiter((known.setdefault(w, len(known)) for w in words),
                                    dtype=np.int32, count=len(words)))
            toxic.append(label)
        seen.update(marks)
    return docs, np.array(toxic, dtype=bool), list(known)


@dataclass
class Model:
    """Feature weights, transitions, and the logistic regression of documents."""

    weights: np.ndarray
    trans: np.ndarray
    document: np.ndarray

    def emissions(self) -> "Emissions":
        return Emissions(self.weights)

    def score(self, aggregates: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(aggregates @ self.document)))


class Emissions(dict):
    """Emission by word; forgets all once it holds ``MEMORY`` words."""

    def __init__(self, weights: np.ndarray) -> None:
        super().__init__()
        self.weights = weights.tolist()

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMORY:
            self.clear()
        weights = self.weights
        self[word] = total = sum([weights[f] for f in features(word)])
        return total


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def aggregates(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A document's marginals in four numbers: one, the logits of the greatest and of the second one, and
    the log of the expected number of toxic words."""
    top = np.maximum.reduceat(p, starts)
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(p))))
    rest = p.copy()
    at = np.flatnonzero(p == top[doc])
    rest[at[np.unique(doc[at], return_index=True)[1]]] = 0.0
    second = np.maximum.reduceat(rest, starts)
    logit = lambda x: np.log(np.clip(x, 1e-6, 1 - 1e-6) / (1 - np.clip(x, 1e-6, 1 - 1e-6)))
    return np.column_stack([np.ones(len(starts)), logit(top), logit(second),
                            np.log(np.add.reduceat(p, starts) + 1e-6)])


# What a document without words has: as if all its words were surely clean.
NOTHING = np.array([[1.0, np.log(1e-6), np.log(1e-6), np.log(1e-6)]])


def _parts(docs: list[np.ndarray]):
    """Documents in runs of about ``FIT_WORDS`` words: their numbers, word numbers, and starts."""
    at, held = [], 0
    for i, d in enumerate(docs):
        at.append(i)
        held += len(d)
        if held >= FIT_WORDS or i == len(docs) - 1:
            index = np.concatenate([docs[k] for k in at])
            starts = np.cumsum([0, *(len(docs[k]) for k in at[:-1])])
            first = np.zeros(len(index), dtype=bool)
            first[starts] = True
            yield at, index, first, starts
            at, held = [], 0


def fit_field(docs: list[np.ndarray], toxic: np.ndarray, types: list[str]):
    """Feature weights and transitions of the field, fitted to labelled words."""
    bad = label_words(docs, toxic, types)
    feats = [features(w) for w in types]
    rows = np.repeat(np.arange(len(types), dtype=np.int32), [len(f) for f in feats])
    cols = np.concatenate([np.array(f, dtype=np.int32) for f in feats])
    del feats
    weights, trans = np.zeros(1 << FEATURE_BITS), np.zeros(5)
    trans[4] = -2.0
    state = [np.zeros(len(weights) + 5), np.zeros(len(weights) + 5)]
    n = max(1, len(docs))
    for step in range(1, STEPS + 1):
        emission = np.bincount(rows, weights[cols], len(types))
        by_type, moves = np.zeros(len(types)), np.zeros(5)
        for at, index, first, _ in _parts(docs):
            y = (bad[index] & np.repeat(toxic[at], [len(docs[k]) for k in at])).astype(float)
            p, pairs = marginals(emission[index], first, trans)
            by_type += np.bincount(index, p - y, len(types))
            into = (np.append(0, y[:-1]) * 2 + y).astype(int)[~first]
            moves[:4] += pairs.sum(1) - np.bincount(into, minlength=4)
            moves[4] += p[first].sum() - y[first].sum()
        grad = np.concatenate([
            np.bincount(cols, by_type[rows], len(weights)) + DECAY * n * weights, moves]) / n
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad ** 2
        move = RATE * (state[0] / (1 - 0.9 ** step)) / (
            np.sqrt(state[1] / (1 - 0.99 ** step)) + 1e-8) * min(1.0, 2 * (1 - step / (STEPS + 1)))
        weights -= move[:-5]
        trans -= move[-5:]
        trans[:4] -= trans[0]  # only differences count
    return weights.astype(np.float32), trans


def fit_document(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps, both labels weighing as much as they occur."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
    return w


def _chained(docs: list[list[str]], emissions: Emissions, trans: np.ndarray):
    """Marginals of documents that all have words, and where each begins."""
    emission = np.array([emissions[w] for d in docs for w in d])
    starts = np.cumsum([0, *(len(d) for d in docs[:-1])])
    first = np.zeros(len(emission), dtype=bool)
    first[starts] = True
    return marginals(emission, first, trans)[0], starts


def fit(pairs: list[tuple[bool, str]]) -> Model:
    """Learns from (toxic, text) pairs: the field from two thirds, the document's score from one."""
    docs, toxic, types = _distinct(pairs)
    if not toxic.any() or toxic.all():
        flat = np.array([30.0 if len(toxic) and toxic.all() else -30.0, 0.0, 0.0, 0.0])
        return Model(np.zeros(1 << FEATURE_BITS, np.float32), np.zeros(5), flat)
    # Every third document of each label is kept back.
    back = np.zeros(len(docs), dtype=bool)
    for label in (False, True):
        back[np.flatnonzero(toxic == label)[2::3]] = True
    if not toxic[back].any() or toxic[back].all():
        back[:] = True
    own = ~back if (~back).any() else back
    weights, trans = fit_field([d for d, o in zip(docs, own) if o], toxic[own], types)
    known = Emissions(weights)
    emission = np.array([known[w] for w in types])
    held = [d for d, b in zip(docs, back) if b]
    x = np.concatenate([aggregates(marginals(emission[index], first, trans)[0], starts)
                        for _, index, first, starts in _parts(held)])
    return Model(weights, trans, fit_document(x, toxic[back].astype(float)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "toxic", per_label: int = PER_LABEL) -> Model:
    """A model from at most ``per_label`` documents of each label, of ``SAMPLE_CHARS``
    characters at most. A null label is none; if a document has several, toxic wins."""
    c = lambda name: F.col(f"`{name}`")
    known = labels.select(c(label_id).alias("label_id"), c(label_col).cast("int").alias("t")).filter(
        "t is not null").groupBy("label_id").agg(F.max("t").alias("t"))
    # Labels meet identities only; texts are read for the winners alone.
    ids = docs.filter(F.length(c(text_col)) <= SAMPLE_CHARS).select(c(id_col).alias("id"))
    labelled = known.join(ids, F.col("id") == F.col("label_id")).select(
        F.xxhash64(F.col("id").cast("string")).alias("h"), (F.col("t") > 0).cast("int").alias("label"))
    texts = keyed_texts(docs, c(id_col), c(text_col), SAMPLE_CHARS)
    return fit([(t == "1", text) for t, text in sample(labelled, texts, per_label)])


SPANS = "array<struct<start:int,end:int,p:double>>"


def _spans(text: str, p: np.ndarray, least: float) -> list[dict]:
    """Offending words as (start, end, p), offsets in characters of the text. Words are matched in
    lower case, where a character may become two."""
    lower = text.lower()
    found = [(m.start(), m.end(), float(x)) for m, x in zip(_WORD.finditer(lower), p) if x >= least]
    if len(lower) != len(text):
        ends = np.cumsum([len(c.lower()) for c in text])
        found = [(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(ends, b - 1, "right")) + 1, x)
                 for a, b, x in found]
    return [{"start": a, "end": b, "p": x} for a, b, x in found]


def score(df: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD,
          spans: bool = True) -> DataFrame:
    """Adds ``score`` (0 to 1), ``predicted`` (1 if the score is at least ``threshold``) and, if
    asked for, ``spans``: the words that are rather toxic than not, of predicted documents. Columns of
    these names are replaced. A text that is null or has no words is scored as one whose words
    are all surely clean. Rows are scored one by one, so repeated rows get equal scores.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.trans, model.document))

    @F.pandas_udf(f"score double, spans {SPANS}" if spans else "score double")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(*shared.value)
        emissions = model.emissions()
        empty = float(model.score(NOTHING)[0])
        for texts in batches:
            out, found = np.full(len(texts), empty), [[] for _ in texts]

            def flush(at, docs):
                p, starts = _chained(docs, emissions, model.trans)
                scores = model.score(aggregates(p, starts))
                out[at] = scores
                if spans:
                    for i, s, a, b in zip(at, scores, starts, np.append(starts[1:], len(p))):
                        if s >= threshold:
                            found[i] = _spans(texts.iloc[i], p[a:b], 0.5)

            at, docs, held = [], [], 0
            for i, text in enumerate(texts):
                if words := words_of(text):
                    at.append(i)
                    docs.append(words)
                    held += len(words)
                if held >= CHAIN:
                    flush(at, docs)
                    at, docs, held = [], [], 0
            if docs:
                flush(at, docs)
            yield pd.DataFrame({"score": out, **({"spans": found} if spans else {})})

    rows = df.withColumn("score", told(F.col(f"`{text_col}`")))
    if spans:
        rows = rows.withColumn("spans", F.col("score.spans"))
    return rows.withColumn("score", F.col("score.score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
