import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from llm_brute import lowered
from plugwatch.llm import resampling as rs


def features(text, grams):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    runs = [" ".join(words[i:i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]
    return words, [crc32(r.encode()) for r in runs]


def brute(rows, target, grams=1, buckets=rs.BUCKETS, percent=10, least=20):
    s, t = (Counter(h % buckets for text in texts for h in features(text, grams)[1])
            for texts in ([x for _, x in rows], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(
        (t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for ident, text in rows:
        words, found = features(text, grams)
        weight = sum(gain(h % buckets) for h in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((ident, len(words), len(found), weight, weight + noise))
    may = sorted((r for r in out if r[1] >= least),
                 key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[1:4]))
    ranks = defaultdict(list)
    for i, r in enumerate(may[:percent * len(may) // 100], 1):
        ranks[r].append(i)
    return Counter((*r, ranks[r].pop(0) if ranks[r] else None) for r in out)


def told(df, target, **options):
    return Counter(map(tuple, rs.resample(df, target, **options).collect()))


@pytest.mark.parametrize("grams,percent", [(1, 10), (1, 100), (2, 50), (3, 33)])
def test_against_brute_force(read, grams, percent):
    docs, items = read("documents"), read("benchmark")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = [r.text for r in items.collect()]
    assert told(docs, items, grams=grams, percent=percent) == brute(rows, target, grams, percent=percent)


def test_no_run_crosses_texts_or_is_lost_at_a_cut(monkeypatch):
    monkeypatch.setattr(rs, "JOINED", 11)
    texts = ["one two three four five six seven", "", "  ", "x", "a bb ccc dddd eeeee ffffff " * 3,
             "averyverylongwordthatfillsmorethanonepart", "é" * 30 + " ü " + "word " * 9]
    for grams in (1, 2, 3, 4):
        got = [[] for _ in texts]
        words = [0] * len(texts)
        known = rs._Hashes()
        for parts in rs._batches(iter(t.encode() for t in texts), grams):
            part, bucket, n_words = rs.runs(parts, grams, 1 << 32, known)
            for p, b in zip(part, bucket):
                got[parts[p][0]].append(int(b))
            for (i, _, _), n in zip(parts, n_words):
                words[i] += n
        for t, g, n in zip(texts, got, words):
            own, want = features(t, grams)
            assert (Counter(g), n) == (Counter(want), len(own))


def test_odd_tables(odd, table):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    target = ["some words", None, "", "same same"]
    items = table([(i, t) for i, t in enumerate(target)])
    assert told(odd, items, percent=60, least_words=5) == brute(rows, target, percent=60, least=5)
    none = odd.limit(0)
    assert rs.resample(none, items).count() == 0
    assert told(odd, items.limit(0)) == brute(rows, [])


def test_a_third_of_all_rows_alike(table):
    """Equal rows share a score; their ranks are told apart, and none is given twice."""
    rows = [(7, "the same words again " * 6)] * 300 + [(i, f"w{i} and some more " * 6) for i in range(600)]
    got = told(table(rows), table([(1, "more words")]), percent=50)
    assert got == brute(rows, ["more words"], percent=50)
    ranks = sorted(r[5] for r in got.elements() if r[5])
    assert ranks == list(range(1, 451))


def test_gains_favour_the_target():
    worth = rs.gains(np.array([10, 0, 5]), np.array([0, 10, 5]))
    assert worth[0] < worth[2] == 0 < worth[1]
