import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_brute import plain_simhash
from plugwatch.llm import simhash as sh
from plugwatch.llm import substring as sb
from plugwatch.session import stored


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbé \t\n\x0b\x0c\r\x1c\x85\xa0\U0001d11e", max_size=60))
def test_simhash_value(text):
    assert sh.simhash(text) == signed(plain_simhash(text))


def test_simhash_of_a_very_long_text():
    text = " ".join(str(i % 5003) for i in range(70_000))
    assert sh.simhash(text) == signed(plain_simhash(text))
    assert sh.simhash(None) == sh.simhash(" \x0b") == 0


def grouped(rows, distance=3):
    """By brute force: for each row its fingerprint and the least identity reachable."""
    fps = [plain_simhash(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            r = find(i)
            least[r] = min(ident, least.get(r, ident))
    return Counter((i, f"{fp:016x}", least.get(find(k))) for k, ((i, _), fp) in enumerate(zip(rows, fps)))


def test_group_odd(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(map(tuple, sh.group(odd).collect())) == grouped(rows)
    kept = sh.near_dedup(odd)
    assert kept.dtypes == odd.dtypes
    ids = [r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {c for _, _, c in grouped(rows) if c is not None}
    assert sh.group(odd.limit(0)).count() == 0 and sh.near_dedup(odd.limit(0)).count() == 0


def test_one_row_of_each_group_stays(table):
    rng = random.Random(3)
    first, other, third = (" ".join(f"{c}{rng.randrange(400)}" for _ in range(300)) for c in "abc")
    near = next(t for t in (first + f" w{i}" for i in range(500))
                if 0 < (plain_simhash(t) ^ plain_simhash(first)).bit_count() <= 3)
    rows = [(1, first), (5, near), (5, other), (5, third), (6, other), (None, "x y z"), (None, "X y z"),
            (None, first), (None, third.upper())]
    got = Counter(map(tuple, sh.near_dedup(table(rows).repartition(3)).collect()))
    lone = [k for k in got if k[0] is None]
    assert len(lone) == 1 and lone[0][1].lower() == "x y z"
    assert got == Counter([(1, first), (5, other), (5, third), lone[0]])


def test_group_documents(read):
    docs = read("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, sh.group(docs).collect())) == grouped(rows)


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_are_complete(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    fps = set(base)
    for b in base:
        for _ in range(40):
            flips = rng.sample(range(64), rng.randint(0, 5))
            fps.add(b ^ sum(1 << f for f in flips))
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {frozenset(r) for r in sh.links(nodes, distance).collect()}
    all_of = sorted(fps)
    want = {frozenset((signed(a), signed(b))) for i, a in enumerate(all_of) for b in all_of[:i]
            if (a ^ b).bit_count() <= distance}
    assert got == want


def within(fps, distance=3):
    """All pairs at most ``distance`` bits apart, by brute force in blocks."""
    bits = np.array(sorted(fps), dtype=np.uint64)
    found = set()
    for i, one in enumerate(bits):
        near = np.bitwise_count(bits[:i] ^ one) <= distance
        found |= {frozenset((signed(int(x)), signed(int(one)))) for x in bits[:i][near]}
    return found


@pytest.mark.parametrize("hot", [0, 5, 64, 10**6])
def test_buckets_are_split_exactly(spark, hot):
    rng = random.Random(7)
    halves = [rng.getrandbits(32) for _ in range(3)]
    halves += [halves[0] ^ 1 << 9, halves[1] ^ 1 << 31]  # both sides of a wildcard bucket are large
    fps = {half << shift | rng.getrandbits(32) << (32 - shift)
           for half in halves for shift in (0, 32) for _ in range(90)}
    for f in list(fps):
        fps |= {f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(3)}
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = Counter(frozenset(r) for r in sh.links(nodes, hot=hot).collect())
    assert set(got) == within(fps)
    assert max(got.values()) <= 2  # once for each segment


def test_hot_segment_makes_few_candidates(spark):
    """A third of all fingerprints have one half in common."""
    rng = random.Random(8)
    half = rng.getrandbits(32)
    fps = {rng.getrandbits(32) << 32 | half for _ in range(10_000)}
    fps |= {rng.getrandbits(64) for _ in range(20_000)}
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(8)
    assert sh.hot_buckets(nodes).collect() == [(sh.SEGMENT, half)]
    # Unsplit, the bucket alone would make 10^8 pairs.
    assert sh.candidates(nodes).filter("a <> b").count() < 40 * len(fps)


def test_texts_are_fingerprinted_once(read):
    plan = sh.near_dedup(read("documents"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_variants_are_not_broadcast(spark):
    """Spark takes the exploded variants for no larger than the fingerprints."""
    nodes = stored(spark.range(3000).select(F.xxhash64("id").alias("fp")))
    plan = final_plan(sh.candidates(nodes))
    assert re.search(r"SortMergeJoin(\(skew=true\))? \[slot#\d+, key#\d+L, part#", plan)
    assert not re.search(r"BroadcastHashJoin \[slot#\d+, key#\d+L, part#", plan)


def test_rows_of_documents_are_not_broadcast(table):
    """Many documents with one text take few bytes on disk."""
    rows = [(i, f"text number {i % 7} of some") for i in range(3000)]
    plan = final_plan(sh.group(table(rows)))
    assert not re.search(r"BroadcastHashJoin \[fp#\d+L\], \[fp#\d+L\], Inner", plan)
    assert re.search(r"SortMergeJoin(\(skew=true\))? \[fp#\d+L\], \[fp#\d+L\], Inner", plan)


def test_links_beyond_two_segments_are_refused(spark):
    with pytest.raises(ValueError):
        sh.links(spark.range(0).select(F.col("id").alias("fp")), 4)


@pytest.mark.parametrize("pairs", [
    [(i, i + 1) for i in range(200)], [(0, i) for i in range(1, 300)], [(-5, 7), (7, 7), (9, 7), (1, 2)],
    [(i, (i * 7 + 3) % 150) for i in range(150)],
])
def test_components(spark, pairs):
    got = {r.node: r.root for r in sh.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in pairs)}


def test_near_copies_of_one_text_meet(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(400)}" for _ in range(300)]
    rows = []
    for i in range(60):
        copy = list(words)
        if i % 2:
            copy[rng.randrange(300)] = "changed"
        rows.append((i, " ".join(copy)))
    got = Counter(map(tuple, sh.group(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == grouped(rows)


def cut(rows, window=20):
    """By brute force, for rows in the order of the operator."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    first = {}
    docs = [(k, i, (t or "").encode().split()) for k, (i, t) in enumerate(rows)]
    for k, _, w in docs:
        for a in range(len(w) - window + 1):
            first.setdefault(tuple(w[a:a + window]), (k, a))
    out = Counter()
    for k, i, w in docs:
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < (k, a):
                gone[a:a + window] = [True] * window
        left = [x for x, g in zip(w, gone) if not g]
        out[i, len(w), len(w) - len(left), b" ".join(left).decode()] += 1
    return out


def test_repeats_in_documents(read):
    docs = read("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, sb.remove_repeats(docs).collect())) == cut(rows)


@pytest.mark.parametrize("batch, shard_chars", [(1, 40), (300, 4000), (10**6, 10**9)])
def test_repeats_random(spark, monkeypatch, batch, shard_chars):
    monkeypatch.setattr(sb, "BATCH_WORDS", batch)
    rng = random.Random(batch)
    passages = [[f"p{rng.randrange(30)}" for _ in range(rng.randrange(18, 60))] for _ in range(12)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randrange(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.7 else [
                f"q{rng.randrange(3)}" for _ in range(rng.randrange(1, 40))]
        rows.append((i, " ".join(words)))
    rows += [(100, "same " * 70), (101, "a b " * 30), (102, None), (103, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, sb.remove_repeats(df, shard_chars=shard_chars).collect()))
    assert got == cut(rows)


def test_repeats_odd(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = Counter(map(tuple, sb.remove_repeats(odd).collect()))
    assert got == cut(rows)
    assert {r[2] > 0 for r in got if r[0] == 9} == {True}
    assert sb.remove_repeats(odd.limit(0)).count() == 0


def test_repeated_rows_are_one_document(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text)] * 4 + [(None, text)] * 2 + [(5, text), (3, text + " more")]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in sb.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, 50, 0)] * 2 + [(3, 50, 50)] * 4 + [(3, 51, 50), (5, 50, 50)], key=str)


def test_windows_share_minimizers():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 500, dtype=np.uint64)
    both = np.concatenate([words, rng.integers(0, 2**63, 7, dtype=np.uint64), words[100:200]])
    best, place, rest = sb.windows(both)
    at = 507 + np.arange(81)
    for x in (best, place, rest):
        assert (x[at] == x[100 + np.arange(81)]).all()
    assert len({*zip(best.tolist(), place.tolist(), rest.tolist())}) == len(best) - 81


def test_windows_of_one_minimizer_are_told_by_64_bits():
    words = np.random.default_rng(2).integers(0, 2**63, 500, dtype=np.uint64)
    assert (sb.windows(words)[2] >> np.uint64(40)).any()
    rest = np.array([1, 1 | 1 << 41, 1 | 1 << 63, 1], dtype=np.uint64)
    best, place = np.full(4, 5, dtype=np.uint64), np.full(4, 3, dtype=np.uint8)
    packed = sb._pack(best, place, rest, np.arange(4), np.arange(4), np.zeros(4, dtype=np.int64))
    opened = sb._opened([blob for _, blob in sb._grouped(*packed, 1)])
    assert sb._later(*opened).tolist() == [False, False, False, True]
