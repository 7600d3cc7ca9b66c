import random
from collections import Counter

import pytest

from plugwatch.llm import suffixes as sx


def brute(texts, length):
    """Every run counted, every byte of a repeated one removed."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def told(df, **options):
    rows = sx.remove_repeats(df, **options).collect()
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows)


def expected(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    return Counter((i, *x) for (i, _), x in zip(rows, brute(texts, length)))


@pytest.mark.parametrize("length,letters", [
    (2, "abcdefghij"), (3, "abcdefghijklmnop"), (20, "ab"), (12, "abc"), (33, "a"), (40, "abcdefgé"),
    (100, "abcd "),
])
def test_against_brute_force(table, length, letters):
    rng = random.Random(length)
    some = lambda n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
    passages = [some(3 * length) for _ in range(6)]
    rows = [(i, "".join(rng.choice([rng.choice(passages), some(2 * length)]) for _ in range(4)))
            for i in range(40)]
    assert told(table(rows).repartition(3), length=length, bucket_bytes=500) == expected(rows, length)


def test_edges_of_a_passage(table):
    """Passages one byte shorter than, equal to and longer than the threshold, at all places."""
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rows = []
    for size in (399, 400, 401, 655, 656, 1300):
        passage = word(size)
        for before in (0, 1, 150, 700):
            rows.append((len(rows), word(before) + passage + word(rng.choice([0, 1, 300]))))
    assert told(table(rows)) == expected(rows, 400)


def test_overlap_with_itself(table):
    rows = [(1, "x" * 3000), (2, "ab" * 200), (3, "ab" * 201), (4, "y" * 400), (5, "z" * 401)]
    got = {r[0]: r[1:4] for r in told(table(rows))}
    assert told(table(rows)) == expected(rows, 400)
    assert got == {1: (3000, 3000, 1), 2: (400, 400, 1), 3: (402, 402, 1), 4: (400, 0, 0), 5: (401, 401, 1)}


def test_blocks_of_a_long_text(table, monkeypatch):
    """Edges of the blocks that are looked at together lose nothing."""
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdef") for _ in range(700))
    texts = ["".join(rng.choice("abcdef") for _ in range(n)) for n in (900, 2500, 40)]
    rows = [(1, texts[0] + passage + texts[1]), (2, passage[:650] + texts[2] + passage[100:]), (3, texts[1])]
    monkeypatch.setattr(sx, "SLAB", 97)
    monkeypatch.setattr(sx, "HELD", 5)
    assert told(table(rows), length=60) == expected(rows, 60)


def test_odd_tables(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = told(odd, length=30)
    short = [(i, t if t and len(t) < 9000 else None) for i, t in rows]
    want = expected(short, 30)
    for row, n in want.items():
        if row[1]:
            assert got[row] == n
    # The two copies of the long text go whole, and so does nothing of the empty ones.
    assert [r[1:4] for r in got.elements() if r[0] in (8, 9)] == [(r[1], r[1], 1) for r in got.elements() if r[0] in (8, 9)]
    assert sx.remove_repeats(odd.limit(0)).count() == 0
    assert sx.remove_repeats(odd).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    with pytest.raises(ValueError):
        sx.remove_repeats(odd, length=1)


def test_hot_passage(spark):
    """A passage in a third of all rows, each time between other words, is one record a task in
    every round, not one a row."""
    from pyspark.sql import functions as F

    passage = " ".join(f"p{i * i % 101}q{i}" for i in range(60))
    assert 400 <= len(passage) < 600
    docs = spark.range(0, 3000, numPartitions=4).select(
        F.col("id").alias("doc_id"),
        F.concat(F.sha2(F.col("id").cast("string"), 512),
                 F.when(F.col("id") % 3 == 0, passage).otherwise(""),
                 F.sha2((-F.col("id")).cast("string"), 512)).alias("text"))
    names = docs.select(F.monotonically_increasing_id(), F.col("text").cast("binary")).mapInArrow(
        sx._name(400, sx.widths(400)[0]), sx.NAMES)
    hot = names.filter("kind = 0").groupBy("n1").count().agg(F.max("count")).first()[0]
    assert hot <= 4
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert told(docs) == expected(rows, 400)


def test_stored_tables_are_joined_as_they_lie(spark):
    """Texts are shuffled once: the joins of the rounds have no exchange."""
    one = sx._bucketed(spark.range(100).selectExpr("id AS row", "id AS x"), 4)
    two = sx._bucketed(spark.range(50).selectExpr("id AS row", "id AS y"), 4)
    joined = one.join(two.hint("shuffle_hash"), "row", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and joined.count() == 100
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
