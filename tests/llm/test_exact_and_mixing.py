import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_brute import lowered, poisson, point
from plugwatch.llm import exact_dedup as ed
from plugwatch.llm import mixing as mx


def decided(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return Counter((i, keep[n := lowered(t)], len(groups[n]), i == keep[n],
                    hashlib.sha256(n.encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("salts", [1, 32, 63])
def test_decide_odd(odd, salts):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter(map(tuple, ed.decide(odd, salts=salts).collect())) == decided(rows)


def test_decide_documents(read):
    docs = read("documents", "sf0.01")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, ed.decide(docs).collect())) == decided(rows)


def test_dedup_keeps_columns_and_one_of_each(odd):
    kept = ed.dedup(odd)
    assert kept.dtypes == odd.dtypes
    rows = [(r.doc_id, lowered(r.text)) for r in kept.collect()]
    want = {(k[1], k[4]) for k in decided([(r.doc_id, r.text) for r in odd.collect()])}
    assert len(rows) == len(want)
    assert {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in rows} == want


def test_hot_group_and_empty(spark, table):
    hot = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Same").otherwise(
            F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    got = ed.decide(hot).filter("group_size > 1").collect()
    assert len(got) == 1000 and {(r.keep_id, r.group_size) for r in got} == {(2997, 1000)}
    assert ed.dedup(hot).count() == 2001
    none = table([])
    assert ed.decide(none).count() == 0 and ed.dedup(none).dtypes == none.dtypes
    with pytest.raises(ValueError):
        ed.decide(none, salts=64)


def copies(mean, seed, key):
    parts = max(1, math.ceil(mean / mx.MEAN_AT_ONCE))
    return sum(poisson(mean / parts, point(seed, key, i + 1)) for i in range(parts))


@pytest.mark.parametrize("mean", [0.0, 0.3, 1.0, 7.5, 255.9, 300.0, 1500.0])
def test_repetitions_match_inversion(spark, mean):
    rows = spark.range(60).select(
        "id", mx.repetitions(F.lit(mean), 3, F.col("id").cast("string")).alias("n")).collect()
    assert [r.n for r in rows] == [copies(mean, 3, str(r.id)) for r in rows]


def test_mean_and_shares(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("x" * 9).alias("text"),
        F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("source"))
    weights = spark.createDataFrame([("hot", 1.0), ("cold", 3.0), ("none", 5.0)], "source string, weight double")
    rate = mx.rates(mx.source_sizes(docs), weights.filter("source <> 'none'"))
    assert {r.source: round(r.rate, 9) for r in rate.collect()} == {"hot": 0.375, "cold": 2.25}
    got = Counter(r.source for r in mx.mix(docs, rate, 1).collect())
    assert abs(got["hot"] / 1500 - 1) < 0.1 and abs(got["cold"] / 4500 - 1) < 0.1


def test_mix_odd(odd, spark):
    rate = spark.createDataFrame(
        [("a", 2.0), ("b", 0.0), (None, 3.0)], "source string, rate double")
    got = mx.mix(odd, rate, 5)
    assert got.columns == [*odd.columns, "shuffle_key"]  # it has a column copy of its own
    want = Counter()
    for r in odd.collect():
        mean = {"a": 2.0, "b": 0.0, None: 3.0}.get(r.source, 0.0)
        key = str(r.doc_id) if r.doc_id is not None else (
            "text:" + hashlib.md5((r.text or "").encode()).hexdigest())
        n = copies(mean, 5, key)
        if n:
            want[r.doc_id, r.text, r.source] += n
    assert Counter((r.doc_id, r.text, r.source) for r in got.collect()) == want
    assert mx.mix(odd.limit(0), rate).count() == 0
    none = mx.source_sizes(odd.limit(0))
    assert mx.rates(none, mx.tempered_weights(none, 0.5)).count() == 0


def test_many_sources_give_the_same_rows(odd, spark):
    rate = spark.createDataFrame([("a", 2.0), (None, 3.0), ("none", 1.0)], "source string, rate double")
    few, many = (Counter(map(str, mx.mix(odd, rate, 5, few_sources=n).collect())) for n in (3, 2))
    assert few == many and few


def test_texts_are_shuffled_once(read, spark):
    docs = read("documents")
    rate = spark.createDataFrame([("a", 2.0)], "source string, rate double")
    plan = mx.mix(docs, rate)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    plan = mx.mix(docs, rate, few_sources=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "salt_s" in plan


def test_order_is_a_hash_and_repeats(read):
    docs = read("documents")
    sizes = mx.source_sizes(docs)
    rate = mx.rates(sizes, mx.tempered_weights(sizes, 0.5))
    first, again = ([(r.doc_id, r.copy) for r in mx.mix(docs, rate, 9).collect()] for _ in range(2))
    other = [(r.doc_id, r.copy) for r in mx.mix(docs, rate, 10).collect()]
    assert first == again and sorted(first) != first and set(first) != set(other)


def test_native(read):
    docs = read("documents")
    plan = mx.mix(docs, mx.rates(mx.source_sizes(docs), mx.tempered_weights(mx.source_sizes(docs), .5)))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Cartesian" not in text
