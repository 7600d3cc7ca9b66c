import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_brute import brute_matches
from plugwatch.llm import decontaminate as de
from plugwatch.llm import language as la
from plugwatch.llm import queries
from plugwatch.llm import toxicity as tx
from plugwatch.llm.sampling import keyed_texts, sample


def plain_runs(text):
    """The runs of letters of a text, as strings."""
    import unicodedata
    flat = re.sub("\0+", " ", "".join(
        c if unicodedata.category(c)[0] in "LM" else "\0" for c in text.lower())).lstrip(" ")
    return {flat[i:i + n] for n in range(1, la.LONGEST + 1) for i in range(len(flat) - n + 1)}


@pytest.mark.parametrize("text", ["", "a", "Ab  c!d", "ÄÖ ß\U0001d11e x́y", " -- ", "İı ſ" * 40, "ab" * 700_000])
def test_runs_are_those_of_the_text(text):
    seen = np.zeros(1 << la.RUN_BITS, dtype=bool)
    got = la.runs(text, seen)
    # Two runs may share a number, but seldom.
    assert 0 <= len(plain_runs(text)) - len(got) <= len(got) // 100 and not seen.any()


def test_scores_are_those_of_the_kernel_expansion():
    """The product of the merged matrices equals kernel values times Nyström map times weights."""
    rng = random.Random(1)
    make = lambda letters: "".join(rng.choice(letters) for _ in range(200))
    pairs = [(lang, make(a)) for lang, a in (("x", "abcd ef"), ("y", "defg hi")) for _ in range(30)]
    model = la.fit(pairs, landmarks=10)
    seen = np.zeros(1 << la.RUN_BITS, dtype=bool)
    found = [set(la.runs(t, seen).tolist()) for _, t in pairs]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    marks = [*range(10), *range(30, 40)]
    kmm = np.array([[kernel(found[i], found[j]) for j in marks] for i in marks])
    knm = np.array([[kernel(f, found[j]) for j in marks] for f in found])
    values, vectors = np.linalg.eigh(kmm)
    root = vectors / np.sqrt(values) @ vectors.T
    z = knm @ root
    y = np.array([[1, -1]] * 30 + [[-1, 1]] * 30)
    solved = np.linalg.solve(z.T @ z / 30 + la.RIDGE * np.eye(20), z.T @ y / 30)
    got = model.scores([np.array(sorted(f)) for f in found])
    assert np.abs(got - z @ solved).max() < 1e-3
    assert (got.argmax(1) == y.argmax(1)).all()


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = queries.op1_language_id(spark, "/root/testdata/sf0.01")
    rows = got.join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd(odd):
    model = la.train(odd)
    got = la.predict(odd, model)
    assert got.count() == odd.count()
    for r in got.collect():
        letters = bool(r.text) and any(c.isalpha() for c in r.text)
        assert r.lang_pred in ({"en", "de"} if letters else {"und"})
        assert 0 <= r.score <= 1 and (letters or r.score == 0)
    none = la.train(odd.limit(0))
    assert {r.lang_pred for r in la.predict(odd, none).collect()} == {"und"}
    assert la.predict(odd.limit(0), model).count() == 0


def test_held_out_is_crc32(spark):
    from zlib import crc32
    rows = spark.range(300).select("id", la.held_out("id", 4, 2).alias("h")).collect()
    assert all(r.h == (crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_sample_is_bounded_and_fixed(spark):
    docs = spark.range(5000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN 'cold' WHEN id % 50 = 2 THEN NULL"
        " ELSE 'hot' END AS l", "concat('t', id, repeat('x', cast(id % 100 as int))) AS t")
    def get(df):
        labels = df.filter("length(t) <= 60").select(
            F.xxhash64(F.col("id").cast("string")).alias("h"), F.col("l").alias("label"))
        return sample(labels, keyed_texts(df, F.col("id"), F.col("t"), 60), 40)

    got = get(docs)
    assert got == get(docs.repartition(7)) and set(Counter(k for k, _ in got)) == {"hot", "cold"}
    assert max(Counter(k for k, _ in got).values()) <= 40 and max(len(t) for _, t in got) <= 60
    # A row that is repeated without end is one row of the sample.
    assert len(get(spark.range(3000).selectExpr("1 AS id", "'a' AS l", "'t' AS t"))) == 1


def plain_marginals(emission, trans):
    """Forward-backward in logarithms over one document."""
    n, t = len(emission), np.array(trans[:4]).reshape(2, 2)
    e = np.stack([np.zeros(n), np.clip(emission, -20, 20)], 1)
    fore, back = np.zeros((n, 2)), np.zeros((n, 2))
    fore[0] = e[0] + [0, trans[4]]
    for i in range(1, n):
        fore[i] = e[i] + np.logaddexp(fore[i - 1, 0] + t[0], fore[i - 1, 1] + t[1])
    for i in range(n - 2, -1, -1):
        both = e[i + 1] + back[i + 1]
        back[i] = np.logaddexp(t[:, 0] + both[0], t[:, 1] + both[1])
    total = np.logaddexp(*(fore[-1]))
    pairs = np.zeros(4)
    for i in range(1, n):
        pairs += np.exp(fore[i - 1][:, None] + t + (e[i] + back[i])[None, :] - total).reshape(-1)
    return np.exp(fore[:, 1] + back[:, 1] - total), pairs


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1], [7, 30, 2], [500, 1, 90, 3]])
def test_marginals_against_plain_recursion(sizes):
    rng = np.random.default_rng(len(sizes))
    trans = rng.normal(size=5) * 2
    emission = [rng.normal(size=n) * 6 for n in sizes]
    first = np.concatenate([np.arange(n) == 0 for n in sizes])
    p, pairs = tx.marginals(np.concatenate(emission), first, trans)
    want = [plain_marginals(e, trans) for e in emission]
    assert np.allclose(p, np.concatenate([w[0] for w in want]), atol=1e-9)
    assert np.allclose(pairs.sum(1), sum(w[1] for w in want), atol=1e-7)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op7_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    bad, good = ([r.predicted for r in rows if r.toxic == t] for t in (1, 0))
    assert np.mean(bad) > 0.85 and np.mean(good) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_spans_are_the_offending_words():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abdegilmnort") for _ in range(rng.randrange(2, 7)))
    pairs = []
    for i in range(240):
        words = [word() for _ in range(30)]
        if i % 3 == 0:
            for _ in range(3):
                words[rng.randrange(30)] = "zork" + rng.choice(["", "ed", "ing", "s", "um"])
        pairs.append((i % 3 == 0, " ".join(words)))
    model = tx.fit(pairs)
    text = "Some, plain ZORKish words and one zorked."
    words = tx.words_of(text)
    p, _ = tx._chained([words], model.emissions(), model.trans)
    assert [text[s["start"]:s["end"]] for s in tx._spans(text, p, 0.5)] == ["ZORKish", "zorked"]


def test_toxicity_odd(odd, spark):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (None, 1), (8, 0), (9, 1), (99, 1)], "doc_id long, toxic int")
    model = tx.train(odd, labels)
    got = tx.score(odd, model).collect()
    assert len(got) == odd.count()
    empty = {r.score for r in got if not re.search(r"\w", r.text or "")}
    assert len(empty) == 1 and all(0 <= r.score <= 1 for r in got)
    for some in (labels.limit(0), labels.filter("toxic = 1"), labels.filter("toxic = 0")):
        flat = tx.train(odd, some)
        want = int(some.count() > 0 and some.first().toxic == 1)
        assert {r.predicted for r in tx.score(odd, flat).collect() if r.text and len(r.text) > 20} == {want}
    assert tx.score(odd.limit(0), model, spans=False).count() == 0


def leaky(seed, n_docs=60):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 50)))) for i in range(25)]
    items += [(90, "the the the the the the"), (91, None), (92, "?!"), (93, items[3][1].upper()),
              (3, items[3][1]), (94, "a b")]
    docs = []
    for i in range(n_docs):
        words = [word() for _ in range(rng.randrange(0, 150))]
        for _ in range(rng.randrange(0, 3)):
            own = items[rng.randrange(25)][1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                k = rng.randrange(len(own))
                own[k:k + 1] = rng.choice([[], ["new"], [own[k], "new"]])
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w + rng.choice(["", ",", "."]) for w in own]
        docs.append((i, " ".join(words)))
    docs += [(100, None), (101, ""), (102, "The the THE the the the the"), (103, "A b"),
             (104, items[7][1][:-3]), (105, items[3][1])]
    return items, docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_against_brute_force(seed):
    items, docs = leaky(seed)
    index = de.Index([(str(i), t or "") for i, t in sorted(set(items), key=str)])
    for _, text in docs:
        got = {int(m["item_id"]): (round(m["similarity"], 9), m["start"], m["words"])
               for m in index.matches(text)}
        assert got == brute_matches(text, items)


@pytest.mark.parametrize("block_chars", [200, 10**6])
def test_contaminated(spark, block_chars):
    items, docs = leaky(4)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    rows = de.contaminated(d, b, block_chars=block_chars)
    assert dict(rows.dtypes) == {"doc_id": "bigint", "item_id": "bigint", "similarity": "double",
                                 "start_word": "int", "n_words": "int"}
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word, r.n_words) for r in rows.collect()}
    want = {(i, k): v for i, t in docs for k, v in brute_matches(t, items).items()}
    assert got == want and len(got) > 20
    clean = de.decontaminate(d, b, block_chars=block_chars)
    assert clean.columns == d.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_contaminated_empty_and_odd(spark, odd):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert de.contaminated(odd, no_items).count() == 0 and de.decontaminate(odd, no_items).count() == odd.count()
    items = spark.createDataFrame([(1, "same for all of them"), (None, "eins")], "item_id long, text string")
    assert de.contaminated(odd.limit(0), items).count() == 0
    assert Counter((r.doc_id, r.item_id) for r in de.contaminated(odd, items).collect()) == Counter(
        [(1, 1), (2, 1), (2, 1), (None, 1), (10, None)])


def test_index_gives_all_within_the_radius():
    rng = np.random.default_rng(0)
    index = de.Index([(str(i), " ".join(f"w{x}" for x in rng.integers(0, 50, 20))) for i in range(300)])
    for _ in range(50):
        fp = index.prints[rng.integers(300)].copy()
        bits = np.unpackbits(fp)
        bits[rng.choice(128, rng.integers(0, 60), replace=False)] ^= 1
        fp = np.packbits(bits)
        apart = np.bitwise_count(index.prints ^ fp).sum(1)
        assert set(index.within(fp)) == set(np.flatnonzero(apart <= index.radius))


def test_documents_leaks_are_found(spark):
    """Every document that holds an item word for word is told."""
    sf = "/root/testdata/sf0.01"
    flat = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    items = [flat(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {r.doc_id for r in docs if any(i in flat(r.text) for i in items)}
    got = {r.doc_id for r in queries.op3_decontamination(spark, sf).collect()}
    assert want and want <= got


def test_offsets_are_those_of_the_text():
    """Where lower case is longer than the text, spans still cut the words out of the text."""
    from plugwatch.llm import toxicity

    text = "İİİ bad wordİ ẞΣ end"
    words = [m.group() for m in toxicity._WORD.finditer(text.lower())]
    found = toxicity._spans(text, np.ones(len(words)), 0.5)
    cut = [text[s["start"]:s["end"]] for s in found]
    assert {"bad", "end"} <= set(cut) and all(w in c.lower() for w, c in zip(words, cut))
