import random

import pytest
from pyspark.sql import functions as F

import brute
from plugwatch.functions import specs as sp
from plugwatch.functions.numbers import limit_ok, parse_range, voltage_ok
from plugwatch.operators import scoring

TOKENS = (
    "100 240 230 12 5 0.5 2.4 500 3000 13 1230 50/60 60 100-240 5–9 3/4 1.5-2 19.5 2 20 7.25 "
    "V v VAC vdc ⎓ A mA ma a W kW w kw Hz hz V. A, W; mA! volts watt "
    "input Input output Out in mains supply AC DC ac dc usb USB USB-C USB-A1 usb c2 C1 A2 type-c "
    "charging port PD qc 3.0 wall car plug voltage Voltage: rated name 'voltage' value : = , "
    "- – — • . ; ! ? ( ) / the a of cable été naïve é ß Ω 😀 𝐀 NBSP TAB LF adapter wasser "
).split()
SPECIAL = {"NBSP": chr(0xA0), "TAB": "\t", "LF": "\n"}


def random_text(rng):
    parts = [SPECIAL.get(t, t) for t in rng.choices(TOKENS, k=rng.randint(1, 60))]
    return "".join(p + rng.choice(["", " ", " ", "  "]) for p in parts)


def as_pairs(specs):
    return [(s["context"], list(s["values"])) for s in specs or []]


def test_specs_equal_plain_python_on_random_texts(spark):
    rng = random.Random(7)
    texts = [random_text(rng) for _ in range(3000)]
    rows = sp.expand_specs(spark.createDataFrame(
        list(enumerate(texts)), "id int, text string")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        want = brute.specs(row.text)
        for quantity in sp.QUANTITIES:
            assert as_pairs(row[quantity]) == want[quantity], (quantity, row.text)


@pytest.mark.parametrize("text, volts, amps, watts", [
    ("500mA", [], [("unspecified", ["0.0 A"])], []),
    ("1230V x", [("unspecified", ["230 V"])], [], []),
    ("Voltage: 100-240V", [("unspecified", ["100 V", "240 V"])], [], []),
    ("100VAC-240VAC", [("input", ["100-240 VAC"])], [], []),
    ("100VAC", [("input", ["100 V"])], [], []),
    ("100 - 240V. Next", [("unspecified", ["240 V"])], [], []),
    ("USB-C 20 W", [], [], [("output:USB-C20", ["20 W"])]),
    ("1.5kW or 2kW", [], [], [("unspecified", ["1500.0 W", "2000.0 W"])]),
    ("", [], [], []),
])
def test_known_matches(spark, text, volts, amps, watts):
    row = sp.expand_specs(spark.createDataFrame([(text,)], "text string")).first()
    assert as_pairs(row.voltage_info) == volts
    assert as_pairs(row.amperage_info) == amps
    assert as_pairs(row.wattage_info) == watts
    assert (row.voltage_info is None) == (not volts)


def test_long_text_is_read_to_its_end(spark):
    text = "word " * 60_000 + "Input 230V"
    row = sp.expand_specs(spark.createDataFrame([(text,)], "text string")).first()
    assert as_pairs(row.voltage_info) == [("input", ["230 V"])]


def test_many_matches_in_one_chunk(spark):
    text = " ".join(f"{i % 90 + 1}V" for i in range(20_000))
    row = sp.expand_specs(spark.createDataFrame([(text,)], "text string")).first()
    assert len(row.voltage_info[0]["values"]) == 90


def test_merge_keeps_given_contexts_and_prefers_the_text(spark):
    given = [("input", ["1 V"]), ("rated", ["48 V"])]
    df = spark.createDataFrame(
        [("Input 230V. DC 5V", given), ("no", given), ("no", None), ("no", [])],
        f"text string, voltage_info {sp.SPEC_DDL}")
    merged = [as_pairs(r.voltage_info) for r in sp.expand_specs(df).collect()]
    assert merged[0] == [("input", ["230 V"]), ("rated", ["48 V"]), ("output", ["5 V"])]
    assert merged[1] == given
    assert merged[2:] == [[], []]
    with pytest.raises(KeyError):
        sp.expand_specs(df, "not_there")


def test_json_text_round_trip(spark):
    pairs = [("in \"x\" é", ["1 V", "2 V"]), ("output:USB-C1", ["5 V"])]
    df = spark.createDataFrame([(pairs,)], f"s {sp.SPEC_DDL}")
    row = df.select(sp.specs_json(F.col("s")).alias("j")).select(
        "j", sp.specs_from_json(F.col("j")).alias("s")).first()
    assert row.j == '{"in \\"x\\" é": ["1 V", "2 V"], "output:USB-C1": ["5 V"]}'
    assert as_pairs(row.s) == pairs


NUMBERS = ["0.21-1.34", "Voltage: 5.0V", "no numbers here", "240-100 V", "5", "-5 – -3", "1e3 W",
           "v1.2.3", "a/5", "5/6", "100 V - 240 V", "12 ⎓", "3.5", "230-250 V", "220-240 V",
           "13 A", "12.9", "5 A", "5.1 A", "99 V", "100 V", "50-99 V", "229", "251", ""]


def test_numbers_and_limits_equal_plain_python(spark):
    df = spark.createDataFrame([(n, e) for n in NUMBERS for e in (True, False)],
                               "t string, exact boolean").withColumn("n", parse_range("t"))
    rows = df.select("t", "exact", "n.*", voltage_ok("n", "exact").alias("v"),
                     limit_ok("n", 13.0, "exact").alias("l")).collect()
    for r in rows:
        assert (r["first"], r["second"]) == brute.number(r.t), r.t
        assert r.v == brute.volts_ok(r.t, r.exact), r
        assert r.l == brute.below_ok(r.t, 13.0, r.exact), r


def test_scores_equal_plain_python(spark):
    rng = random.Random(3)
    contexts = ["input", "output", "unspecified", "output:USB-C1", "Rated Current", "power"]
    data = []
    for i in range(2000):
        pairs = [(c, rng.choices(NUMBERS, k=rng.randint(0, 3)))
                 for c in rng.sample(contexts, rng.randint(0, 4))]
        data.append((i, pairs if rng.random() > 0.05 else None, rng.random() > 0.5))
    df = spark.createDataFrame(data, f"id int, s {sp.SPEC_DDL}, exact boolean")
    rows = {r.id: r for r in df.select(
        "id", scoring.voltage_score("s", "exact").alias("v"),
        scoring.amperage_score("s", "exact").alias("a"),
        scoring.wattage_score("s").alias("w")).collect()}
    words = scoring.SIDE_WORDS
    for i, pairs, exact in data:
        r = rows[i]
        if pairs is None:
            assert (r.v, r.a, r.w) == (None, None, None)
            continue
        assert r.v == brute.score(pairs, lambda x: brute.volts_ok(x, exact), words["voltage"],
                                  ("output",)), (pairs, exact)
        assert r.a == brute.score(pairs, lambda x: brute.below_ok(x, 13.0, exact),
                                  words["amperage"]), (pairs, exact)
        assert r.w == brute.score(pairs, lambda x: brute.below_ok(x, 3000.0, False),
                                  words["wattage"], reset=False, quantifier=all), pairs


def test_groups_without_a_rule_drop_out(spark):
    pairs = [("input", ["220-240 V"])]
    df = spark.createDataFrame(
        [("Group A", pairs), ("Group B", pairs), ("Group Z", pairs), (None, pairs)],
        f"product_group string, voltage_info {sp.SPEC_DDL}").withColumns(
        {"amperage_info": F.lit(None).cast(sp.SPEC_DDL),
         "wattage_info": F.lit(None).cast(sp.SPEC_DDL)})
    scores = {r.product_group: r.voltage_score for r in scoring.with_spec_scores(df).collect()}
    assert scores == {"Group A": 0.0, "Group B": 1.0}
