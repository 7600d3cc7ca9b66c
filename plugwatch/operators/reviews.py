"""Review scores: negativity from a lexicon, danger from vector similarity, sums per product."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plugwatch.functions.text import NO_SPACE, word_count
from plugwatch.operators.joins import join_unique
from plugwatch.session import spread, stored

# --- Fixed value: a word without the punctuation around it (U: Unicode classes) --------
WORD = rf"(?U)\w(?:{NO_SPACE}*\w)?"

# Words and their valence, negative to positive. A small default in the form of the
# published valence lexicons; pass a full one to ``negativity``.
DEFAULT_LEXICON: Mapping[str, float] = {
    "bad": -2.5, "broken": -2.1, "burn": -2.0, "burned": -2.1, "burnt": -2.1,
    "danger": -2.4, "dangerous": -2.5, "defect": -1.8, "defective": -2.0, "exploded": -2.4,
    "failed": -2.3, "fire": -1.4, "hazard": -2.0, "hurt": -2.4, "injured": -1.9,
    "poor": -2.1, "shock": -1.6, "smoke": -1.2, "terrible": -2.1, "unsafe": -1.9,
    "useless": -1.8, "worst": -3.1, "worthless": -1.9,
    "excellent": 2.7, "good": 1.9, "great": 3.1, "happy": 2.7, "love": 3.2, "nice": 1.8,
    "perfect": 2.7, "reliable": 2.0, "safe": 1.9,
}


def negativity(text: Column, lexicon: Mapping[str, float] = DEFAULT_LEXICON) -> Column:
    """Negative share of a text in [0, 1], rounded to 3 decimals; blank text has 0.

    Each word adds its valence, moved one away from zero, to the negative or positive side;
    the other words add 1 to the neutral side. The share is negative / (all three).

    The words of equal valence form one set, so each word is looked up by hash and the text
    never leaves its row.
    """
    words_by_weight: dict[float, list[str]] = defaultdict(list)
    for word, valence in lexicon.items():
        if valence:
            words_by_weight[valence + math.copysign(1.0, valence)].append(word.lower())

    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)

    def weight(word: Column) -> Column:
        value = F.lit(0.0)
        for amount, members in sorted(words_by_weight.items()):
            value = F.when(word.isin(members), amount).otherwise(value)
        return value

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)

    def share(counts: Column) -> Column:
        negative = total(F.filter(counts["weights"], lambda x: x < 0))
        rated = total(F.transform(counts["weights"], F.abs))
        neutral = counts["words"] - F.size(counts["weights"])
        return F.try_divide(-negative, rated + neutral)

    # One look-up per word finds the few rated ones; only those are weighed. The one-element
    # arrays bind a value that is used more than once.
    known = [w for members in words_by_weight.values() for w in members]
    shares = F.transform(
        F.transform(F.array(words), lambda ws: F.struct(
            F.size(ws).alias("words"),
            F.transform(F.filter(ws, lambda w: w.isin(known)), weight).alias("weights"))),
        share)
    return F.coalesce(F.round(shares[0], 3), F.lit(0.0))


def _similarities(vectors, keywords):
    """Cosine of every vector with every keyword; 0 where a vector is null or zero."""
    import numpy as np
    import pyarrow as pa

    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
    out = np.zeros((len(vectors), len(keywords)))
    present = vectors.is_valid().to_numpy(zero_copy_only=False)
    rows = flat.reshape(int(present.sum()), -1) if present.any() else flat.reshape(0, 0)
    if len(rows):
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        out[present] = np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0) @ keywords.T
    return out, pa


def _unit_rows(vectors: Iterable[Sequence[float]]):
    import numpy as np

    rows = np.asarray([list(v) for v in vectors], dtype="float64")
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def max_similarity(vector: Column, keywords: Iterable[Sequence[float]]) -> Column:
    """Largest cosine of a vector column with the keyword vectors.

    One matrix product per Arrow batch; texts and keywords are never paired up as rows.
    """
    unit = _unit_rows(keywords)

    @F.arrow_udf(T.DoubleType())
    def largest(vectors):
        sims, pa = _similarities(vectors, unit)
        return pa.array(sims.max(axis=1))

    return largest(vector)


def mean_similarity(vector: Column, keywords: Iterable[Sequence[float]],
                    weights: Sequence[float] | None = None) -> Column:
    """Mean cosine with the keyword vectors, weighted if ``weights`` are given."""
    import numpy as np

    unit = _unit_rows(keywords)
    shares = np.full(len(unit), 1.0) if weights is None else np.asarray(weights, dtype="float64")
    shares = shares / shares.sum()

    @F.arrow_udf(T.DoubleType())
    def mean(vectors):
        sims, pa = _similarities(vectors, unit)
        return pa.array(sims @ shares)

    return mean(vector)


def danger(vector: Column, text: Column, keywords: Iterable[Sequence[float]]) -> Column:
    """Largest keyword similarity divided by the number of words."""
    return max_similarity(vector, keywords) / word_count(text)


def text_similarity(vector: Column, text: Column, keywords: Iterable[Sequence[float]],
                    weights: Sequence[float] | None = None, by_length: bool = True) -> Column:
    """(Weighted) mean similarity by ln(1 + words), kept in [0, 1]; 0 for an empty text."""
    score = mean_similarity(vector, keywords, weights)
    if by_length:
        score = score / F.log1p(word_count(text))
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))
    return F.when(F.coalesce(text, F.lit("")) == "", 0.0).otherwise(clipped)


def keyword_vectors(df: DataFrame, vector_col: str, order_col: str, limit: int = 1024) -> list:
    """Keyword vectors of a small table, in order. More than ``limit`` of them is an error:
    they are a word list, not data."""
    rows = df.select(vector_col).orderBy(order_col).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} keyword vectors")
    return [r[0] for r in rows]


def _product(vector: Column, direction: Sequence[float]) -> Column:
    """Product of each unit vector with ``direction``, which is taken as it is."""
    import numpy as np

    one = np.asarray([direction], dtype="float64")

    @F.arrow_udf(T.DoubleType())
    def product(vectors):
        sims, pa = _similarities(vectors, one)
        return pa.array(sims[:, 0])

    return product(vector)


# Keyword vectors, and vectors of texts, that are compared by one matrix product, and the largest cosines
# that a task holds before it passes them on.
KEYWORD_BLOCK, VECTOR_BLOCK, HELD = 4096, 2048, 1 << 20
# Keyword blocks up to so many, and so many bytes in all, go to every task; more are dealt out in pairs.
FEW_BLOCKS, FEW_BYTES = 64, 8 << 20


def _mean_direction(keywords: DataFrame) -> list[float | None]:
    """Weighted mean of the unit vectors of (vector, weight), added up by Spark: one number for each
    dimension."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    unit = keywords.withColumn("norm", norm).select("weight", F.posexplode(F.transform(
        "vector", lambda x: F.coalesce(F.try_divide(x, F.col("norm")), F.lit(0.0)))))
    rows = unit.groupBy("pos").agg(F.try_divide(
        F.sum(F.col("col") * F.col("weight")), F.sum("weight")).alias("mean"))
    return [r["mean"] for r in rows.orderBy("pos").collect()]


_PACK_DDL = "rows binary, data binary, dims int"


def _paired(packs: DataFrame, some: DataFrame) -> DataFrame:
    """Each block of rows with each block of keywords. Few keywords are joined by the number of their
    block, so the rows are read once and not shuffled."""
    n, held = some.agg(F.count("*"), F.sum(F.octet_length("data").cast("long"))).first()
    words = some.select("block", F.col("data").alias("words"))
    if n > FEW_BLOCKS or held > FEW_BYTES:
        return packs.crossJoin(words)
    blocks = [F.lit(r["block"]) for r in some.select("block").collect()]
    return packs.withColumn("block", F.explode(F.array(*blocks))).join(F.broadcast(words), "block")


def _packed(block: int):
    """Unit vectors of (vector) or (vector, row) as matrices of at most ``block`` rows."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, block):
                vectors = batch.column(0).slice(at, block)
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
                matrix = flat.reshape(len(vectors), -1)
                norms = np.linalg.norm(matrix, axis=1, keepdims=True)
                unit = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
                ids = batch.column(1).slice(at, block).to_numpy().tobytes() if batch.num_columns > 1 else b""
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids], pa.binary()), pa.array([unit.tobytes()], pa.binary()),
                     pa.array([unit.shape[1]], pa.int32())], ["rows", "data", "dims"])

    return run


def _largest(batches):
    """The largest cosine of each row with the keywords it is paired with here."""
    import numpy as np
    import pyarrow as pa

    held = {}

    def told():
        rows = np.frombuffer(b"".join(held), "int64")
        return pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(np.concatenate(list(held.values())))], ["_row", "_largest"])

    for batch in batches:
        for ids, data, words, dims in zip(*(batch.column(i) for i in range(4))):
            ids, dims = ids.as_py(), dims.as_py()
            matrix, keywords = (np.frombuffer(x.as_buffer(), "float64") for x in (data, words))
            best = (matrix.reshape(-1, dims) @ keywords.reshape(-1, dims).T).max(axis=1) if dims else np.zeros(
                len(ids) // 8)
            held[ids] = np.maximum(held[ids], best) if ids in held else best
            if len(held) * VECTOR_BLOCK > HELD:
                yield told()
                held.clear()
    if held:
        yield told()


def _order(df: DataFrame) -> list[str]:
    """The columns of ``df`` as they lie, and the similarities that it doesn't have."""
    new = ["max_similarity", "mean_similarity"]
    return [f"`{c}`" for c in [*df.columns, *(c for c in new if c not in df.columns)]]


def with_similarities(df: DataFrame, keywords: DataFrame, vector_col: str = "embedding",
                      keyword_col: str = "embedding", weight_col: str | None = None,
                      block: int = KEYWORD_BLOCK) -> DataFrame:
    """Add ``max_similarity`` and ``mean_similarity``, the largest and the (weighted) mean cosine
    with a table of keyword vectors of any length.

    The mean takes one product with the mean direction, which Spark adds up. For the maximum the
    distinct keywords are packed into blocks of at most ``block`` vectors and the rows into blocks of
    ``VECTOR_BLOCK``; Spark deals out the pairs of blocks, and a task holds few of them. ``df`` is
    written to the shared folder once, whatever the number of keywords.

    Columns of these two names are replaced. A null or zero vector has the cosine 0 with all keywords. Null keywords are left out; without
    any keyword, or with weights that add up to 0 for the mean, the value is null.
    """
    weight = F.lit(1.0) if weight_col is None else F.col(f"`{weight_col}`").cast("double")
    words = stored(keywords.select(
        F.col(f"`{keyword_col}`").cast("array<double>").alias("vector"), weight.alias("weight"),
    ).where("vector IS NOT NULL"))
    mean = _mean_direction(words)
    some = stored(words.select("vector").distinct().mapInArrow(_packed(block), _PACK_DDL).withColumn(
        "block", F.monotonically_increasing_id()))
    vector, none = F.col(f"`{vector_col}`"), F.lit(None).cast("double")
    rows = stored(df.withColumns({
        "mean_similarity": none if not mean or None in mean else _product(vector, mean),
        "_row": F.monotonically_increasing_id()}))
    if not some.take(1):
        return rows.drop("_row").withColumn("max_similarity", none).select(_order(df))
    packs = stored(rows.where(vector.isNotNull()).select(vector.alias("vector"), "_row").mapInArrow(
        _packed(VECTOR_BLOCK), _PACK_DDL))
    largest = _paired(spread(packs), some).select(
        "rows", "data", "words", "dims").mapInArrow(_largest, "_row long, _largest double").groupBy(
        "_row").agg(F.max("_largest").alias("_largest"))
    return join_unique(rows, largest, ["_row"]).withColumn(
        "max_similarity", F.coalesce("_largest", F.lit(0.0))).select(_order(df))


def embed(texts: Column, make_encoder: Callable[[], Callable], batch_size: int = 32) -> Column:
    """Vectors of a text column by a caller's model, loaded once per Python worker.

    ``make_encoder()`` returns a function from a string array to a two-dimensional array.
    """
    from pyspark.ml.functions import predict_batch_udf

    model = predict_batch_udf(
        make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return model(F.coalesce(texts, F.lit("")))


def with_vectors(df: DataFrame, make_encoder: Callable[[], Callable], text_col: str = "content",
                 vector_col: str = "vector", batch_size: int = 32) -> DataFrame:
    """Add the vector of each text by a caller's model, which sees every distinct text once.

    The vectors of the distinct texts are written to the shared folder, so that lost executors don't
    call the model again for what is done. They come back by a join on the digest of the text, in which a
    hot text is split. A null text counts as empty; a column named ``vector_col`` is replaced.
    """
    text, digest = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), "_text_digest"
    texts = df.select(text.alias("text")).distinct()
    vectors = stored(texts.select(
        F.sha2("text", 256).alias(digest),
        embed(F.col("text"), make_encoder, batch_size).alias(vector_col)))
    keyed = df.drop(vector_col).withColumn(digest, F.sha2(text, 256))
    return join_unique(keyed, vectors, [digest]).drop(digest)


def with_feedback_scores(
    df: DataFrame,
    negativity_of: Callable[[Column], Column] = negativity,
    danger_of: Callable[[Column], Column] | None = None,
    feedback_col: str = "content",
) -> DataFrame:
    """Add ``review_text``, ``negativity_score`` and ``danger_score``.

    Without the feedback column the text is empty and both scores are 0. ``danger_of`` maps
    the text column to the danger score, for example by :func:`embed` and :func:`danger`; where there
    is text it must be given.
    """
    if feedback_col not in df.columns:
        return df.withColumns({"review_text": F.lit(""), "negativity_score": F.lit(0.0),
                               "danger_score": F.lit(0.0)})
    if danger_of is None:
        raise ValueError("danger is a feature of the model: give danger_of")
    out = df.withColumn("review_text", F.coalesce(F.col(feedback_col).cast("string"), F.lit("")))
    text = F.col("review_text")
    return out.withColumns({
        "negativity_score": negativity_of(text),
        "danger_score": danger_of(text),
    })


def review_scores(df: DataFrame, keys: Sequence[str] = ("product_id", "marketplace"),
                  keep_null_keys: bool = True) -> DataFrame:
    """Sums of both scores and the number of texts per key.

    Partial sums are made before the shuffle, so a product with many reviews is no hot spot.
    """
    if not keep_null_keys:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum("negativity_score"), F.lit(0.0)).alias("negativity_score"),
        F.coalesce(F.sum("danger_score"), F.lit(0.0)).alias("danger_score"),
        F.count("review_text").alias("review_count"),
    )
