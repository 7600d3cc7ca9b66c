"""The operators as registered queries, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plugwatch.llm import alignment, chat, decontaminate, exact_dedup, language, mixing, resampling
from plugwatch.llm import secrets, simhash, substring, suffixes, toxicity, warc
from plugwatch.session import stored

Query = Callable[[SparkSession, str], DataFrame]

MIX_POWER, MIX_SEED = 0.5, 20240501
WARC_DATE = "2024-01-01T00:00:00Z"
TOKENIZERS = ("/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    held_out = language.held_out("doc_id", 4, 2)
    model = language.train(docs.filter(~held_out))
    told = language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return told.select("doc_id", "held_out", "lang_pred", "score")


def mixture(docs: DataFrame) -> DataFrame:
    """Sources by the square root of their sizes, as large as the input."""
    sizes = stored(mixing.source_sizes(docs))
    rates = mixing.rates(sizes, mixing.tempered_weights(sizes, MIX_POWER))
    return mixing.mix(docs, rates, MIX_SEED)


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_read(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(_read(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secrets.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: ~s["weak"])
    count = lambda kind: F.size(F.filter(
        "spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    done = chat.format_chat(chat.records(rows.union(more)))
    back = chat.read_back(F.col("formatted"))
    loss = chat.masked(F.col("formatted"), F.col("loss_spans"))
    text = F.array_join(F.transform("back", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select("conv_id", "formatted", back.alias("back"), loss.alias("loss")).select(
        "conv_id", F.size("back").cast("long").alias("n_turns"),
        F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def toxicity_model(docs: DataFrame, spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learned from the labels of two thirds of the documents."""
    learn = ~language.held_out("doc_id", 3, 1)
    return toxicity.train(docs.filter(learn), _read(spark, sf_dir, "labels").filter(learn))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    rows = docs.select("doc_id", language.held_out("doc_id", 3, 1).alias("held_out"), "text")
    told = toxicity.score(rows, toxicity_model(docs, spark, sf_dir))
    return told.select("doc_id", "held_out", "score", "predicted", "spans")


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group(_read(spark, sf_dir, "documents"))


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(_read(spark, sf_dir, "pages"), WARC_DATE))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.remove_repeats(_read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampling.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op12_token_alignment(spark: SparkSession, sf_dir: str,
                         tokenizers: tuple[str, str] = TOKENIZERS) -> DataFrame:
    files = alignment.vocabularies(*tokenizers)
    return alignment.align(_read(spark, sf_dir, "documents"), files)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.remove_repeats(_read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_language_id, op2_source_mixing, op3_decontamination, op4_exact_dedup, op5_secret_scan,
    op6_chat_format, op7_toxicity, op8_simhash_dedup, op9_warc_derivatives, op10_substring_dedup,
    op11_importance_resampling, op12_token_alignment, op13_suffix_dedup)}

_MIX = f"""
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0) + 1) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, pow(size, {MIX_POWER}) / (SELECT sum(pow(size, {MIX_POWER})) FROM sizes)
    * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
upto AS (
  SELECT source, sum(exp(k * ln(rate) - rate - lgamma(k + 1)))
    OVER (PARTITION BY source ORDER BY k) AS cdf FROM rates, range(0, 400) t(k)),
points AS (
  SELECT *, (('0x' || substr(md5('{MIX_SEED}:' || doc_id || ':1'), 1, 12))::BIGINT + 0.5)
    / 281474976710656.0 AS u FROM documents),
drawn AS (
  SELECT p.doc_id, count(*) FILTER (cdf < u) AS n
  FROM points p JOIN upto ON p.source IS NOT DISTINCT FROM upto.source GROUP BY p.doc_id)
SELECT d.*, copy::INTEGER AS copy, md5('order {MIX_SEED}:' || d.doc_id || ':' || copy) AS shuffle_key
FROM documents d JOIN drawn USING (doc_id), unnest(range(1, n + 1)) t(copy)
"""

_EXACT = """
WITH rows AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM rows WINDOW same AS (PARTITION BY text_sha256)
"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _secrets_sql() -> str:
    found = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS rank, string_split_regex(t, {_quoted(p.pattern)}) AS gaps,"
        f" regexp_extract_all(t, {_quoted(p.pattern)}, 0) AS hits FROM d"
        for i, p in enumerate(secrets.PARTS))
    passes = " ".join(
        f"WHEN {i} THEN length(regexp_extract(hit, {_quoted(p.pattern)}, {p.group})) >= {p.least}"
        + "".join(f" AND regexp_matches(hit, {_quoted(n)})" for n in p.needs)
        for i, p in enumerate(secrets.PARTS))
    of = lambda name: " ".join(
        f"WHEN {i} THEN {_quoted(getattr(p, name))}" for i, p in enumerate(secrets.PARTS))
    weak = ", ".join(str(i) for i, p in enumerate(secrets.PARTS) if p.weak)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
flat AS (
  SELECT doc_id, rank, generate_subscripts(hits, 1) AS pos, unnest(hits) AS hit,
    unnest(gaps[1:len(hits)]) AS gap FROM found WHERE len(hits) > 0),
placed AS (
  SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY pos) AS stop
  FROM flat),
parts AS (
  SELECT doc_id, rank, stop - length(hit) AS start, stop, CASE rank {of('kind')} END AS kind,
    CASE rank {of('role')} END AS role, rank IN ({weak}) AS weak
  FROM placed WHERE CASE rank {passes} END),
linked AS (
  SELECT *, EXISTS (
    SELECT 1 FROM parts o WHERE o.doc_id = p.doc_id AND o.role != p.role
      AND greatest(o.start - p.stop, p.start - o.stop) <= {secrets.SCOPE}) AS near
  FROM parts p),
told AS (
  SELECT * FROM linked l WHERE NOT weak OR near AND NOT EXISTS (
    SELECT 1 FROM parts s WHERE s.doc_id = l.doc_id AND NOT s.weak
      AND s.start < l.stop AND s.stop > l.start)),
joined AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
    count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)
      FILTER (NOT weak) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM told GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (doc_id)
"""


_CHAT = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, {len(chat.START + chat.SEP + chat.END)}
    + length(regexp_replace(role, {_quoted(chat.ESCAPED)}, '\\1\\\\\\2\\3', 'g'))
    + length(regexp_replace(text, {_quoted(chat.ESCAPED)}, '\\1\\\\\\2\\3', 'g')) AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_SUBSTRING = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')
    AS words FROM documents),
windows AS (
  SELECT doc_id, start, array_to_string(words[start:start + {substring.WINDOW - 1}], ' ') AS said
  FROM words, unnest(range(1, len(words) - {substring.WINDOW - 2})) t(start)),
later AS (
  SELECT doc_id, start FROM windows
  QUALIFY row_number() OVER (PARTITION BY said ORDER BY doc_id, start) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, start + {substring.WINDOW})) AS pos FROM later),
flat AS (
  SELECT doc_id, generate_subscripts(words, 1) AS pos, unnest(words) AS word FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS said
  FROM flat ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(said, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

# CRC-32 by bytes, from the table of the reversed polynomial.
_RESAMPLE = f"""
WITH RECURSIVE steps AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(0, 256) t(i)
  UNION ALL SELECT byte, xor(c >> 1, 3988292384 * (c & 1)), k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY byte) AS tab FROM steps WHERE k = 8),
texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
hexed AS (SELECT word, hex(encode(word)) AS h FROM words GROUP BY word),
hashed AS (
  SELECT word, xor(4294967295::BIGINT, list_reduce(
    [4294967295::BIGINT] || list_transform(range(1, length(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % {resampling.BUCKETS} AS bucket
  FROM hexed, crc),
counted AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t
  FROM words JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT sum(s)::BIGINT AS all_s, sum(t)::BIGINT AS all_t FROM counted),
worth AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (all_s + {resampling.BUCKETS}))::DOUBLE
    / ((s + 1) * (all_t + {resampling.BUCKETS}))::DOUBLE))::BIGINT AS gain FROM counted, totals),
weights AS (
  SELECT id AS doc_id, count(*) AS n_features, sum(gain)::BIGINT AS total
  FROM words JOIN hashed USING (word) JOIN worth USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features,
    coalesce((total - (total % n_features + n_features) % n_features) // n_features, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('{resampling.SEED}:' || doc_id), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN weights USING (doc_id)),
told AS (
  SELECT doc_id, n_features, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM scored),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank
  FROM told WHERE n_features >= {resampling.LEAST_WORDS}
  QUALIFY rank <= {resampling.PERCENT} * count(*) OVER () // 100)
SELECT told.*, rank FROM told LEFT JOIN drawn USING (doc_id)
"""

_SUFFIXES = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
runs AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * suffixes.LENGTH})) AS said
  FROM d, unnest(range(0, greatest(length(h) // 2 - {suffixes.LENGTH - 1}, 0))) t(i)),
again AS (SELECT doc_id, i FROM runs QUALIFY count(*) OVER (PARTITION BY said) > 1),
cut AS (
  SELECT *, coalesce(i > lag(i) OVER w + {suffixes.LENGTH}, true)::INT AS new
  FROM again WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM cut),
spans AS (
  SELECT doc_id, min(i) AS a, max(i) + {suffixes.LENGTH} AS b FROM numbered GROUP BY doc_id, span),
edges AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM spans),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed,
    string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1)
      AS said
  FROM edges JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(said, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op2_source_mixing": _MIX, "op4_exact_dedup": _EXACT, "op5_secret_scan": _secrets_sql(),
    "op6_chat_format": _CHAT, "op10_substring_dedup": _SUBSTRING,
    "op11_importance_resampling": _RESAMPLE, "op13_suffix_dedup": _SUFFIXES,
}
