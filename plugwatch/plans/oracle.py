"""Plain SQL with which the checking engine computes the registered queries on its own.

The regular expressions here are written for an engine without look-around, with ASCII
classes. Texts with accented letters therefore enter with those letters replaced by ``z``.
"""

from __future__ import annotations

import re

from plugwatch.plans import views as v
from plugwatch.settings import GROUP_RULES

_NUM = r"\d{1,%d}(?:\.\d+)?"
_RANGE = r"\s*(?:[\-–—]|/)\s*"
_VU = "(?:v|vac|vdc|⎓)"
_Q = r"[\x27\x22]"
VOLTS = (
    rf"(?i)(?:\b(?:ac|dc)\b[^\w]{{0,3}})?(?:{_NUM % 3}\s*{_VU}?{_RANGE}{_NUM % 3}\s*{_VU}?"
    rf"|{_NUM % 3}\s*{_VU}|(?:rated\s+)?voltage\s*[:\-]?\s*{_NUM % 4}\s*{_VU}?"
    rf"|{_Q}?name{_Q}?\s*[:=]\s*{_Q}?voltage{_Q}?\s*,\s*{_Q}?value{_Q}?\s*[:=]\s*{_Q}?"
    rf"{_NUM % 4}\s*{_VU}?{_Q}?)"
)
AMPS = rf"(?i){_NUM % 2}(?:{_RANGE}{_NUM % 2})?\s*(?:ma|a)\b"
WATTS = rf"(?i){_NUM % 4}(?:{_RANGE}{_NUM % 4})?\s*(?:kw|w)\b"
INPUT = (r"(?i)\b(?:input|in|ac\s*in|dc\s*in|mains|supply|source|wall|cigarette\s*lighter"
         r"|vehicle|car|truck|plug\s*in)\b")
OUTPUT = (r"(?i)\b(?:output|out|port|charging|charge|usb[-\s]?(?:c\d?|a\d?)|type[-\s]?c\d?"
          r"|type[-\s]?a\d?|pd\s*\d+(?:\.\d+)?|pps|qc\s*\d(?:\.\d)?)\b")
AC = r"(?i)\b(?:ac|vac|50/60\s*hz|hz)\b"
DC = r"(?i)\b(?:dc|usb|⎓)\b"
HERTZ = rf"(?i)\d{{2,3}}(?:{_RANGE}\d{{2,3}})?\s*hz\b"
PORT = r"(?i)\b(?:usb[-\s]?[ca]\s*(?:\d+)?)\b|\b[ca]\d\b"
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
UNIT = r"(?:\s*[a-zA-Zµμ°Ω%]+)?"
PARSE = rf"(?:^|[^\w./])({NUMBER}){UNIT}(?:\s*[-–—]\s*({NUMBER}){UNIT})?(?:$|[^\w./])"
WATERPROOF = (
    r"(?i)\bwater\s*proof(?:ed)?\b|\bwater\s*resistant\b|\bsplash\s*proof\b"
    r"|\bsplash\s*resistant\b|\bsealed\s*(?:against)?\s*water\b"
    r"|\bmoisture\s*(?:sealed|resistant)\b|\bweather\s*(?:proof|resistant)\b"
)


def base_sql(win: str, port: str) -> str:
    side = (f"(CASE WHEN regexp_matches({win}, '{INPUT}') THEN 3.0 ELSE 0 END"
            f" + CASE WHEN regexp_matches({win}, '{AC}') THEN 1.5 ELSE 0 END"
            f" - CASE WHEN regexp_matches({win}, '{OUTPUT}') THEN 3.0 ELSE 0 END"
            f" - CASE WHEN regexp_matches({win}, '{DC}') THEN 1.0 ELSE 0 END)")
    return (f"CASE WHEN {side} > 0 THEN 'input' WHEN {side} < 0 OR {port} IS NOT NULL THEN"
            f" 'output' WHEN regexp_matches({win}, '{HERTZ}') OR contains(upper({win}), 'VAC')"
            " THEN 'input' ELSE 'unspecified' END")


def port_sql(chunk: str) -> str:
    return (f"nullif(regexp_replace(upper(regexp_extract({chunk}, '{PORT}', 0)),"
            r" '^(?:USB[-\s]?)?([CA])\s*(\d*)$', 'USB-\1\2'), '')")


def plain_letters(text: str) -> str:
    return f"regexp_replace({text}, '[À-ÿ]', 'z', 'g')"


def words(text: str) -> str:
    return rf"greatest(1, len(regexp_extract_all({text}, '\S+')))"


def chunk_ctes(source: str) -> dict[str, str]:
    """``chunks(key, chunk_no, chunk)`` of ``source``, a query giving ``key, text``."""
    broken = (r"regexp_replace(regexp_replace(text, '([.!?;])\s+', '\1' || chr(1), 'g'),"
              r" '\s*[•\-–—]\s+', chr(1), 'g')")
    return {
        "raw_chunks": (
            "SELECT key, unnest(parts) AS raw, generate_subscripts(parts, 1) AS raw_no FROM"
            f" (SELECT key, string_split({broken}, chr(1)) AS parts FROM ({source}))"),
        "chunks": (
            "SELECT key, row_number() OVER (PARTITION BY key ORDER BY raw_no) AS chunk_no, chunk"
            r" FROM (SELECT key, raw_no, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS chunk"
            " FROM raw_chunks) WHERE chunk != ''"),
    }


def spec_ctes(source: str) -> dict[str, str]:
    """``matches(key, kind, match_no, context, value)`` and ``specs(key, kind, context_no,
    context, value_no, value)`` of ``source``, a query giving ``key, text``."""
    pieces = " UNION ALL ".join(
        f"SELECT key, chunk_no, chunk, port, '{kind}' AS kind,"
        f" string_split(regexp_replace(chunk, '{pattern}', chr(2) || '\\0' || chr(2), 'g'),"
        " chr(2)) AS parts FROM ported"
        for kind, pattern in (("V", VOLTS), ("A", AMPS), ("W", WATTS)))
    volt_range = rf"(?i)^({_NUM % 3})\s*({_VU})?{_RANGE}({_NUM % 3})\s*({_VU})?$"
    volt_single = rf"(?i)({_NUM % 4})\s*({_VU})?{_Q}?$"
    small = rf"(?i)^(\d+(?:\.\d+)?)(?:{_RANGE}(\d+(?:\.\d+)?))?\s*(ma|a|kw|w)$"

    def scaled(x: str) -> str:
        return (f"CASE lower(p.u) WHEN 'ma' THEN CAST(round(try_cast({x} AS DOUBLE) / 1000, 4)"
                f" AS VARCHAR) WHEN 'kw' THEN CAST(round(try_cast({x} AS DOUBLE) * 1000, 3)"
                f" AS VARCHAR) ELSE {x} END")

    value = (
        r"CASE WHEN kind != 'V' THEN " + scaled("p.a")
        + " || CASE WHEN p.b = '' THEN '' ELSE '-' || " + scaled("p.b") + " END || ' ' || kind"
        f" WHEN regexp_matches(bare, '{volt_range}') THEN r.a || '-' || r.b || ' '"
        " || upper(coalesce(nullif(r.u1, ''), nullif(r.u2, ''), 'V'))"
        " ELSE s.a || ' ' || upper(coalesce(nullif(s.u, ''), 'V')) END"
    )
    return {
        **chunk_ctes(source),
        "ported": f"SELECT *, {port_sql('chunk')} AS port FROM chunks",
        "found": pieces,
        "pieces": ("SELECT key, chunk_no, chunk, port, kind, unnest(parts) AS piece,"
                   " generate_subscripts(parts, 1) AS piece_no FROM found WHERE len(parts) > 1"),
        "placed": ("SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY key, chunk_no, kind"
                   " ORDER BY piece_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
                   " AS start FROM pieces"),
        "windows": (
            "SELECT *, substring(chunk, CAST(greatest(1, start - 39) AS INT),"
            " CAST(least(start, 40) + length(piece) + 40 AS INT)) AS win,"
            r" regexp_replace(piece, '(?i)^(?:ac|dc)\b[^\w]{0,3}', '') AS bare"
            # Matches stand at the even places between the texts around them.
            " FROM placed WHERE piece_no % 2 = 0"),
        "parsed": (
            f"SELECT *, regexp_extract(piece, '{small}', ['a', 'b', 'u']) AS p,"
            f" regexp_extract(bare, '{volt_range}', ['a', 'u1', 'b', 'u2']) AS r,"
            f" regexp_extract(bare, '{volt_single}', ['a', 'u']) AS s FROM windows"),
        "matches": (
            "SELECT key, kind, row_number() OVER (PARTITION BY key, kind ORDER BY chunk_no,"
            f" piece_no) AS match_no, concat_ws(':', {base_sql('win', 'port')}, port) AS context,"
            f" {value} AS value FROM parsed"),
        "firsts": ("SELECT key, kind, context, value, min(match_no) AS first_at FROM matches"
                   " GROUP BY ALL"),
        "spec_heads": ("SELECT *, min(first_at) OVER (PARTITION BY key, kind, context) AS head,"
                       " row_number() OVER (PARTITION BY key, kind, context ORDER BY first_at)"
                       " AS value_no FROM firsts"),
        "specs": ("SELECT key, kind, dense_rank() OVER (PARTITION BY key, kind ORDER BY head)"
                  " AS context_no, context, value_no, value FROM spec_heads"),
    }


_EXACT_VOLTS = ", ".join(f"'{r.product_group}'" for r in GROUP_RULES if r.exact_voltage)
_EXACT_AMPS = ", ".join(f"'{r.product_group}'" for r in GROUP_RULES if r.exact_amperage)
_HIGH_VOLTS = ", ".join(f"'{r.product_group}'" for r in GROUP_RULES if r.high_volts_only)
_GROUPS = ", ".join(f"'{r.product_group}'" for r in GROUP_RULES)
_CATEGORIES = " OR ".join(
    "(product_group = '{}' AND category IN ({}))".format(
        r.product_group, ", ".join(f"'{c}'" for c in r.irrelevant_categories))
    for r in GROUP_RULES)
_VALUE_OK = (
    "CASE WHEN a IS NULL THEN true"
    " WHEN kind = 'V' AND b IS NOT NULL THEN greatest(a, b) < 100 OR CASE WHEN exact_v THEN"
    " least(a, b) <= 230 AND greatest(a, b) >= 230 ELSE least(a, b) >= 230 AND"
    " greatest(a, b) <= 250 END"
    " WHEN kind = 'V' THEN a < 100 OR CASE WHEN exact_v THEN a = 230 ELSE a BETWEEN 230 AND 250"
    " END"
    " WHEN kind = 'A' AND b IS NOT NULL THEN exact_a OR greatest(a, b) <= 13"
    " WHEN kind = 'A' THEN CASE WHEN exact_a THEN a = 13 OR a <= 5 ELSE a <= 13 END"
    " ELSE coalesce(greatest(a, b), a) <= 3000 END"
)
_CLEAR = (
    "CASE kind WHEN 'V' THEN contains(context, 'input') WHEN 'A' THEN contains(context, 'input')"
    " OR contains(context, 'output') OR contains(context, 'amperage') OR contains(context,"
    " 'current') ELSE contains(context, 'input') OR contains(context, 'output') OR"
    " contains(context, 'wattage') OR contains(context, 'power') END"
)


def _weights(word: str) -> str:
    cases = " ".join(
        f"WHEN '{w}' THEN {val + (1 if val > 0 else -1)}" for w, val in v.LEXICON.items())
    return f"CASE {word} {cases} ELSE 0.0 END"


def _quoted(items) -> str:
    return ", ".join(f"'{i}'" for i in items)


def _logit() -> str:
    return " + ".join([str(v.INTERCEPT)] + [
        f"CAST({f} AS DOUBLE) * {w}" for f, w in v.WEIGHTS.items()])


AUS, UK = "socket_aus", "socket_uk"

CTES: dict[str, str] = {
    "products": v.select_sql(v.PRODUCTS, "part"),
    "pairs": v.select_sql(v.PAIRS, f"part WHERE {v.PAIRS_WHERE}"),
    "reviews": v.select_sql(v.REVIEWS, "documents"),
    "image_tags": v.select_sql(v.IMAGE_TAGS, "events"),
    "spot_checks": v.select_sql(v.SPOT_CHECKS, "labels"),
    **spec_ctes("SELECT product_id AS key, text FROM products"),
    "spec_values": (
        "SELECT s.*, try_cast(nullif(regexp_extract(value, '" + PARSE + "', 1), '') AS DOUBLE)"
        " AS a, try_cast(nullif(regexp_extract(value, '" + PARSE + "', 2), '') AS DOUBLE) AS b,"
        f" product_group, product_group IN ({_EXACT_VOLTS}) AS exact_v,"
        f" product_group IN ({_EXACT_AMPS}) AS exact_a"
        " FROM specs s JOIN products ON key = product_id"),
    "value_checks": f"SELECT *, {_VALUE_OK} AS ok FROM spec_values",
    "context_checks": (
        "SELECT key, kind, context_no, context, CASE WHEN kind = 'W' THEN bool_and(ok)"
        f" ELSE bool_or(ok) END AS ok, {_CLEAR} AS clear FROM value_checks"
        " GROUP BY key, kind, context_no, context"),
    "counted": ("SELECT *, min(CASE WHEN ok THEN context_no END) OVER (PARTITION BY key, kind)"
                " AS first_ok, CASE WHEN ok THEN 0.0 WHEN clear THEN 1.0 ELSE 0.5 END AS penalty"
                " FROM context_checks WHERE NOT (kind = 'V' AND contains(context, 'output'))"),
    "kind_scores": (
        "SELECT key, kind, sum(CASE WHEN kind != 'W' AND first_ok IS NOT NULL THEN 0.0"
        " WHEN first_ok IS NOT NULL AND context_no > first_ok THEN 0.0 ELSE penalty END)"
        " AS score FROM counted GROUP BY key, kind"),
    "spec_scores": (
        "SELECT key AS product_id,"
        " max(CASE WHEN s.kind = 'V' THEN coalesce(score, 0.0) END) AS voltage_score,"
        " max(CASE WHEN s.kind = 'A' THEN coalesce(score, 0.0) END) AS amperage_score,"
        " max(CASE WHEN s.kind = 'W' THEN coalesce(score, 0.0) END) AS wattage_score"
        " FROM (SELECT DISTINCT key, kind FROM specs) s LEFT JOIN kind_scores USING (key, kind)"
        " GROUP BY key"),
    "all_flagged": (
        "SELECT products.*, voltage_score, amperage_score, wattage_score,"
        " contains(text, 'adapter') AS adapter_flag,"
        " regexp_matches(text, 'industrial|commercial') AS industrial_flag,"
        f" regexp_matches(text, '{WATERPROOF}') AS waterproof_flag,"
        f" ({_CATEGORIES}) OR (regexp_matches(text, 'filter|bag|backpacks|case')"
        " AND spec_scores.product_id IS NULL)"
        f" OR (product_group IN ({_HIGH_VOLTS}) AND contains(text, 'usb'))"
        " OR (product_id, product_group) IN (SELECT product_id, product_group FROM pairs)"
        " AS is_irrelevant,"
        f" regexp_matches(text, '{'|'.join(re.escape(m) for m in v.RECALLS.models)}')"
        f" OR product_id IN ({_quoted(v.RECALLS.ids)}) AS recalled_flag,"
        f" lower(trim(manufacturer)) IN ({_quoted(b.lower() for b in v.RECALLS.brands)})"
        f" OR regexp_matches(text, '{'|'.join(v.RECALLS.brands)}') AS is_recall_brand,"
        r" nullif(regexp_extract(text, '(?i)\bIP([0-9X])([0-9])\b', 0), '') AS ip_rating,"
        " try_cast(ip_rating[3] AS BIGINT) AS ip_ingress,"
        " try_cast(ip_rating[4] AS BIGINT) AS ip_moisture, ip_moisture < 4 AS ip_incompliance"
        " FROM products LEFT JOIN spec_scores USING (product_id)"),
    "flagged": f"SELECT * FROM all_flagged WHERE product_group IN ({_GROUPS})",
    "keywords": "SELECT arg_min(embedding, vec_id)::DOUBLE[] AS k FROM embeddings GROUP BY label",
    "similarity": (
        "SELECT vec_id, max(list_cosine_similarity(embedding::DOUBLE[], k)) AS max_sim,"
        " avg(list_cosine_similarity(embedding::DOUBLE[], k)) AS mean_sim"
        " FROM embeddings, keywords GROUP BY vec_id"),
    "word_lists": (
        "SELECT review_id, list_transform(regexp_extract_all("
        f"{plain_letters('lower(content)')}, '\\w(?:\\S*\\w)?'), lambda w: {_weights('w')})"
        " AS ws FROM reviews"),
    "negativities": (
        "SELECT review_id, coalesce(round(list_sum(list_transform(ws, lambda x:"
        " CASE WHEN x < 0 THEN -x ELSE 0 END)) / list_sum(list_transform(ws, lambda x:"
        " CASE WHEN x = 0 THEN 1.0 ELSE abs(x) END)), 3), 0.0) AS negativity_score"
        " FROM word_lists"),
    "scored_reviews": (
        "SELECT r.review_id, product_id, marketplace, content AS review_text, negativity_score,"
        f" coalesce(max_sim, 0.0) / {words('content')} AS danger_score FROM reviews r"
        " JOIN negativities USING (review_id) LEFT JOIN similarity ON vec_id = r.review_id"),
    "review_scores": (
        "SELECT product_id, marketplace, sum(negativity_score) AS negativity_score,"
        " sum(danger_score) AS danger_score, count(review_text) AS review_count"
        " FROM scored_reviews GROUP BY product_id, marketplace"),
    "image_maxima": (
        "SELECT product_id, image_id, coalesce(max(CASE WHEN lower(tag_name) = 'socket"
        f" section/aus-north america non-compliant' THEN probability END), 0.0) AS {AUS},"
        " coalesce(max(CASE WHEN lower(tag_name) = 'socket section/uk-german non-compliant'"
        f" THEN probability END), 0.0) AS {UK} FROM (SELECT product_id, image_id, tag_name,"
        " CASE WHEN probability >= 0.9 THEN probability END AS probability FROM image_tags)"
        " GROUP BY product_id, image_id"),
    "image_flags": (
        f"SELECT product_id, count(*) AS image_count, CAST(sum({AUS}) > 0.9 AS INT) AS {AUS},"
        f" CAST(sum({UK}) > 0.9 AS INT) AS {UK} FROM image_maxima GROUP BY product_id"),
    "merged": (
        f"SELECT f.*, image_count, {AUS}, {UK}, negativity_score, danger_score, review_count"
        " FROM flagged f LEFT JOIN image_flags i ON f.product_id = i.product_id"
        " LEFT JOIN review_scores r ON f.product_id = r.product_id"
        " AND f.marketplace IS NOT DISTINCT FROM r.marketplace"),
    "adjusted": (
        "SELECT * REPLACE ("
        " CASE WHEN industrial_flag THEN 0.0 ELSE coalesce(wattage_score, 0.0) END"
        " AS wattage_score,"
        " CASE WHEN industrial_flag AND product_group != 'Group B' THEN 0.0"
        " ELSE coalesce(voltage_score, 0.0) END AS voltage_score,"
        " CASE WHEN industrial_flag AND product_group NOT IN ('Group B', 'Group E') THEN 0.0"
        " ELSE coalesce(amperage_score, 0.0) END AS amperage_score),"
        " CASE WHEN waterproof_flag THEN ip_incompliance ELSE false END"
        " AS adjusted_ip_incompliance,"
        " negativity_score * negativity_score / review_count AS adjusted_negativity_score,"
        " danger_score * danger_score / review_count AS adjusted_danger_score FROM merged"),
    "scored": f"SELECT *, 1 / (1 + exp(-({_logit()}))) AS text_nc_prob FROM adjusted",
    "decided": (
        "SELECT * REPLACE (coalesce(adjusted_ip_incompliance, false) AS adjusted_ip_incompliance,"
        f" coalesce({AUS}, 0) > 0 AS {AUS}, coalesce({UK}, 0) > 0 AS {UK}),"
        " coalesce(text_nc_prob > 0.5, false) AS text_non_compliant,"
        " text_non_compliant OR coalesce(adjusted_ip_incompliance, false) OR recalled_flag"
        f" OR coalesce({AUS}, 0) > 0 OR coalesce({UK}, 0) > 0 AS final_non_compliant"
        " FROM scored"),
    "relevant": "SELECT * FROM decided WHERE NOT is_irrelevant",
}


def needing(body: str, ctes: dict[str, str] = CTES) -> str:
    """``body`` behind a WITH clause of the parts it uses, directly or not."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in ctes:
            if name not in needed and re.search(rf"(?<![\w.]){name}(?!\w)", text):
                needed.add(name)
                todo.append(ctes[name])
    parts = [f"{n} AS ({sql})" for n, sql in ctes.items() if n in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body
