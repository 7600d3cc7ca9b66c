r"""WARC derivatives: metadata and plain-text records made from response records.

Each response gives one metadata and one conversion record. Both name the response in
``WARC-Refers-To`` and each other in ``WARC-Concurrent-To``, carry the response's source
headers and payload digest, and have an identity derived from the response's, so that a task that runs
again writes the same records.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
FIELDS, PLAIN = "application/warc-fields", "text/plain; charset=utf-8"

# Elements without text of their own, and those that end a line.
SILENT = ("script", "style", "noscript", "template", "head")
LINES = ("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form"
         " h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul").split()

# A head is what may stand in one: it ends at its end tag, which may be left out, or before the
# first thing that can't, such as <body>, another element or text.
_COMMENT = r"<!--.*?(?:-->|\Z)"
_SILENT = r"<(%s)\b[^>]*>.*?(?:</\%%d\s*>|\Z)" % "|".join(s for s in SILENT if s != "head")
_HEAD = (r"<head(?=[\s/>])[^>]*>(?:\s++|" + _COMMENT + "|" + _SILENT % 2
         + r"|<(title|noframes)\b[^>]*>[^<]*+(?:<(?!/?(?:\3|head|body)\b)[^<]*+)*+</\3\s*>"
         r"|<(?:meta|link|base|basefont|bgsound|html)\b[^>]*>"
         r"|</(?!(?:head|body|html|br)\b)[a-z][^>]*>)*+(?:</head\s*>)?")
_SKIP = re.compile(_COMMENT + "|" + _SILENT % 1 + "|" + _HEAD, re.S | re.I)
_LINE = re.compile(r"</?(?:%s)\b[^>]*>" % "|".join(LINES), re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_CHARSET = re.compile(r"<meta\b[^>]*?\bcharset\s*=\s*[\"']?([A-Za-z0-9_-]+)", re.I)
_HREF = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_BLANK = re.compile(r"\s+")


def plain_text(page: str) -> str:
    """The text of an HTML page: a line for each block, entities decoded, no blank lines.

    Comments and silent elements go; one that is never closed goes to the end of the page, as
    in a browser. A head ends, closed or not, before the first thing that can't stand in one. A
    "<" that begins no tag is text.
    """
    page = _TAG.sub("", _LINE.sub("\n", _SKIP.sub(" ", page)))
    lines = (_BLANK.sub(" ", line).strip() for line in html.unescape(page).split("\n"))
    return "\n".join(line for line in lines if line)


def page_fields(page: str) -> list[tuple[str, str]]:
    """Title, language, charset and links of an HTML page, as named fields on one line each."""
    clean = lambda s: _BLANK.sub(" ", html.unescape(s)).strip()
    bare = re.sub(r"<!--.*?(?:-->|\Z)", " ", page, flags=re.S)
    fields = [(name, clean(m[1])) for name, m in (
        ("title", _TITLE.search(bare)), ("languages-html", _LANG.search(bare)),
        ("charset-html", _CHARSET.search(bare))) if m]
    return fields + [("outlink", clean(next(filter(None, m), ""))) for m in _HREF.findall(bare)]


def _uuid(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws(" ", *parts))
    cut = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(pages: DataFrame, date: str, id_col: str = "page_id", url_col: str = "url",
              body_col: str = "html") -> DataFrame:
    """Response records of stored pages: (source_id, record_id, target_uri, date, http_headers,
    payload). Identities come from source identity, address and payload, so rows that repeat all
    three are the same record."""
    c = lambda name: F.col(f"`{name}`")
    text = lambda name: F.coalesce(c(name).cast("string"), F.lit(""))
    return pages.select(
        c(id_col).alias("source_id"),
        _uuid(F.lit("response"), text(id_col), text(url_col), text(body_col)).alias("record_id"),
        c(url_col).alias("target_uri"), F.lit(date).alias("date"),
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n").alias("http_headers"),
        c(body_col).alias("payload"))


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        pages = [p or "" for p in frame.pop("payload")]
        yield frame.assign(
            conversion=[plain_text(p) for p in pages],
            fields=["".join(f"{k}: {v}\r\n" for k, v in page_fields(p)) for p in pages])


def derive(df: DataFrame) -> DataFrame:
    """Two records for each response: metadata and conversion.

    Input: (source_id, record_id, target_uri, date, http_headers, payload) as of ``responses``;
    other columns are dropped. A null payload is empty: its conversion has an empty block. A
    null address, date or header is left out of the record. Repeated responses give repeated
    records. Output: source_id, warc_type, record_id, refers_to, concurrent_to, target_uri,
    date, content_type, payload_digest (of the response), block_digest, content_length (bytes),
    headers (the record's, in order), block.
    """
    name = lambda kind: _uuid(F.lit(kind), F.col("record_id"))
    digest = lambda c: F.concat(F.lit("sha256:"), F.sha2(c, 256))
    known = df.select("source_id", "record_id", "target_uri", "date", "http_headers", "payload",
                      digest(F.coalesce("payload", F.lit(""))).alias("payload_digest"))
    ended = known.mapInPandas(_blocks, known.drop("payload").schema.simpleString()[7:-1]
                              + ",conversion:string,fields:string")
    source = F.concat(
        F.concat(F.lit("source-payload-digest: "), "payload_digest", F.lit("\r\n")),
        F.coalesce(F.concat_ws("", F.transform(
            F.filter(F.split("http_headers", "\r?\n"), lambda h: h != ""),
            lambda h: F.concat(F.lit("source-header: "), h, F.lit("\r\n")))), F.lit("")))
    rows = ended.select("*", F.explode(F.array(
        F.struct(F.lit("metadata").alias("warc_type"), name("metadata").alias("own"),
                 name("conversion").alias("other"), F.lit(FIELDS).alias("content_type"),
                 F.concat(source, "fields").alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), name("conversion").alias("own"),
                 name("metadata").alias("other"), F.lit(PLAIN).alias("content_type"),
                 F.col("conversion").alias("block")))).alias("r"))
    rows = rows.select(
        "source_id", "r.warc_type", F.col("r.own").alias("record_id"),
        F.col("record_id").alias("refers_to"), F.col("r.other").alias("concurrent_to"),
        "target_uri", "date", "r.content_type", "payload_digest", digest(F.col("r.block"))
        .alias("block_digest"), F.octet_length("r.block").cast("long").alias("content_length"),
        "r.block")
    header = lambda key, c: F.concat(F.lit(f"{key}: "), F.col(c).cast("string"))
    headers = F.array_compact(F.array(
        header("WARC-Type", "warc_type"), header("WARC-Record-ID", "record_id"),
        header("WARC-Date", "date"), header("WARC-Refers-To", "refers_to"),
        header("WARC-Concurrent-To", "concurrent_to"), header("WARC-Target-URI", "target_uri"),
        header("WARC-Block-Digest", "block_digest"), header("Content-Type", "content_type"),
        header("Content-Length", "content_length")))
    return rows.select(*rows.columns[:-1], headers.alias("headers"), "block")


def serialised(records: DataFrame) -> DataFrame:
    """Each record as it stands in a file, without the two line ends that follow it: (record)."""
    return records.select(F.concat(
        F.lit(VERSION + "\r\n"), F.array_join("headers", "\r\n"), F.lit("\r\n\r\n"), "block"
    ).alias("record"))


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files, one for each partition, written by the tasks."""
    serialised(records).write.option("lineSep", "\r\n\r\n").option(
        "compression", compression).text(path)
