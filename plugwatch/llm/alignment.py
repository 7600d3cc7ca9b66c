"""Alignment of two tokenizers over a corpus.

Byte offsets where tokens of both end cut a text into groups. Most groups are one token of
each with the same bytes: for these an array made beforehand gives the second tokenizer's id for each id
of the first (*identity map*), so such a pair is named by one id and counted in a vector as long as
the vocabulary. Only the pairs of the other groups are shuffled.

Texts are encoded once; what the counts need of each document is written to the shared folder.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugwatch.operators.joins import join_unique
from plugwatch.session import stored

# Bytes of text encoded before their tokens are aligned; bounds a task's memory.
CHUNK = 300_000
SPACE = "▁"
# How byte-level vocabularies write bytes that aren't printed as they are, and the
# pattern that splits a text before the merges.
PRINTED = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

ALIGNED = (
    "row long, n_a long, n_b long, n_groups long, n_links long, groups string,"
    " same array<int>, same_n array<int>, a array<int>, b array<int>, n array<int>")
_SCHEMA = pa.schema([
    ("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups", pa.string()),
    *[(k, pa.list_(pa.int32())) for k in ("same", "same_n", "a", "b", "n")]])


class Vocabularies(NamedTuple):
    """The files of both tokenizers, as bytes, so that tasks need not reach their paths."""

    a: bytes
    b: bytes


def vocabularies(byte_level: str, pieces: str) -> Vocabularies:
    """Reads a byte-level BPE (JSON) and a piece model. Both are a few MB whatever the corpus."""
    with open(byte_level, "rb") as a, open(pieces, "rb") as b:
        return Vocabularies(a.read(), b.read())


def _byte_of_char() -> dict[str, int]:
    found = {chr(b): b for b in PRINTED}
    rest = [b for b in range(256) if b not in set(PRINTED)]
    return found | {chr(256 + i): b for i, b in enumerate(rest)}


class Tables:
    """Encoders, the bytes of every token, and the identity map."""

    def __init__(self, files: Vocabularies):
        import sentencepiece

        chars = _byte_of_char()
        spec = json.loads(files.a)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        vocab = spec["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = token.encode() if token in special else bytes(chars[c] for c in token)
        self.encode_a = self._encoder_a(spec, files.a, special)
        piece = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        self.encode_b = lambda texts: piece.encode(texts, num_threads=1)
        self.bytes_b = [
            bytes([int(piece.id_to_piece(i)[3:5], 16)]) if piece.is_byte(i)
            else piece.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(piece.get_piece_size())]
        self.size_a = np.array([len(t) for t in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(t) for t in self.bytes_b], dtype=np.int64)
        # Of ids with equal bytes the first that is no byte piece, else the byte piece.
        of_bytes: dict[bytes, int] = {}
        for byte in (False, True):
            for i, t in enumerate(self.bytes_b):
                if piece.is_byte(i) == byte and t and not piece.is_control(i) and not piece.is_unknown(i):
                    of_bytes.setdefault(t, i)
        self.same = np.array([of_bytes.get(t, -1) for t in self.bytes_a], dtype=np.int64)
        self.one_to_one = [f"{a}|{b}" for a, b in enumerate(self.same.tolist())]

    def _encoder_a(self, spec, source: bytes, special: set[str]):
        """Merges by rank where ids are in the order of the merges, which is fast; else the
        library that reads the whole file."""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in
                  spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        made = [vocab["".join(m)] for m in merges]
        step = spec.get("pre_tokenizer") or {}
        plain = (step.get("type") == "ByteLevel" and not step.get("add_prefix_space")
                 and step.get("use_regex", True) and not spec.get("normalizer"))
        if plain and made == sorted(set(made)) and len(vocab) - len(special & set(vocab)) == 256 + len(made):
            import tiktoken

            ranks = {self.bytes_a[i]: i for t, i in vocab.items() if t not in special}
            fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            return lambda texts: [fast.encode_ordinary(t) for t in texts]
        from tokenizers import Tokenizer

        slow = Tokenizer.from_str(source.decode())
        slow.encode_special_tokens = True
        return lambda texts: [slow.encode(t, add_special_tokens=False).ids for t in texts]


def align_texts(texts: list[str], tables: Tables) -> list[dict]:
    """The groups and links of each text, by both tokenizers over all texts at once."""
    none = dict(n_a=0, n_b=0, n_groups=0, n_links=0, groups="", same=[], same_n=[], a=[], b=[], n=[])
    out = [none] * len(texts)
    some = [i for i, t in enumerate(texts) if t]
    spaced = [" " + texts[i] for i in some]
    ids_a, ids_b = tables.encode_a(spaced), tables.encode_b([texts[i] for i in some])
    kept = []
    for i, text, a, b in zip(some, spaced, ids_a, ids_b):
        data = text.encode()
        if (b"".join([tables.bytes_a[t] for t in a]) == data
                and b"".join([tables.bytes_b[t] for t in b]) == data):
            kept.append((i, a, b))
    if not kept:
        return out
    n_a, n_b = (np.array([len(k[j]) for k in kept]) for j in (1, 2))
    a, b = (np.concatenate([np.array(k[j], dtype=np.int64) for k in kept]) for j in (1, 2))
    end_a, end_b = np.cumsum(tables.size_a[a]), np.cumsum(tables.size_b[b])
    cuts = np.intersect1d(end_a, end_b)
    group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    of_a, of_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
    first_a, first_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
    doc_of_group = np.searchsorted(np.cumsum(n_a), first_a, side="right")
    lone = (of_a == 1) & (of_b == 1)
    plain = lone & (tables.same[a[first_a]] == b[first_b])
    # All pairs of the other groups.
    odd = np.flatnonzero(~plain)
    links = of_a[odd] * of_b[odd]
    g = np.repeat(odd, links)
    k = np.arange(len(g)) - np.repeat(np.cumsum(links) - links, links)
    link_a, link_b = a[first_a[g] + k // of_b[g]], b[first_b[g] + k % of_b[g]]
    # Pairs of the identity map, distinct by document, as (document, id): the one-to-one groups, and
    # such pairs as stand at other places of the other groups.
    width, wide = len(tables.bytes_a), len(tables.bytes_b)
    mapped = tables.same[link_a] == link_b
    pairs, same_n = np.unique(np.concatenate([
        doc_of_group[plain] * width + a[first_a[plain]],
        doc_of_group[g[mapped]] * width + link_a[mapped]]), return_counts=True)
    same_doc, same_id = pairs // width, pairs % width
    g, link_a, link_b = g[~mapped], link_a[~mapped], link_b[~mapped]
    odd_pairs, odd_n = np.unique(
        (doc_of_group[g] * width + link_a) * wide + link_b, return_counts=True)
    odd_doc, odd_a, odd_b = odd_pairs // wide // width, odd_pairs // wide % width, odd_pairs % wide
    said = list(map(tables.one_to_one.__getitem__, a[first_a].tolist()))
    text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
    for i in odd.tolist():
        p, q = first_a[i], first_b[i]
        said[i] = f"{','.join(text_a[p:p + of_a[i]])}|{','.join(text_b[q:q + of_b[i]])}"
    docs = np.arange(len(kept) + 1)
    group_at, same_at, odd_at = (np.searchsorted(x, docs) for x in (doc_of_group, same_doc, odd_doc))
    all_links = np.bincount(doc_of_group, of_a * of_b, minlength=len(kept)).astype(np.int64)
    for j, (i, _, _) in enumerate(kept):
        s, o = slice(same_at[j], same_at[j + 1]), slice(odd_at[j], odd_at[j + 1])
        out[i] = dict(
            n_a=int(n_a[j]), n_b=int(n_b[j]), n_groups=int(group_at[j + 1] - group_at[j]),
            n_links=int(all_links[j]), groups=";".join(said[group_at[j]:group_at[j + 1]]),
            same=same_id[s], same_n=same_n[s], a=odd_a[o], b=odd_b[o], n=odd_n[o])
    return out


def _align(files: Vocabularies):
    def ended(rows, texts, tables):
        told = align_texts(texts, tables)
        return pa.RecordBatch.from_arrays([
            pa.array(rows, pa.int64()),
            *[pa.array([t[f.name] for t in told], f.type) for f in list(_SCHEMA)[1:]],
        ], schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, rows, texts, size = Tables(files), [], [], 0
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows.append(row)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK:
                    yield ended(rows, texts, tables)
                    rows, texts, size = [], [], 0
        if rows:
            yield ended(rows, texts, tables)

    return run


def groups(df: DataFrame, files: Vocabularies, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: (id, n_a, n_b, n_groups, n_links, groups, …), ``groups`` as
    ``a1,a2|b1;a3|b2,b3``. The other columns hold the linked pairs, distinct by document and
    with their number: ``same`` by the id of the first tokenizer, the others as ``a`` and ``b``."""
    rows = df.select(F.monotonically_increasing_id().alias("row"),
                     F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    told = rows.select(F.struct("row", "id").alias("key"), "text")
    kind = rows.schema["id"].dataType
    packed = told.select("key.row", "text", "key.id")
    files_of = df.sparkSession.sparkContext.broadcast(tuple(files))

    def run(batches):
        align = _align(Vocabularies(*files_of.value))
        for batch in batches:
            ids = batch.column(2)
            at = 0
            for out in align(iter([batch])):
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, ids.slice(at, out.num_rows)], [*_SCHEMA.names, "id"])
                at += out.num_rows

    return packed.mapInArrow(run, f"{ALIGNED}, id {kind.simpleString()}")


def _vector(rows: Iterator[pa.RecordBatch], size: int) -> np.ndarray:
    total = np.zeros(size, dtype=np.int64)
    for batch in rows:
        total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
    return total


def pair_counts(aligned: DataFrame, same: np.ndarray) -> tuple[np.ndarray, DataFrame, np.ndarray]:
    """In how many documents each pair is linked: a vector for the identity pairs, a table
    (a, b, count) for the others, and for each first id its largest count. Both vectors are as
    long as the vocabulary."""
    size = len(same)

    def count(batches):
        total = _vector(batches, size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["a", "n"])

    plain = np.zeros(size, dtype=np.int64)
    sums = aligned.select("same").mapInArrow(count, "a int, n long").groupBy("a").agg(
        F.sum("n").alias("n"))
    for row in sums.collect():
        plain[row["a"]] = row["n"]
    odd = stored(aligned.select(F.explode(F.arrays_zip("a", "b")).alias("p")).groupBy(
        F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count(F.lit(1)).alias("count")))
    best = plain.copy()
    for row in odd.groupBy("a").agg(F.max("count").alias("n")).collect():
        best[row["a"]] = max(best[row["a"]], row["n"])
    return plain, odd, best


def link_sums(aligned: DataFrame, plain: np.ndarray, odd: DataFrame,
              best: np.ndarray) -> DataFrame:
    """Per document (row, n_best, count_sum) over its links."""
    def sums(batches):
        for batch in batches:
            ids, n = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in (1, 2))
            lengths = np.diff(np.asarray(batch.column(1).offsets))
            at = np.repeat(np.arange(batch.num_rows), lengths)
            counts = plain[ids] * n
            top = np.where(plain[ids] == best[ids], n, 0)
            total, tops = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(2))
            np.add.at(total, at, counts)
            np.add.at(tops, at, top)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tops), pa.array(total)], ["row", "n_best", "count_sum"])

    lone = aligned.select("row", "same", "same_n").mapInArrow(
        sums, "row long, n_best long, count_sum long")
    tops = odd.sparkSession.createDataFrame(
        [(int(a), int(best[a])) for a in np.flatnonzero(best)], "a int, top long")
    # At most as many rows as the vocabulary.
    counted = odd.join(F.broadcast(tops), "a").select(
        "a", "b", "count", (F.col("count") == F.col("top")).alias("is_best"))
    links = aligned.select("row", F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select(
        "row", "p.a", "p.b", "p.n")
    told = join_unique(links, counted, ["a", "b"], "inner").select(
        "row", F.when(F.col("is_best"), F.col("n")).otherwise(0).cast("long").alias("n_best"),
        (F.col("count") * F.col("n")).alias("count_sum"))
    return lone.unionByName(told).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(df: DataFrame, files: Vocabularies, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A space and the text are encoded by both tokenizers, strings of special tokens as plain text.
    ``n_links`` counts all pairs of token occurrences that share a group. A pair's count is the number
    of rows that hold it linked; ``n_best`` counts the links whose count is the largest of
    their first id (ties included), ``count_sum`` adds the counts of all links. A text that is null or
    empty, or that either tokenizer changes, has no tokens: zeros, and an empty digest. Repeated rows
    are documents of their own; other columns are not looked at; an empty table gives an empty
    one. A text is encoded whole, as no cut of it is safe for every vocabulary, so a task
    needs memory for the tokens of its longest text.
    """
    tables = Tables(files)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = stored(groups(df, files, id_col, text_col).withColumn(
        "groups_sha256", digest).drop("groups"))
    plain, odd, best = pair_counts(aligned, tables.same)
    sums = link_sums(aligned, plain, odd, best)
    return aligned.join(sums, "row").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256")
