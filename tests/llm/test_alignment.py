import bisect
import hashlib
import json
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plugwatch.llm import alignment as al
from plugwatch.llm.queries import TOKENIZERS

FILES = al.vocabularies(*TOKENIZERS)
TABLES = al.Tables(FILES)
A = Tokenizer.from_file(TOKENIZERS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=TOKENIZERS[1])


def tokens(text):
    """(ids, bytes) of both, by the libraries; None where one changes the text."""
    data = f" {text or ''}".encode()
    if not text:
        return None
    a = A.encode(f" {text}", add_special_tokens=False).ids
    b = B.encode(text)
    piece = lambda i: (bytes([int(B.id_to_piece(i)[1:-1], 16)]) if B.is_byte(i)
                       else B.id_to_piece(i).replace("▁", " ").encode())
    from tokenizers.pre_tokenizers import ByteLevel

    shown = {c: i for i, c in enumerate(byte_chars())}
    assert set(shown) == set(ByteLevel.alphabet())
    of_a = [bytes(shown[c] for c in A.id_to_token(i)) for i in a]
    of_b = [piece(i) for i in b]
    return (a, of_a, b, of_b) if b"".join(of_a) == data == b"".join(of_b) else None


def byte_chars():
    """The printed form of each byte: itself where Latin-1 prints it, else the next free character."""
    out, free = [], 256
    for i in range(256):
        if 0x21 <= i <= 0x7E or 0xA1 <= i <= 0xAC or 0xAE <= i <= 0xFF:
            out.append(chr(i))
        else:
            out.append(chr(free))
            free += 1
    return out


def grouped(text):
    found = tokens(text)
    if not found:
        return None
    a, of_a, b, of_b = found
    ends = lambda parts: [sum(map(len, parts[:i + 1])) for i in range(len(parts))]
    end_a, end_b = ends(of_a), ends(of_b)
    cuts = sorted(set(end_a) & set(end_b))
    out = [([], []) for _ in cuts]
    for side, (ids, at) in enumerate(((a, end_a), (b, end_b))):
        for i, e in zip(ids, at):
            out[bisect.bisect_left(cuts, e)][side].append(i)
    return out


def brute(rows):
    groups = [grouped(t) for _, t in rows]
    links = [[(p, q) for x, y in g or () for p in x for q in y] for g in groups]
    count = Counter(pair for ls in links for pair in set(ls))
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for (ident, _), g, ls in zip(rows, groups, links):
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g or ())
        out.append((ident, sum(len(x) for x, _ in g or ()), sum(len(y) for _, y in g or ()), len(g or ()),
                    len(ls), sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls),
                    hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return Counter(out)


def test_against_brute_force(read):
    docs = read("documents")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 9000]
    got = al.align(docs.filter("length(text) < 9000"), FILES)
    assert Counter(map(tuple, got.collect())) == brute(rows)


TEXTS = st.text(max_size=40) | st.text(
    alphabet="ab \t\n'sté.<>|0x4A1▁\U0001f600  ", max_size=40) | st.sampled_from(
    ["<|endoftext|>", "a <|endoftext|>b", "<s>", "</s> x", "<unk>", "<0x41>", "a▁b", " ", "  ", "a  b ",
     "\x00", "don't I'll", "\r\n\r\n x", "ﬁ ﷺ", "１２３"])


@settings(max_examples=250, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_groups_of_any_text(texts):
    """The fast encoder and the groups over a chunk are those of the libraries, text by text."""
    for text, got in zip(texts, al.align_texts(texts, TABLES)):
        want = grouped(text)
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want or ())
        assert got["groups"] == said
        links = Counter((p, q) for x, y in want or () for p in x for q in y)
        plain = {(a, int(TABLES.same[a])): n for a, n in zip(got["same"], got["same_n"])}
        odd = {(a, b): n for a, b, n in zip(got["a"], got["b"], got["n"])}
        assert not set(plain) & set(odd) and plain | odd == dict(links)


def test_the_encoder_reads_other_files_whole():
    """A vocabulary whose ids don't follow its merges goes through the library that reads it."""
    spec = json.loads(FILES.a)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    other = al.Tables(al.Vocabularies(json.dumps(spec).encode(), FILES.b))
    for text in (" two words", " <|endoftext|>", " a  b"):
        assert list(other.encode_a([text])[0]) == A.encode(text, add_special_tokens=False).ids


def test_odd_tables(odd):
    rows = [(r.doc_id, r.text if len(r.text or "") < 9000 else "w") for r in odd.collect()]
    from pyspark.sql import functions as F

    cut = odd.withColumn("text", F.when(F.length("text") < 9000, F.col("text")).when(
        F.col("text").isNotNull(), "w"))
    got = al.align(cut, FILES)
    assert Counter(map(tuple, got.collect())) == brute(rows)
    long = {r.doc_id: r for r in al.align(odd, FILES).collect()}
    assert long[8].n_a > 40_000 and long[8].groups_sha256 == long[9].groups_sha256
    assert al.align(odd.limit(0), FILES).count() == 0


def test_a_pair_in_all_rows(table):
    rows = [(i, f"gluten zzxqzzxq w{i}") for i in range(300)] + [(None, None), (1, "")]
    got = al.align(table(rows), FILES)
    assert Counter(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("chunk", [1, 50])
def test_chunks(table, monkeypatch, chunk):
    monkeypatch.setattr(al, "CHUNK", chunk)
    rows = [(i, "some text " * i) for i in range(9)]
    assert Counter(map(tuple, al.align(table(rows), FILES).collect())) == brute(rows)
