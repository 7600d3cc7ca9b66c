"""Brute-force versions that several tests compare with."""

import hashlib
import math
import re
from collections import Counter

import xxhash


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def poisson(mean, u):
    k, p = 0, math.exp(-mean)
    cdf = p
    while cdf < u:
        k += 1
        p *= mean / k
        cdf += p
    return k


def point(seed, key, part):
    return (int(hashlib.md5(f"{seed}:{key}:{part}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48


def plain_simhash(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_matches(text, items, least=0.8):
    """Every window of every item's size, without index or anchors."""
    words = re.findall(r"\w+", (text or "").lower())
    out, all_of = {}, [" ".join(words[i:i + k]) for k in range(1, 6) for i in range(len(words) - k + 1)]
    all_of = set(all_of)
    cut = lambda w: Counter(" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    for ident, item in items:
        own = re.findall(r"\w+", (item or "").lower())
        if not own or not words:
            continue
        n, want = min(len(own), len(words)), cut(own)
        if not all_of & set(want):
            continue  # nothing shared: similarity zero everywhere
        best = (0.0, 0)
        for a in range(len(words) - n + 1):
            got = cut(words[a:a + n])
            s = sum((got & want).values()) / sum((got | want).values())
            if s > best[0]:
                best = (s, a)
        if best[0] >= least:
            out[ident] = (round(best[0], 9), best[1], n)
    return out
