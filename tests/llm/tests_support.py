"""Brute-force versions that several tests use."""

import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
from tokenizers import Tokenizer

from tidewater.llm import simhash_tiles
from tidewater.llm.bm25_packing import tokenizer_path


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text, width=4, seed=42):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_shingles(text, width=5):
    words = plain_words(text)
    return {" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def words_shared(a, b):
    """Share of the longer text's words (with repeats) that both have."""
    a, b = Counter(plain_words(a)), Counter(plain_words(b))
    return sum((a & b).values()) / max(1, sum(a.values()), sum(b.values()))


def plain_signature(text):
    """Least hashes of shingles and word occurrences, in Python integers."""
    full = (1 << 64) - 1
    shingles = [xxhash.xxh64_intdigest(s.encode(), 42) for s in plain_shingles(text)]
    elements = []
    for word, n in Counter(plain_words(text)).items():
        for k in range(n):
            x = xxhash.xxh64_intdigest(word.encode(), 42) + k * 0x9E3779B97F4A7C15 & full
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
            elements.append(x ^ x >> 27)
    slots = [int(x) for x in simhash_tiles._SLOTS]
    least = lambda hashes, m: min((h * m & full for h in hashes), default=0)
    return [least(shingles, m) >> 32 for m in slots[:16]], [least(elements, m) >> 20 & 255 for m in slots[16:]], len(elements)


def near_links(texts):
    """Pairs of places whose texts link as near-duplicates, by every pair."""
    prints = [(plain_fingerprint(t, 5, 42), plain_fingerprint(t, 5, 43)) for t in texts]
    signed = [plain_signature(t) for t in texts]
    found = []
    for a in range(len(texts)):
        for b in range(a):
            if sum((x ^ y).bit_count() for x, y in zip(prints[a], prints[b], strict=True)) > 42:
                continue
            (s, w, m), (u, v, n) = signed[a], signed[b]
            agree = (sum(x == y for x, y in zip(w, v, strict=True)) / 128 - 1 / 256) * 256 / 255
            if sum(x == y for x, y in zip(s, u, strict=True)) >= 2 and agree / (1 + agree) * (m + n) >= 0.8 * max(m, n):
                found.append((a, b))
    return found


def token_ids(texts):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def check_pieces(pieces, documents, window=2048):
    """Every id of every document lies in one piece, and sequences are gapless."""
    wanted = Counter((i, tuple(x)) for i, x in documents)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        by_doc[p["doc_id"], p["doc_tokens"]].append((p["start"], ids))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for (doc_id, n), found in by_doc.items():
        copies = sum(c for (i, x), c in wanted.items() if i == doc_id and len(x) == n)
        assert sum(len(ids) for _, ids in found) == copies * n
        if copies == 1:
            assert tuple(x for _, ids in sorted(found) for x in ids) in {x for (i, x) in wanted if i == doc_id}
    assert {(i, len(x)) for (i, x) in wanted} == set(by_doc)
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return by_sequence
