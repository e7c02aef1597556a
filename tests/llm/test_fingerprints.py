import hashlib
import random

import numpy as np
import pytest
import xxhash
from tests.llm.cases import awkward_rows, awkward_texts, by_id, frame, prose

from gridscout.llm import fingerprints as P
from gridscout.llm import words as W


def brute(text, size=P.SIZE, kept=P.TUPLE, k=P.K):
    """Order MinHash with plain loops."""
    mask = (1 << 64) - 1

    def mix(x):
        return int(W.mix(np.array([x & mask], np.uint64))[0])

    if not text:
        return [0] * size
    kmers = [text] if len(text) < k else [text[i : i + k] for i in range(len(text) - k + 1)]
    seen, numbered = {}, []
    for x in kmers:
        h = mix(int.from_bytes(x, "little")) if len(x) == k == 8 else xxhash.xxh3_64_intdigest(x)
        numbered.append(mix(h + seen.get(x, 0) * 0xC2B2AE3D27D4EB4F))
        seen[x] = seen.get(x, 0) + 1
    out = []
    for f in P._factors[:size].tolist():
        ranked = sorted(range(len(numbered)), key=lambda i: (numbered[i] * f & mask, i))
        value = chosen = min(kept, len(numbered))
        for i in sorted(ranked[:chosen]):
            value = mix(value * 0x9E3779B97F4A7C15 + numbered[i])
        out.append(value >> 32)
    return out


@pytest.mark.parametrize("text", ["", "a", "short", "exactly8", "ninechars", "abab" * 40, "aaaaaaaaaaaaaaaaaaaaaaa", prose(1, 60), "é日本\U0001f600 " * 9])
def test_signature_equals_plain_loops(text):
    assert P.order_minhash(text.encode()).tolist() == brute(text.encode())
    assert P.order_minhash(text.encode(), 8, 3, 5).tolist() == brute(text.encode(), 8, 3, 5)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = prose(2, 400).encode()
    whole = P.order_minhash(text)
    monkeypatch.setattr(P, "LONG", 100)
    assert (P.order_minhash(text) == whole).all()


def test_order_and_repeats_matter():
    words = prose(3, 300, 10_000).split()
    a = P.order_minhash(" ".join(words).encode(), 256)
    moved = P.order_minhash(" ".join(words[150:] + words[:150]).encode(), 256)
    few = P.order_minhash(" ".join(words[:75] + ["changed"] + words[76:]).encode(), 256)
    assert P.likeness(a, few) > 0.9 > 0.75 > P.likeness(a, moved)  # nearly the same k-mers in both
    once, twice = P.order_minhash(b"abcdefghijkl", 256), P.order_minhash(b"abcdefghijkl" * 2, 256)
    assert P.likeness(once, twice) < 0.5


def expected(texts):
    ids = sorted(texts, reverse=True)
    out = {}
    for i, after in zip(ids, ids[1:] + ids[:1]):
        own, other = texts[i] or "", texts[after] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + other[:half]
        a, b, c = (P.order_minhash(x.encode()) for x in (own, changed, other))
        sha = hashlib.sha256(changed.encode()).hexdigest()
        out[i] = (len(own), sha, a.astype(">u4").tobytes().hex(), b.astype(">u4").tobytes().hex(), float((a == b).mean()), float((a == c).mean()))
    return out


def found(df):
    return {i: (r.n_chars, r.edited, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for i, r in by_id(df).items()}


def test_awkward_rows(spark):
    out = found(P.fingerprints(frame(spark, awkward_rows())))
    assert out == expected(awkward_texts())
    assert out[0][2] == out[1][2] == out[2**40][2]


def test_neighbours_over_partitions(spark):
    rng = random.Random(4)
    texts = {rng.randrange(10**9): prose(i, rng.randrange(0, 30)) for i in range(50)}
    assert found(P.fingerprints(frame(spark, list(texts.items())))) == expected(texts)


def test_few_documents(spark):
    assert P.fingerprints(frame(spark, [])).collect() == []
    for texts in ({7: "alone and its own next"}, {7: None}, {1: "first", 2: "second"}):
        assert found(P.fingerprints(frame(spark, list(texts.items())))) == expected(texts)
