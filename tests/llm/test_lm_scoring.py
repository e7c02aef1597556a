import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm.cases import awkward_rows, awkward_texts, by_id, frame, prose

from gridscout.llm import lm_scoring as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = object()


def tokens(text):
    return [*(text or "").translate(LOWER).encode().split(), END]


def is_held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def brute(texts):
    counts, pairs, n_train = Counter(), Counter(), 0
    for i, text in texts.items():
        if not is_held(i):
            w = tokens(text)
            counts.update(w)
            pairs.update(zip([None, *w], w))
            n_train += 1
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in texts.items():
        w = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in w)
        out[i] = (is_held(i), len(w), sum(counts[t] > 0 for t in w), n, pytest.approx(base, rel=1e-9, abs=1e-9))
    return out, counts, pairs, n_train


def found(df):
    return {i: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for i, r in by_id(df).items()}


def corpus():
    return awkward_texts() | {100 + i: prose(i, 80, 150 + 20 * (i % 4)) for i in range(60)}


def test_awkward_rows(spark):
    assert found(L.lm_scores(frame(spark, awkward_rows()))) == brute(awkward_texts())[0]


def test_words_that_are_not_broadcast_are_looked_up(spark):
    texts = corpus()
    expected = brute(texts)[0]
    docs = frame(spark, list(texts.items()))
    everything = by_id(L.lm_scores(docs))
    for most in (0, 20, 500):
        out = L.lm_scores(docs, most_words=most, group_bytes=2000)
        assert found(out) == expected
    assert {i: r.n_known for i, r in everything.items()} == {i: x[2] for i, x in expected.items()}


def test_scores_are_those_of_the_quantised_counts(spark):
    """With a filter too large for false positives the score is the smoothed bigram's on level counts."""
    texts = corpus()
    _, counts, pairs, n_train = brute(texts)
    n, v = sum(counts.values()), len(counts)
    values = L.level_counts(L.BASE)
    level = lambda c: values[L._levels(np.array([c]), L.BASE)[0]]
    out = by_id(L.lm_scores(frame(spark, list(texts.items())), bits_per_byte=64))
    close = 0
    for i, text in texts.items():
        total, before = 0.0, None
        for t in tokens(text):
            h = n_train if before is None else level(counts[before])
            both = min(level(pairs[before, t]), h, level(counts[t]))
            total += math.log10((both + L.SMOOTHING * (level(counts[t]) + 1) / (n + v + 1)) / (h + L.SMOOTHING))
            before = t
        close += abs(out[i].score - total) <= 0.01 * abs(total) + 1e-9
        assert out[i].score <= 0
    assert close >= 0.9 * len(texts)


def test_filter_never_loses_an_ngram():
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    counts = rng.integers(1, 4000, len(hashes))
    import pyarrow as pa

    parts = pa.table({"cell": pa.array([0], pa.int32()), "pairs": [True], "hashes": pa.array([hashes.tobytes()]), "counts": pa.array([counts.astype(np.uint32).tobytes()])})
    model = L._cell_model(20, L.BASE)(parts)
    filter_ = np.frombuffer(model.column("filter")[0].as_py(), np.uint8)
    found = L.probe(filter_, hashes, 0, 20)
    true = L._levels(counts, L.BASE)
    assert (found >= true).all() and (found == true).mean() > 0.9
    others = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    assert (L.probe(filter_, others, 0, 20) == 0).mean() > 0.9


def test_levels():
    counts = np.arange(0, 100_000)
    levels = L._levels(counts, 1.5)
    assert (np.diff(levels) >= 0).all() and levels[0] == 0 and levels[1] == 1
    values = L.level_counts(1.5)
    assert values[1] == 1 and abs(np.log(values[levels[1:]] / counts[1:])).max() < np.log(1.5)


def test_a_likely_text_scores_higher(spark):
    texts = {i: "the cat sat on the mat" for i in range(60)} | {100: "the cat sat on the mat", 101: "mat the on sat cat the"}
    out = by_id(L.lm_scores(frame(spark, list(texts.items()))))
    assert out[100].score > out[101].score and out[100].base_score == pytest.approx(out[101].base_score)


def test_empty_tables(spark):
    assert L.lm_scores(frame(spark, [])).collect() == []
    held = next(i for i in range(100) if is_held(i))
    (row,) = L.lm_scores(frame(spark, [(held, "all held out")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (4, 0, 0, 0.0)


def test_a_filter_that_is_not_broadcast_gives_the_same_scores(spark):
    """`filter_bits` bounds what is broadcast, not the filter."""
    docs = frame(spark, list(corpus().items()))
    for group_bytes in (2000, 8 << 20):
        whole, found = (by_id(L.lm_scores(docs, filter_bits=bits, group_bytes=group_bytes)) for bits in (1 << 30, 1 << 10))
        assert found == whole
    assert by_id(L.lm_scores(frame(spark, awkward_rows()), filter_bits=1)) == by_id(L.lm_scores(frame(spark, awkward_rows())))


def test_false_positives_do_not_grow_with_the_input():
    rng = np.random.default_rng(5)
    import pyarrow as pa

    for n in (1000, 100_000):
        hashes = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        counts = rng.integers(1, 40, len(hashes))
        parts = pa.table({"cell": pa.array([0], pa.int32()), "pairs": [True], "hashes": pa.array([hashes.tobytes()]), "counts": pa.array([counts.astype(np.uint32).tobytes()])})
        filter_ = np.frombuffer(L._cell_model(10, L.BASE)(parts).column("filter")[0].as_py(), np.uint8)
        stretch = np.array([0, 8 * len(filter_)])
        assert (L.probe(filter_, hashes, 0, stretch) >= L._levels(counts, L.BASE)).all()
        assert (L.probe(filter_, rng.integers(0, 2**63, 50_000, dtype=np.uint64), 0, stretch) > 0).mean() < 0.06
