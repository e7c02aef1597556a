import random

import numpy as np
from tests.llm.cases import awkward_rows, awkward_texts, by_id, frame, prose

from gridscout.llm import near_dedup as N
from gridscout.llm.components import components


def shingles(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = (text or "").translate(table).encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    comp = {i: i for i in texts}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(texts)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                comp[hi] = lo
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(df):
    return {i: (r.n_shingles, r.component_id, r.kept) for i, r in by_id(df).items()}


def edited(text, share, rng):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_awkward_rows(spark):
    assert found(N.near_duplicates(frame(spark, awkward_rows()))) == brute(awkward_texts())


def test_groups_of_near_copies(spark):
    """Chains and groups about the threshold: components need more than the first leader."""
    rng = random.Random(5)
    texts, n = {}, 0
    for group in range(6):
        base = prose(50 + group, 150, 5000)
        for _ in range(14):
            texts[n] = edited(base, 0.02 + 0.004 * group, rng)
            n += 1
    text = prose(99, 200, 5000)
    for _ in range(20):  # a chain, each a little further from the first
        texts[n] = text
        text = edited(text, 0.02, rng)
        n += 1
    expected = brute(texts)
    assert 20 < len({x[1] for x in expected.values()}) < n - 20
    assert found(N.near_duplicates(frame(spark, list(texts.items())))) == expected


def test_all_left_pairs_are_compared_without_star_rounds(spark, monkeypatch):
    monkeypatch.setattr(N, "STAR_ROUNDS", 0)
    rng = random.Random(6)
    texts = {i: edited(prose(i % 3, 100, 5000), 0.04, rng) for i in range(30)}
    assert found(N.near_duplicates(frame(spark, list(texts.items())))) == brute(texts)


def test_threshold_is_met_exactly(spark):
    w = [f"w{i}" for i in range(100)]
    a, b, c = " ".join(w[:74]), " ".join(w[:73] + ["q"] * 0), " ".join(w[:56])
    # 70 shingles against 52: 52 / 70 < 0.75; 70 against 69; and 3 of 4 exactly
    texts = {1: a, 2: b, 3: c, 4: " ".join(w[80:88]), 5: " ".join(w[80:87])}
    assert brute(texts)[5][1] == 4
    assert found(N.near_duplicates(frame(spark, list(texts.items())))) == brute(texts)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.sort(x[:2000]), np.sort(x[500:])
    s = N.signatures([a, b, np.zeros(0, np.uint64), a], 800)
    assert abs((s[:, 0] == s[:, 1]).mean() - 0.5) < 0.06  # 1500 / 3000
    assert (s[:, 0] == s[:, 3]).all() and (s[:, 2] == 0xFFFFFFFF).all()


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 150), (150, 129)] + [(7, 7), (5, 4)]
    links += [(a, b) for a, b in ((rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60))]
    comp = {x: x for p in links for x in p}
    for _ in range(200):
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.id: r.comp for r in components(df).collect()} == comp
    half = components(df.where("a < 150"))
    assert {r.id: r.comp for r in components(df.where("a >= 150"), half).collect()} == comp


def test_empty_tables(spark):
    assert N.near_duplicates(frame(spark, [])).collect() == []
    assert found(N.near_duplicates(frame(spark, [(1, None), (2, "")]))) == {1: (0, 1, True), 2: (0, 2, True)}
