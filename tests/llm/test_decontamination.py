import random
import re

import numpy as np
from tests.llm.cases import awkward_rows, awkward_texts, by_id, frame, prose

from gridscout.llm import words as W
from gridscout.llm.decontamination import Windows, decontaminate, merged

REAL = W.hash_runs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(texts, items):
    windows = set()
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        if n and item is not None:
            windows |= {(str(item), tuple(w[i : i + n])) for i in range(len(w) - n + 1)}
    out = {}
    for i, text in texts.items():
        w, hit, found = words(text), set(), set()
        for item, run in windows:
            for k in range(len(w) - len(run) + 1):
                if tuple(w[k : k + len(run)]) == run:
                    hit |= set(range(k, k + len(run)))
                    found.add(item)
        out[i] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(items)], "item_id long, text string, words int")


def found(df):
    return {i: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for i, r in by_id(df).items()}


ITEMS = [(1, prose(7, 30)), (2, "One TWO!"), (10, prose(1, 90)), (10, "a second text of an item"), (3, None), (4, ""), (5, "?!"), (None, "same same"), (6, prose(7, 30)), (7, prose(3, 14, 3000)), (8, "café 日本語")]


def test_awkward_rows(spark):
    assert found(decontaminate(frame(spark, awkward_rows()), benchmark(spark, ITEMS))) == brute(awkward_texts(), ITEMS)


def test_random_passages(spark):
    rng = random.Random(1)
    items = [(i, prose(500 + i, rng.choice([1, 2, 3, 12, 13, 14, 30]), 60)) for i in range(40)]
    texts = {}
    for i in range(80):
        own = prose(i, rng.randrange(0, 150), 60).split()
        at = rng.randrange(len(own) + 1)
        texts[i] = ", ".join(own[:at]) + " " + items[i % 40][1].upper().replace(" ", " - ") + " " + " ".join(own[at:])
    assert found(decontaminate(frame(spark, list(texts.items())), benchmark(spark, items))) == brute(texts, items)


def test_spans_are_cut_from_the_text(spark):
    passage = prose(7, 30)
    docs = frame(spark, [(1, f"Café, first {passage.upper()} last."), (2, "clean"), (3, None)])
    out = by_id(decontaminate(docs, benchmark(spark, [(1, passage)]), carry=("text", "source"), cleaned=True))
    assert out[1].cleaned == "Café, first  last." and out[1].contaminated and out[1].source == "s"
    assert len(out[1].spans) == 1
    assert (out[2].cleaned, out[2].spans) == ("clean", [])
    assert out[3].cleaned == ""


def test_empty_tables(spark):
    assert decontaminate(frame(spark, []), benchmark(spark, ITEMS)).collect() == []
    assert found(decontaminate(frame(spark, [(1, "a b")]), benchmark(spark, []))) == {1: (2, 0, [], False)}


def test_a_large_benchmark_is_scanned_in_parts(spark):
    docs = frame(spark, awkward_rows())
    out = decontaminate(docs, benchmark(spark, ITEMS), most_bytes=3_000, carry=("text",), cleaned=True)
    assert found(out) == brute(awkward_texts(), ITEMS)
    whole = by_id(decontaminate(docs, benchmark(spark, ITEMS), carry=("text",), cleaned=True))
    assert {i: (r.spans, r.cleaned, r.text) for i, r in by_id(out).items()} == {i: (r.spans, r.cleaned, r.text) for i, r in whole.items()}


def test_items_of_any_length_are_cut_into_stretches(spark):
    long = prose(77, 4000, 900)
    items = [*ITEMS, (20, long), (20, long), (21, "again and " * 300), (22, prose(3, 30_000, 3000))]
    texts = awkward_texts() | {30: " ".join(long.split()[995:1030]), 31: long, 32: "so again and again and again and again and again and again and again and again", 33: " ".join(long.split()[3990:])}
    expected = {i: r for i, r in brute_by_set(texts, items).items()}
    for stretch in (1, 7, 1000):
        out = decontaminate(frame(spark, list(texts.items())), benchmark(spark, items), most_bytes=10_000_000, stretch=stretch)
        assert found(out) == expected
    assert found(decontaminate(frame(spark, list(texts.items())), benchmark(spark, items), most_bytes=600_000, stretch=500)) == expected


def brute_by_set(texts, items):
    """`brute` with the windows in a dictionary, for long items."""
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        if n and item is not None:
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = {}
    for i, text in texts.items():
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    names |= own
        out[i] = (len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_windows_are_compact():
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200_000))
    found = Windows([("item", text), ("other", "a b c")], 13)
    assert found.nbytes < 60 * 200_000 + 2 * (1 << 22) and set(found.sizes) == {3, 13}
    short = Windows([("a", "x y"), ("b", "x y"), ("b", "x y"), ("c", "y x")], 13)
    at = [int(np.searchsorted(short.sizes[2][0], h)) for h in short.sizes[2][0]]
    assert sorted([short.names[i] for i in own] for j in at for t in (b"x y", b"y x") if (own := short.found(2, j, t)) is not None) == [["a", "b"], ["c"]]


def test_hashes_that_collide_are_compared(monkeypatch):
    monkeypatch.setattr(W, "hash_runs", lambda hashes, n, way=0: np.zeros(max(len(hashes) - n + 1, 0), np.uint64) if way == 0 else REAL(hashes, n, way))
    known = Windows([("a", "x y"), ("b", "z y"), ("c", "x y")], 13)
    assert [known.names[i] for i in known.found(2, 0, b"z y")] == ["b"] and [known.names[i] for i in known.found(2, 0, b"x y")] == ["a", "c"]
    assert known.found(2, 0, b"q q") is None


def test_stretches_are_merged():
    hit = lambda a, b: {"first": a, "last": b, "start": 10 * a, "end": 10 * b}
    assert merged([hit(5, 8), hit(0, 2), hit(2, 3), hit(6, 7), hit(9, 10)]) == [hit(0, 3), hit(5, 8), hit(9, 10)]
