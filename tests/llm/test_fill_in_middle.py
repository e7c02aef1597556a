import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.cases import awkward_rows, awkward_texts, by_id, frame, prose

from gridscout.llm import fill_in_middle as M


def brute(doc_id: int, text: str | None, rate: int = 100, spm_rate: int = 50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:lo], units[lo:hi], units[hi:]))
    if h4 % 100 < spm_rate:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(spark, rows, **parameters):
    out = M.fill_in_middle(frame(spark, rows), **parameters).withColumn("restored", M.restored(F.col("output"), F.col("form")))
    out = by_id(out)
    expected = {i: t for i, t in rows if i is not None}
    assert out.keys() == expected.keys()
    for i, text in expected.items():
        assert tuple(out[i])[1:6] == brute(i, text, **parameters), i
        assert out[i].restored == (text or "")
    return out


def test_awkward_rows(spark):
    texts = awkward_texts()
    out = by_id(M.fill_in_middle(frame(spark, awkward_rows())))
    assert out.keys() == texts.keys()
    for i, text in texts.items():
        assert tuple(out[i])[1:] == brute(i, text), i


def test_lines_markers_and_forms_by_brute_force(spark):
    rng = random.Random(5)
    texts = ["\n", "\n\n", "a\n", "a\nb", "\na", "x<P>y", "a\n<M>", "<S", "<P\n>", "<<P", "a<\nP>\nb<", "é\n日本\n\U0001f600", "\r\n\r\n", "a\r\nb c\x85d\x0b\x0ce\n"]
    texts += ["".join(rng.choice(["\n", "a", "é", "日", "\U0001f600", "<", "P", ">", "<S", " "]) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    texts += ["\n".join(prose(k * 100 + j, rng.randrange(0, 40)) for j in range(rng.randrange(1, 60))) + "\n" * (k % 2) for k in range(60)]
    out = check(spark, list(enumerate(texts)))
    assert {"plain", "psm", "spm"} == {r.form for r in out.values()}
    check(spark, list(enumerate(texts)), rate=40, spm_rate=90)


def test_long_and_shared_texts(spark):
    long = "\n".join(prose(k, 25) for k in range(3000))
    check(spark, [(1, long), (2, long[1000:]), (3, "head\n" + long), (4, "x" * 200_000), (5, "\n" * 100_000), (6, "日" * 50_000 + "\n")])


def test_marker_across_chunk_boundaries():
    for cut in range(1, 3):
        cache = M.SummaryCache((b"<P>", b"<S>", b"<M>"))
        raw = b"a" * 50 + b"<S>" + b"b" * 50
        saved, M.chunk_ends = M.chunk_ends, lambda data, cut=cut: np.array([50 + cut, len(data)])
        try:
            assert M.Text(np.frombuffer(raw, np.uint8), raw, cache).marked
        finally:
            M.chunk_ends = saved
    saved, M.chunk_ends = M.chunk_ends, lambda data: np.arange(1, len(data) + 1)
    try:  # chunks of one byte
        cache = M.SummaryCache((b"<P>", b"<S>", b"<M>"))
        for raw, marked in ((b"a<P>b", True), (b"a<Pb>", False), (b"<<S>", True), (b"<", False)):
            assert M.Text(np.frombuffer(raw, np.uint8), raw, cache).marked == marked
        text = M.Text(np.frombuffer("é\na\n日".encode(), np.uint8), "é\na\n日".encode(), cache)
        assert [text.after(i) for i in range(4)] == [(0, 0), (3, 2), (5, 4), (8, 5)]
    finally:
        M.chunk_ends = saved


def test_shared_passages_share_chunks_and_hits_are_verified():
    passage = " ".join(prose(k, 40) for k in range(200)).encode()
    ends = [M.chunk_ends(np.frombuffer(t, np.uint8)) for t in (passage, b"another beginning " + passage)]
    assert len(ends[0]) > 10 and set((ends[0] + 18).tolist()) >= set(ends[1][ends[1] > 18 + M.WINDOW].tolist()) and len(ends[1]) >= len(ends[0])
    cache = M.SummaryCache((b"<P>", b"<S>", b"<M>"))
    for text in (passage, b"another beginning " + passage):
        M.Text(np.frombuffer(text, np.uint8), text, cache)
    assert cache.hits >= len(ends[0]) - 1
    chunk = b"one\ntwo"
    cache.kept[M.xxhash.xxh3_64_intdigest(chunk)] = (b"other", M.summarise(b"other", cache.markers))
    assert cache.get(chunk).ends.tolist() == [4]  # not the summary of a chunk with the same hash


def test_the_cache_is_bounded():
    cache = M.SummaryCache((b"<P>",), most_bytes=10_000)
    for k in range(1000):
        cache.get(b"chunk %d" % k)
    assert cache.bytes <= 10_000 and len(cache.kept) < 20


def test_empty_table_and_markers(spark):
    assert M.fill_in_middle(frame(spark, [])).collect() == []
    for bad in (("", "a", "b"), ("<P", "<P>", "<M>"), ("aa", "b", "c"), ("<a<", "b", "c"), ("x", "x", "y")):
        with pytest.raises(ValueError):
            M.fill_in_middle(frame(spark, []), markers=bad)
    out = M.fill_in_middle(frame(spark, [(1, "a.*b\nc\nd")]), markers=("[pre]", "{suf}", "(mid)"))
    assert out.select(M.restored(F.col("output"), F.col("form"), ("[pre]", "{suf}", "(mid)"))).first()[0] == "a.*b\nc\nd"
