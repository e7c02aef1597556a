import math
import random

import numpy as np
from tests.llm.cases import awkward_rows, by_id, frame, prose

from gridscout.llm import toxicity as T

SF_DIR = "/root/testdata/sf0.1"


def brute_segments(x: list[int]) -> list[tuple[int, int, int]]:
    """All maximal segments by definition: take the best one (of equals the shortest, first), then the same left and right of it."""

    def within(a: int, b: int) -> list:
        best = None
        for i in range(a, b):
            total = 0
            for j in range(i, b):
                total += x[j]
                if total > 0 and (best is None or (total, -(j + 1 - i), -i) > best[0]):
                    best = ((total, -(j + 1 - i), -i), i, j + 1)
        if best is None:
            return []
        (total, *_), i, j = best
        return [*within(a, i), (i, j, total), *within(j, b)]

    return within(0, len(x))


def found_segments(x: list[int]) -> list[tuple[int, int, int]]:
    return list(zip(*(a.tolist() for a in T.segments(np.array(x, np.int64))), strict=True))


def test_segments_by_definition():
    rng = random.Random(2)
    for _ in range(1500):
        x = [rng.choice([-7, -3, -2, -1, 1, 2, 3, 5, 11]) * 1000 + rng.randrange(500) for _ in range(rng.randrange(0, 26))]
        assert found_segments(x) == brute_segments(x), x
    assert found_segments([-1, -2]) == [] and found_segments([]) == []
    assert found_segments([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5]) == [(0, 1, 4), (2, 3, 3), (4, 11, 7)]


def test_the_scan_is_linear():
    seen = []

    class Counted(int):
        def __ge__(self, other):
            seen.append(1)
            return int(self) >= int(other)

    rng = random.Random(1)
    for falling in (1, -1, 0):
        seen.clear()
        total, before, after = 0, [], []
        for _ in range(20_000):
            before.append(Counted(total))
            total += rng.randrange(1, 100)
            after.append(Counted(total))
            total -= rng.randrange(1, 100) + falling * 30
        T.maximal_segments(before, after)
        assert len(seen) < 5 * 20_000


def test_log_odds_by_plain_arithmetic():
    clean, toxic, every = np.array([90, 1, 0, 0, 3]), np.array([10, 30, 0, 0, 0]), np.array([200, 40, 5, 0, 3])
    got = T.log_odds(clean, toxic, every, prior=10, cost=0.2)
    for i in range(5):
        expected = 0.0
        if clean[i] + toxic[i]:
            p = every[i] / 248
            expected = math.log((toxic[i] + 10) / (40 * p + 10)) - math.log((clean[i] + 10) / (94 * p + 10))
        assert got[i] == round((expected - 0.2) * 1000)


def test_law_and_document_value():
    rng = np.random.default_rng(3)
    size = rng.integers(10, 5000, 30_000)
    best = (np.log(0.02 * size) - np.log(-np.log(rng.random(len(size))))) / 0.7
    law = T.fit_law(best, size)
    assert abs(law.rate - 0.7) < 0.01 and abs(law.k / 0.02 - 1) < 0.1
    chance = np.array([math.exp(law.log_p(float(law.normal(b, n)))) for b, n in zip(best, size)])
    for share in (0.01, 0.1, 0.5):
        assert abs((chance <= share).mean() - share) < 0.01
    assert law.document(np.zeros(0), 100) == 0
    one, five = law.document(np.array([20.0]), 100), law.document(np.array([20.0] * 5), 100)
    assert 0 < one < five and law.document(np.array([20.0]), 10_000) < one


def test_curve():
    rng = np.random.default_rng(4)
    x = rng.random(50_000) * 6
    y = (rng.random(len(x)) < 1 / (1 + np.exp(4 - 2 * x))).astype(float)
    a, b = T.fit_curve(x, y)
    assert abs(a + 4) < 0.15 and abs(b - 2) < 0.08
    assert T.fit_curve(x, (x > 3).astype(float))[1] > 5  # kinds apart: finite


def labelled_rows():
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        w = prose(i, rng.randrange(20, 200)).split()
        if i % 4 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["Vile!", "FOUL", "rotten###"]))
        rows.append((1000 + i, " ".join(w)))
        labels.append((1000 + i, int(i % 4 == 0)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame([(i, t, 1, 2, 3) for i, t in labels], "doc_id long, toxic int, _id int, text int, quality int")


def test_awkward_rows(spark):
    rows, labels = labelled_rows()
    labels += [(1, None), (None, 1), (6, 0), (6, 1), (7, 0), (7, 0), (99, 1), (12, 5)]
    passage = "日本 été " + "vile foul rotten vile foul rotten " * 3
    out = by_id(T.toxicity(frame(spark, awkward_rows() + rows + [(50, passage), (51, passage), (52, "vile " * 40_000)]), label_frame(spark, labels)))
    assert out.keys() >= {0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 17, 50, 51, 52, 2**40} and len(out) == 420
    empty = {(r.n_words, r.score, r.predicted, len(r.segments)) for i, r in out.items() if i in (2, 3, 4)}
    assert len(empty) == 1 and next(iter(empty))[0] == 0 and next(iter(empty))[1:] == (out[3].score, 0, 0)
    assert out[0][2:] == out[1][2:] == out[2**40][2:]
    (segment,) = out[50].segments
    assert passage[segment.begin : segment.end] == passage[7:].strip() and segment.p_value < 0.01
    assert out[50].predicted == out[51].predicted == out[52].predicted == 1 and out[50].score == out[51].score
    for i, r in out.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    found = sum(r.predicted for i, r in out.items() if i >= 1000 and i % 4 == 0)  # of 100
    assert found >= 95, found
    assert sum(r.predicted for i, r in out.items() if i >= 1000 and i % 4) < 10


def test_held_out_labels_teach_nothing(spark):
    import zlib

    rows, labels = labelled_rows()
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    a = by_id(T.toxicity(frame(spark, rows), label_frame(spark, labels)))
    b = by_id(T.toxicity(frame(spark, rows[::-1]), label_frame(spark, [(i, 1 - t if held(i) else t) for i, t in labels])))
    assert a == b and {i for i, r in a.items() if r.held_out} == {i for i, _ in rows if held(i)}


def test_empty_tables_and_labels_of_one_kind(spark):
    assert T.toxicity(frame(spark, []), label_frame(spark, [])).collect() == []
    rows, labels = labelled_rows()
    assert {r.score for r in T.toxicity(frame(spark, rows[:20]), label_frame(spark, [])).collect()} == {0.0}
    assert {(r.score, r.predicted) for r in T.toxicity(frame(spark, rows[:20]), label_frame(spark, [(i, 1) for i, _ in labels])).collect()} == {(1.0, 1)}


def test_accuracy_on_held_out_labels(spark):
    """Some 40 % of the labels 1 are on texts without any sign of it; the others are all found."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = T.toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").where("held_out")
    r = out.selectExpr("avg(int(predicted = toxic)) AS right", "sum(predicted * toxic) / sum(predicted) AS precise", "sum(predicted * toxic) / sum(toxic) AS found").first()
    print(r)
    assert r.right > 0.94 and r.precise > 0.9 and r.found > 0.5
