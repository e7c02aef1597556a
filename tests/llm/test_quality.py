import numpy as np
from tests.llm.cases import awkward_rows, by_id, frame, prose

from gridscout.llm import quality as Q

SF_DIR = "/root/testdata/sf0.1"


def test_label_model_finds_the_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(40_000) < 0.8
    accuracy, coverage = np.array([0.95, 0.9, 0.8, 0.7, 0.6]), np.array([0.9, 0.5, 0.9, 0.7, 0.9])
    right = rng.random((len(truth), 5)) < accuracy
    votes = np.where(rng.random((len(truth), 5)) < coverage, np.where(right == truth[:, None], 2, 1), 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, table = Q.label_model(patterns, counts.astype(float))
    estimated = [(table[j, 1, 2] / table[j, 1, 1:].sum(), table[j, 0, 1] / table[j, 0, 1:].sum()) for j in range(5)]
    assert np.abs(np.array(estimated).mean(1) - accuracy).max() < 0.03
    by_pattern = {tuple(p): x for p, x in zip(patterns.tolist(), posterior)}
    guess = np.array([by_pattern[tuple(v)] for v in votes.tolist()])
    majority = (votes == 2).sum(1) >= (votes == 1).sum(1)
    assert ((guess > 0.5) == truth).mean() > (majority == truth).mean()


def test_features_by_plain_loops():
    texts = ["Hello, world! Hello", "", "A$$$ b%%% c", "UP UP\nUP UP\nlow.", "a | b | c", "é ü."]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    out = Q.features(data, offsets)
    assert np.isnan(out[1]).all()
    for i, text in enumerate(texts):
        w = text.encode().split()
        if not w:
            continue
        f = dict(zip(Q.FEATURES, out[i]))
        size = sum(map(len, w))
        symbol = lambda c: c < 128 and chr(c).isprintable() and not chr(c).isalnum() and c != 32
        assert f["symbols"] == sum(symbol(c) for x in w for c in x) / size
        assert f["odd_ends"] == sum(symbol(x[-1]) and chr(x[-1]) not in ".,!?;:\"')" for x in w) / len(w)
        assert f["lone_symbols"] == sum(len(x) == 1 and symbol(x[0]) for x in w) / len(w)
        assert f["repeated_words"] == 1 - len(set(w)) / len(w)
        assert f["mean_word"] == size / len(w)
        lines = [x for x in text.split("\n") if x.strip()]
        assert f["repeated_lines"] == 1 - len(set(lines)) / len(lines)


def test_awkward_rows(spark):
    out = by_id(Q.quality_scores(frame(spark, awkward_rows())))
    assert out.keys() == {0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 17, 2**40}
    for i in (2, 3, 4):
        assert (out[i].votes, out[i].posterior, out[i].score, out[i].keep) == ("-" * len(Q.LABELLERS), 0, 0, False)
    assert out[0][1:] == out[1][1:] == out[2**40][1:]
    assert all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in out.values())


def test_empty_tables(spark):
    assert Q.quality_scores(frame(spark, [])).collect() == []
    assert [r.score for r in Q.quality_scores(frame(spark, [(1, None), (2, " ")])).collect()] == [0, 0]


def test_a_text_scores_the_same_alone(spark):
    rows = [(i, prose(i, 60)) for i in range(40)] + [(100 + i, "BUY!! " * 50) for i in range(5)]
    a, b = by_id(Q.quality_scores(frame(spark, rows))), by_id(Q.quality_scores(frame(spark, rows[::-1])))
    assert {i: round(r.score, 9) for i, r in a.items()} == {i: round(r.score, 9) for i, r in b.items()}


def test_accuracy_on_hand_labels(spark):
    """The labels play no part in training."""
    out = Q.quality_scores(spark.read.parquet(f"{SF_DIR}/documents.parquet")).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id")
    r = out.selectExpr("avg(int(int(keep) = quality)) AS right", "sum(int(not keep and quality = 0)) / sum(1 - quality) AS bad_found", "sum(int(keep and quality = 1)) / sum(quality) AS good_kept").first()
    print(r)
    assert r.right > 0.9 and r.bad_found > 0.75 and r.good_kept > 0.95
