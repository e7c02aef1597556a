import random
import zlib

import numpy as np
from tests.llm.cases import awkward_rows, by_id, frame

from gridscout.llm import language_id as L

SF_DIR = "/root/testdata/sf0.01"
EN = "the of and to in is that it was for on are with as his they be at one have this from".split()
FR = "le la les des et une est que dans qui pour pas sur plus avec être nous même où été".split()
ES = "el los las por una con para como pero más este entre cuando muy sin sobre también hasta hay donde".split()
PL = "nie się jest że jak ale czy już tylko przez był może tak jego bardzo które gdzie więc ponieważ dla".split()
DE = "der die und das nicht ist ein eine mit auf für sich auch werden über nach wird bei schön".split()


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1) for i, t, lang in rows], "doc_id long, text string, lang string, _held int")


def sentence(rng, *vocabularies, n=80):
    return " ".join(rng.choice(rng.choice(vocabularies)) for _ in range(n))


def training():
    rng = random.Random(0)
    return [(i, sentence(rng, v), lang) for i, (v, lang) in enumerate([(EN, "en"), (FR, "fr"), (DE, "de")] * 40)]


def test_languages_and_mixtures(spark):
    rng = random.Random(1)
    rows = training() + [(1000, sentence(rng, EN), None), (1001, sentence(rng, DE), "en"), (1002, sentence(rng, EN, EN, FR, n=300), None), (1003, sentence(rng, EN, FR, DE, n=600), None)]
    out = by_id(L.identify(docs(spark, rows)))
    truth = {i: lang for i, _, lang in training()}
    assert sum(out[i].lang_pred == lang for i, lang in truth.items()) == len(truth)
    assert out[1000].lang_pred == "en" and out[1000].langs == ["en"] and out[1000].score == 1
    assert out[1001].lang_pred == "de"
    assert set(out[1002].langs) == {"en", "fr"} and out[1002].lang_pred == "en" and abs(out[1002].score - 2 / 3) < 0.1
    assert set(out[1003].langs) == {"en", "fr", "de"} and all(abs(x - 1 / 3) < 0.1 for x in out[1003].shares)


def test_held_out_documents_teach_nothing(spark):
    rows = training()
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    changed = [(i, t, "xx" if i in held else lang) for i, t, lang in rows]
    a, b = by_id(L.identify(docs(spark, rows))), by_id(L.identify(docs(spark, changed)))
    assert {i for i, r in a.items() if r.held_out} == held and held
    assert a == b


def test_em_finds_the_shares():
    rng = np.random.default_rng(0)
    truth = np.array([0.5, 0.3, 0.2])
    words = rng.choice(3, 4000, p=truth)
    likelihood = np.where(np.arange(3) == words[:, None], 1.0, 0.05).astype(np.float32)
    rows = np.zeros(4000, int)
    shares, value = L.shares_of(likelihood, np.array([0]), rows, np.array([4000.0]), np.full((1, 3), 1 / 3, np.float32), 60)
    assert abs(shares[0] - truth).max() < 0.05
    # a grid search over the shares finds no better likelihood
    grid = [(a, b, 1 - a - b) for a in np.arange(0, 1.01, 0.02) for b in np.arange(0, 1.01 - a, 0.02)]
    assert value[0] >= max(np.log(np.maximum(likelihood @ np.array(s), 1e-30)).sum() for s in grid) - 0.5


def test_same_texts_alone_or_among_others(spark):
    text = "the of and это ещё"
    rows = training()
    a = by_id(L.identify(docs(spark, rows + [(2000, text, None)])))[2000]
    b = by_id(L.identify(docs(spark, rows + [(2000, text, None), (2001, "x " * 5000, None), (2002, text, None)])))
    assert (a.lang_pred, a.score) == (b[2000].lang_pred, b[2000].score) == (b[2002].lang_pred, b[2002].score)


def test_awkward_rows(spark):
    out = by_id(L.identify(frame(spark, awkward_rows()), carry=("source",)))
    assert {i for i, r in out.items() if r.lang_pred == "und"} == {2, 3, 4, 5}
    assert all(r.score == 0 and r.langs == [] for r in out.values() if r.lang_pred == "und")
    assert all(0 < r.score <= 1 for r in out.values() if r.lang_pred != "und") and out[0].source == "s"


def test_nothing_to_learn_from(spark):
    assert L.identify(frame(spark, [])).collect() == []
    (row,) = L.identify(docs(spark, [(1, "some text", None)])).collect()
    assert (row.lang_pred, row.score) == ("und", 0)


def test_held_out_accuracy(spark):
    out = L.identify(spark.read.parquet(f"{SF_DIR}/documents.parquet"), carry=("lang",))
    right, n = out.where("held_out").selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert n > 200 and right / n > 0.97


def test_mixtures_of_more_than_three_languages(spark):
    rng = random.Random(2)
    vocabularies = [EN, FR, DE, ES, PL]
    names = ["en", "fr", "de", "es", "pl"]
    rows = [(i, sentence(rng, v), lang) for i, (v, lang) in enumerate(list(zip(vocabularies, names, strict=True)) * 40)]
    rows += [(1000, sentence(rng, *vocabularies[:4], n=1200), None), (1001, sentence(rng, *vocabularies, n=1500), None), (1002, sentence(rng, EN, n=1200), None)]
    out = by_id(L.identify(docs(spark, rows)))
    assert set(out[1000].langs) == set(names[:4]) and all(abs(x - 1 / 4) < 0.08 for x in out[1000].shares) and out[1000].score < 0.33
    assert set(out[1001].langs) == set(names) and all(abs(x - 1 / 5) < 0.08 for x in out[1001].shares)
    assert out[1002].langs == ["en"]


def test_no_set_is_left_out():
    """The sizes that are skipped hold nothing better than the set chosen."""
    rng = np.random.default_rng(1)
    for n_langs in (2, 5, 8):
        lengths = rng.integers(1, 300, 40)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        likelihood = rng.random((bounds[-1], n_langs)).astype(np.float32) ** 4
        likelihood /= likelihood.max(1, keepdims=True)
        base = np.zeros((len(likelihood), 1), np.float32)
        every = L.highest
        found = L.mixtures(likelihood, base, bounds, 1.0)
        try:
            L.highest = lambda *a: np.full(len(lengths), np.inf)
            assert (L.mixtures(likelihood, base, bounds, 1.0) == found).all()
        finally:
            L.highest = every
