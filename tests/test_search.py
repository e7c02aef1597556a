"""Index and search against a brute-force reading of the same rules."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridscout.operators import index as I
from gridscout.operators import search as S
from gridscout.operators.requests import parse_requests

FIELDS = {"title": "title", "body": "body"}
WEIGHTS = {"title": 3.0, "body": 1.0, "nothing": 9.0}
WORDS = [f"w{i}" for i in range(12)]


def corpus():
    rng = random.Random(11)
    rows = []
    for i in range(120):
        body = " ".join(rng.choices(WORDS, weights=[40, 20, 10, 5, 5, 4, 3, 2, 1, 1, 1, 1], k=rng.randrange(0, 90)))
        rows.append((i, rng.choice(WORDS), body, rng.choice([None, *range(-3, 40)]), rng.choice([0.0, 2.5, 33.0, float("nan")])))
    rows += [(200 + i, *rows[3][1:]) for i in range(60)]  # a third are copies of one document
    return rows


REQUESTS = {
    "text": "w1 W8 w1",
    "must": "w0 @title=w3_w4",
    "two musts": "@title=w0 @body=w9",
    "range": "w2 ^wins=3 $wins=20",
    "all": "w1 w5 @body=w2 ^wins=0.5 $some_percentage=10",
    "only ranges": "^wins=10 $wins=30",
    "only percentage": "$some_percentage=10",
    "negative": "^wins=-2 $wins=0",
    "unknown must": "w0 @nofield=w0",
    "unknown range": "w0 ^nofield=1",
    "text range": "w0 ^title=1",
    "bad bound": "w0 ^wins=abc",
    "no token": "!!",
    "empty": "",
    "missing": "zzz",
    "crossed": "^wins=9 $wins=3",
}


def brute(rows, requests, positive_percentages=False):
    terms = {(d, f): re.findall(r"\w+", text.lower()) for d, t, b, _, _ in rows for f, text in (("title", t), ("body", b))}
    numbers = {d: {k: v for k, v in (("wins", w), ("some_percentage", p)) if v is not None} for d, _, _, w, p in rows}
    n, total, df = Counter(), Counter(), Counter()
    for (d, f), ts in terms.items():
        if ts:
            n[f] += 1
            total[f] += len(ts)
            df.update((f, t) for t in set(ts))

    def bm25(d, f, t):
        ts = terms.get((d, f), [])
        if t not in ts:
            return 0.0
        idf = math.log(1 + (n[f] - df[f, t] + 0.5) / (df[f, t] + 0.5))
        tf = ts.count(t)
        return idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(ts) / (total[f] / n[f])))

    found = defaultdict(dict)
    for q, text in requests.items():
        must = re.findall(r"@(\w+)=(\w+)", text)
        bound = r"(-?\w+(?:\.\d+)?)"
        mins, maxs = re.findall(rf"\^(\w+)={bound}", text), re.findall(rf"\$(\w+)={bound}", text)
        free = text
        for p in (r"@\w+=\w+", r"\$\w+=-?\w+(?:\.\d+)?", r"\^\w+=-?\w+(?:\.\d+)?"):
            free = re.sub(p, "", free).strip()
        clauses = [[(f, t, w) for f, w in WEIGHTS.items() for t in re.findall(r"\w+", free.lower())]] if free else []
        clauses += [[(f, t, 1.0) for t in re.findall(r"\w+", v.replace("_", " ").lower())] for f, v in must]
        if not clauses and not mins and not maxs:
            continue
        for d in numbers:
            parts = [sum(w * bm25(d, f, t) for f, t, w in c) for c in clauses]
            ok = all(p > 0 for p in parts)
            for fields, holds in ((mins, lambda v, b, f: v >= b), (maxs, lambda v, b, f: v <= b and (not positive_percentages or "percentage" not in f or v > 0))):
                for f, b in fields:
                    try:
                        ok = ok and holds(numbers[d][f], float(b), f)
                    except (KeyError, ValueError):
                        ok = False
            if ok:
                found[q][d] = sum(parts) + len(mins) + len(maxs)
    return found


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    schema = "id long, title string, body string, wins int, some_percentage double"
    docs = spark.createDataFrame(corpus(), schema)
    I.write_index(docs, path, "id", FIELDS, ["wins", "some_percentage"], ["title"], buckets=5)
    return I.read_index(spark, path)


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame(list(REQUESTS.items()), "query_id string, q string")


def as_dict(hits):
    found = defaultdict(dict)
    for r in hits.collect():
        assert r.doc_id not in found[r.query_id]
        found[r.query_id][r.doc_id] = r.score
    return found


def same(got, wanted):
    assert {q for q in got if got[q]} == {q for q in wanted if wanted[q]}
    for q in wanted:
        assert got[q].keys() == wanted[q].keys(), q
        for d, score in wanted[q].items():
            assert got[q][d] == pytest.approx(score, abs=1e-7), (q, d)


@pytest.mark.parametrize("broadcast_rows", [S.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("options", [{}, {"positive_percentages": True}])
def test_matches_equal_brute_force(index, requests, monkeypatch, broadcast_rows, options):
    monkeypatch.setattr(S, "BROADCAST_ROWS", broadcast_rows)
    same(as_dict(S.matches(index, requests, WEIGHTS, **options)), brute(corpus(), REQUESTS, **options))


def test_many_clauses(spark, index):
    words = " ".join(["@body=w0", "@body=w1"] * 70)
    text = {"q": f"{words} w2", "r": words + " @body=zzz"}
    table = spark.createDataFrame(list(text.items()), "query_id string, q string")
    same(as_dict(S.matches(index, table, WEIGHTS)), brute(corpus(), text))


def test_top_k_is_a_prefix_of_the_ranking(index, requests):
    full = brute(corpus(), REQUESTS)
    ours = as_dict(S.matches(index, requests, WEIGHTS))
    got = defaultdict(dict)
    for r in S.search(index, requests, WEIGHTS, k=7).collect():
        got[r.query_id][r.rank] = r
        assert r.title is not None
    assert set(got) == {q for q in full if full[q]}
    for q, scores in ours.items():
        ranking = sorted(scores, key=lambda d: (-scores[d], d))[:7]
        assert [got[q][i + 1].doc_id for i in range(len(ranking))] == ranking


def test_one_request_equals_its_row_of_a_batch(index, requests):
    batch = {(r.query_id, r.rank): (r.doc_id, r.score) for r in S.search(index, requests, WEIGHTS).collect()}
    for q in ("text", "all", "only ranges", "empty"):
        alone = {r.rank: (r.doc_id, r.score) for r in S.search_one(index, REQUESTS[q], WEIGHTS).collect()}
        assert alone == {rank: hit for (name, rank), hit in batch.items() if name == q}


def test_total_hits(index, requests):
    wanted = brute(corpus(), REQUESTS)
    got = {r.query_id: r.n_hits for r in S.total_hits(S.matches(index, requests, WEIGHTS), requests).collect()}
    assert got == {q: len(wanted[q]) for q in REQUESTS}


def test_scores_do_not_depend_on_partitions(spark, index, requests):
    first = as_dict(S.matches(index, requests, WEIGHTS))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert as_dict(S.matches(index, requests, WEIGHTS)) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_index_tables_agree(index):
    by_doc = index.postings.groupBy("doc_id", "field").agg(F.sum("tf").alias("n"), F.first("length").alias("l"))
    assert by_doc.where("n <> l").count() == 0
    counted = index.postings.groupBy("term", "field").count()
    assert counted.join(index.term_stats, ["term", "field"]).where("count <> df").count() == 0
    assert index.docs.count() == 180


def test_small_k_of_one_hot_query_is_cut_before_the_last_shuffle(index, requests):
    plan = S.top_k(S.matches(index, requests, WEIGHTS), 3)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_search_reads_only_the_folders_of_its_terms(index):
    found = S.search_one(index, "w1 ^wins=1", WEIGHTS)
    plan = found._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    batch = S.search(index, S.request_table(index.docs.sparkSession, "w1"), WEIGHTS)
    assert "dynamicpruning" in batch._jdf.queryExecution().toString().lower()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_parse_requests(spark):
    texts = [
        " fast @team=Red_Bull car ^wins=12.5 $age=-3 @série=é_x ",
        "^wins=1 ^wins=2",
        "^a=x1",
        "a@b c$d e^f",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    rows = parse_requests(df).collect()
    assert rows[0].text == "fast  car"
    assert [tuple(m) for m in rows[0].must] == [("team", "Red Bull"), ("série", "é x")]
    assert [tuple(m) for m in rows[0].mins] == [("wins", 12.5)] and [tuple(m) for m in rows[0].maxs] == [("age", -3.0)]
    assert [m.bound for m in rows[1].mins] == [1.0, 2.0] and rows[1].text == ""
    assert rows[2].mins[0].bound is None and rows[3].text == "a@b c$d e^f"
    old = parse_requests(df, word_bounds=True).first()
    assert old.text == "fast  car .5 $age=-3" and old.mins[0].bound == 12.0 and old.maxs == []


def test_a_failed_rebuild_leaves_the_old_index(spark, tmp_path, monkeypatch):
    path, docs = str(tmp_path / "i"), spark.createDataFrame([(1, "old words")], "id long, text string")
    I.write_index(docs, path, "id", {"text": "text"})
    running = I.read_index(spark, path)
    new = spark.createDataFrame([(2, "new words here")], "id long, text string")
    with monkeypatch.context() as m:
        m.setattr(I, "term_stats", lambda rows: rows.select(F.raise_error(F.lit("lost")).alias("term")))
        with pytest.raises(Exception, match="lost"):
            I.write_index(new, path, "id", {"text": "text"})
    assert [r.term for r in I.read_index(spark, path).term_stats.orderBy("term").collect()] == ["old", "words"]
    I.write_index(new, path, "id", {"text": "text"})
    assert I.read_index(spark, path).postings.count() == 3
    assert running.postings.count() == 2  # a search that began before still finds its files


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line or "PushedFilters" in line]


def test_terms_ids_and_bounds_reach_the_scans(index):
    hits = S.matches(index, S.request_table(index.docs.sparkSession, "w1 w2 ^wins=3 $wins=7"), WEIGHTS)
    text = "\n".join(scans(hits))
    assert "In(term, [w1,w2])" in text
    assert "GreaterThanOrEqual(value,3.0)" in text and "LessThan" in text and "(field,wins)" in text
    found = "\n".join(scans(S.search_one(index, "w1", WEIGHTS, k=2)))
    assert "In(doc_id" in found or "EqualTo(doc_id" in found


@pytest.mark.parametrize("text", ["^wins=2 $wins=5", "^wins=2 ^wins=4 $some_percentage=50", "$wins=1 ^wins=9", "^wins=abc $wins=3", "w0 ^wins=2 $wins=abc", "w0 $some_percentage=40 ^wins=1"])
@pytest.mark.parametrize("positive", [False, True])
def test_ranges_of_one_request(spark, index, text, positive):
    got = as_dict(S.matches(index, spark.createDataFrame([("q", text)], "query_id string, q string"), WEIGHTS, positive_percentages=positive))
    same(got, brute(corpus(), {"q": text}, positive_percentages=positive))


def test_frequent_terms_are_sliced(spark, index, requests, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(S, "SLICE_DF", 3)
    same(as_dict(S.matches(index, requests, WEIGHTS)), brute(corpus(), REQUESTS))


def test_broadcasts_are_bounded_by_bytes(index, requests, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    same(as_dict(S.matches(index, requests, WEIGHTS)), brute(corpus(), REQUESTS))


def test_weights_are_checked(index, requests):
    with pytest.raises(ValueError):
        S.matches(index, requests, {"title": 1e9})


def rows_of(df, table_plan: str):
    return df._jdf.queryExecution().executedPlan().toString().count(table_plan)


@pytest.mark.parametrize("large", [False, True])
def test_top_k_by_bounds_gives_the_same_best(spark, index, monkeypatch, large):
    """Free text of frequent and rare words: the frequent ones are looked up for documents of the rare ones only."""
    monkeypatch.setattr(S, "PROBED", 0)
    texts = {"a": "w0 w1 w8", "b": "w0 w1 w2 w3 w10 w11", "c": "w9 w0", "d": "w0", "e": "w11 w11 w0 w1", "f": "zzz w0 w7", "g": "w10 w0 @body=w1", "h": "w11 w0 ^wins=1"}
    requests = spark.createDataFrame(list(texts.items()), "query_id string, q string")
    full = as_dict(S.matches(index, requests, WEIGHTS, large=large))
    same(full, brute(corpus(), texts))
    for k in (1, 3, 10):
        found = as_dict(S._matches(index, requests, WEIGHTS, large=large, k=k)[0])
        for q in texts:
            best = sorted(full[q].items(), key=lambda x: (-x[1], x[0]))[:k]
            assert [(d, found[q][d]) for d, _ in best] == best, (q, k)
            assert found[q].items() <= full[q].items()
    assert sum(map(len, as_dict(S._matches(index, requests, WEIGHTS, large=large, k=1)[0]).values())) < sum(map(len, full.values()))


def test_bounds_hold_for_every_posting(index):
    mean = index.field_stats.select("field", "mean_length")
    rows = index.postings.join(index.term_stats, ["term", "field"]).join(mean, "field")
    most = 1 / (1 + 1.2 * (0.25 / F.col("max_tf") + 0.75 * F.col("min_ratio") / F.col("mean_length")))
    own = F.col("tf") / (F.col("tf") + 1.2 * (0.25 + 0.75 * F.col("length") / F.col("mean_length")))
    assert rows.where(own > most + 1e-12).count() == 0
    assert index.term_stats.where("max_tf > 1").count() > 0


def test_the_rarest_clause_cuts_the_others(index):
    plan = S.matches(index, S.request_table(index.docs.sparkSession, "w0 w1 @body=w9"), WEIGHTS)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan  # the postings of w0 and w1 are filtered by the documents of w9


def test_a_clause_without_a_known_term_reads_nothing(index):
    hits = S.matches(index, S.request_table(index.docs.sparkSession, "w0 w1 @body=zzz"), WEIGHTS)
    assert "FileScan" not in hits._jdf.queryExecution().executedPlan().toString() and hits.collect() == []


def test_a_single_search_takes_few_jobs(spark, index):
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("count-jobs"))
    spark.sparkContext.setJobGroup("count-jobs", "")
    try:
        S.search_one(index, "w0 w1 w9 @title=w3 ^wins=1", WEIGHTS).collect()
        assert jobs() <= 16, jobs()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_batch_of_ranges_joins_no_documents(spark, index):
    texts = {"x": "^wins=2 $wins=20 $some_percentage=10", "y": "w1 ^wins=5 ^some_percentage=2", "z": "w2", "v": "^nofield=1 w0", "u": "^wins=1"}
    requests = spark.createDataFrame(list(texts.items()), "query_id string, q string")
    for large in (False, True):
        for positive in (False, True):
            hits = S.matches(index, requests, WEIGHTS, large=large, positive_percentages=positive)
            same(as_dict(hits), brute(corpus(), texts, positive_percentages=positive))
    plan = S.matches(index, requests, WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert "/docs]" not in plan and "In(field, [nofield,some_percentage,wins])" in plan


def test_many_requests_of_one_term_are_fanned_out_in_blocks(spark, index, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 4)
    monkeypatch.setattr(S, "SLICE_DF", 20)
    texts = {f"q{i}": f"w0 w{i % 12} @body=w1" for i in range(60)}
    requests = spark.createDataFrame(list(texts.items()), "query_id string, q string")
    same(as_dict(S.matches(index, requests, WEIGHTS, large=True)), brute(corpus(), texts))
