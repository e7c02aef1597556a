"""Steps whose work must not grow faster than their input."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from gridscout.operators import cells as C
from gridscout.operators import index as I
from gridscout.operators import search as S
from gridscout.plans import fixtures as fx
from gridscout.plans import queries as Q

FIELDS, WEIGHTS = {"title": "title", "body": "body"}, {"title": 3.0, "body": 1.0}
WORDS = [f"w{i}" for i in range(30)]


def rows_of(n):
    rng = random.Random(5)
    return [(i // 3 if i < 30 else i, rng.choice(WORDS), " ".join(rng.choices(WORDS[:12], k=rng.randrange(0, 20)))) for i in range(n)]  # some ids repeat


def built(spark, path, rows):
    I.write_index(spark.createDataFrame(rows, "id long, title string, body string"), path, "id", FIELDS, [], ["title"])
    return I.read_index(spark, path)


def test_free_text_of_many_requests_is_ranked_without_a_shuffle_of_hits(spark, tmp_path, monkeypatch):
    index = built(spark, str(tmp_path / "i"), rows_of(150))
    asked = [(i, t) for i, t in enumerate(["w1 w2 w1", "w0", "w20 w21", "none", "", "w3 w4 w5 w6 w7", "W8"])]
    requests = spark.createDataFrame(asked, "query_id long, q string")
    best = lambda large: sorted(S.search(index, requests, WEIGHTS, k=4, large=large).select("query_id", "rank", "doc_id", "score").collect())
    expected = best(False)
    assert {r.query_id for r in expected} == {0, 1, 2, 5, 6}
    monkeypatch.setattr(S, "_posting_scores", lambda *_: 1 / 0)
    assert best(True) == expected
    monkeypatch.setattr(C, "CELL_POSTINGS", 40)
    monkeypatch.setattr(C, "CELL_TERMS", 5)
    assert best(True) == expected


def test_terms_that_add_nothing_still_match(spark, tmp_path):
    index = built(spark, str(tmp_path / "i"), rows_of(40))
    requests = spark.createDataFrame([(1, "w1"), (2, "w2 @body=w1")], "query_id long, q string")
    best = lambda large: sorted(S.search(index, requests, {"title": 0.0, "body": 0.0}, k=3, large=large).select("query_id", "rank", "doc_id", "score").collect())
    assert best(True) == best(False) and best(True)


def test_forward_is_not_sorted_by_document_again(spark, tmp_path):
    rows = rows_of(60)
    built(spark, str(tmp_path / "i"), rows)
    assert not list(Path(tmp_path / "i/v000000001/forward").glob("bucket=*"))
    docs = spark.createDataFrame(rows, "id long, title string, body string")
    expected = I.field_terms(docs, "id", FIELDS).orderBy("doc_id", "field", F.col("terms").cast("string")).collect()
    kept = spark.read.parquet(str(tmp_path / "i/v000000001/forward")).drop("_file")
    assert kept.orderBy("doc_id", "field", F.col("terms").cast("string")).collect() == expected


def test_customers_are_dealt_to_tasks_by_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "TASK_CUSTOMERS", 10)
    customers = [(i, f"C{i}", 0, 1.0, "BUILDING") for i in range(100)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "FRANCE", 3)], "n_nationkey int, n_name string, n_regionkey int").coalesce(1).write.parquet(f"{tmp_path}/nation.parquet")
    pages = fx.pages(spark, str(tmp_path))
    assert pages.count() == 100
    assert pages.rdd.getNumPartitions() == 10


def test_page_files_are_dealt_to_tasks_by_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "TASK_FILES", 5)
    rows = [(i, f"<p>{i}</p>") for i in range(40)]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    read = Q.pages_files(spark, str(tmp_path))
    assert sorted(read.collect()) == sorted((f"com_drivers_{i}", html) for i, html in rows if i % 4)
    files = Path(Q._shared(spark, str(tmp_path), "page-files")).glob("name=*/part-*")
    assert len({f.name.split("-")[1] for f in files}) > 4  # tasks that wrote
