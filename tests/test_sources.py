"""Reading pages and dumps from files, TSV round trips, staged tables."""

import pytest
from pyspark.sql import functions as F

from gridscout.plans import queries as Q
from gridscout.sources import pages as P
from gridscout.sources import tables as T
from gridscout.sources.pages import pack_pages, read_packed, read_pages, write_pages
from gridscout.sources.wiki import malformed_count, pages_from_xml_column, read_wiki_xml, wiki_pages


def test_read_pages_keeps_whole_files(spark, tmp_path):
    for name, text in {"com_drivers_a.html": "x\ny\n", "com_teams_b.html": "z"}.items():
        (tmp_path / "sub").mkdir(exist_ok=True)
        (tmp_path / "sub" / name).write_text(text)
    rows = {r.filename.rsplit("/", 1)[1]: r.content for r in read_pages(spark, str(tmp_path)).collect()}
    assert rows == {"com_drivers_a.html": "x\ny\n", "com_teams_b.html": "z"}
    only = read_pages(spark, str(tmp_path), "com_drivers").collect()
    assert len(only) == 1 and only[0].filename.startswith("file:/")


RECORDS = [
    "<page><title>A</title><ns>0</ns><id>1</id><revision><text bytes='5'>'''A''' &amp; b\nx</text></revision></page>",
    "<page><title>R</title><id>2</id><redirect title='A'/><revision><text>#R</text></revision></page>",
    "<page><title>N</title><id>3</id></page>",
    "<page><title>Two</title><id>4</id><revision><text>one</text></revision><revision><text>two</text></revision></page>",
    "<page><title>Empty</title><id>5</id><revision><text/></revision></page>",
    "<page><id>6</id></page>",
]
PAGES = {
    (1, "A", False, None, "'''A''' & b\nx"),
    (2, "R", True, "A", "#R"),
    (3, "N", False, None, None),
    (4, "Two", False, None, "one"),
}


def test_wiki_xml_from_column(spark):
    df = spark.createDataFrame([("\n".join(RECORDS) + "<page><title>open",)], "xml string")
    nested = pages_from_xml_column(df, "xml")
    assert {tuple(r) for r in wiki_pages(nested).where("id < 5").collect()} == PAGES
    assert wiki_pages(nested).count() == 5
    assert malformed_count(nested).first().n_malformed == 1


def test_wiki_xml_from_files_over_many_splits(spark, tmp_path):
    path = tmp_path / "dump.xml"
    filler = "word " * 400
    pages = [
        f"  <page>\n<title>T{i}</title>\n<id>{i}</id>\n<revision>\n<text bytes=\"1\">{i} {filler}\n</text></revision>\n</page>"
        for i in range(300)
    ]
    pages.insert(7, "<page><title>not closed</title><id>998</id>")
    pages.append("<page><title>cut off</title><id>999</id>")
    path.write_text("<mediawiki>\n" + "\n".join(pages))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        nested = read_wiki_xml(spark, str(path))
        assert nested.rdd.getNumPartitions() > 5
        rows = wiki_pages(nested).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.id for r in rows) == list(range(300))
    assert all(r.text == f"{r.id} {filler}".strip() for r in rows)


def test_tsv_round_trip(spark, tmp_path):
    rows = [("1", 'say "hi"\tyou', "007"), ("2", "", "5"), ("3", "back\\slash \"q", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    for single in (False, True):
        path = str(tmp_path / f"t{single}")
        T.write_tsv(df, path, single_file=single)
        back = T.read_tsv(spark, path, df.schema, defaults="")
        assert sorted(tuple(r) for r in back.collect()) == rows
    assert len(list((tmp_path / "tTrue").glob("part-*"))) == 1


def test_columns_or_defaults(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    assert T.with_columns_or(df, {"a": "", "b": "0", "c": "0"}).first().asDict() == {"a": "x", "b": "0", "c": "0"}


def test_materialize_builds_once_and_not_from_a_broken_write(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "m")
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "part-0.parquet").write_text("left by a lost job")
    assert T.materialize(spark, path, build).count() == 3
    assert T.materialize(spark, path, build).count() == 3
    assert len(calls) == 1


def test_work_dir_is_the_one_the_session_names(spark):
    assert T.work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert "stage-" in T.stage(spark.range(2)).inputFiles()[0]


@pytest.mark.parametrize("rows", [0, 5])
def test_stage_keeps_schema(spark, rows):
    df = spark.range(rows).withColumn("s", F.lit("x"))
    assert T.stage(df).dtypes == df.dtypes


def test_tsv_keeps_line_ends_blanks_quotes_and_backslashes(spark, tmp_path):
    texts = ["a\nb", "\r\n", "  lead", "trail ", '"quoted"', 'in"side', "back\\", "\\n", "\\\\n", "\\\n", "tab\there", "'", "x\\ty", "é\u2028z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    T.write_tsv(df, str(tmp_path / "t"))
    back = T.read_tsv(spark, str(tmp_path / "t"), df.schema)
    assert [r.t for r in back.orderBy("i").collect()] == texts


def test_packed_pages_follow_their_files(spark, tmp_path):
    folder, archive = tmp_path / "pages", str(tmp_path / "archive")
    (folder / "deep").mkdir(parents=True)
    texts = {f"com_drivers_{i}": f"page {i}\r\n\u00e9\n" for i in range(12)} | {"deep/other": " ", "deep/com_drivers_x": "x"}
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())

    def packed(mark=None):
        return {r.filename.split("/pages/")[1]: r.content for r in read_packed(spark, archive, mark).collect()}

    where = f"file://{folder}"
    assert pack_pages(spark, where, archive) == 14 and packed() == texts
    assert packed("com_drivers").keys() == {x for x in texts if "com_drivers" in x}
    assert {r.filename: r.content for r in read_packed(spark, archive).collect()}.keys() == {r.filename for r in read_pages(spark, where).collect()}
    assert pack_pages(spark, where, archive) == 0
    texts |= {"com_drivers_3": "changed, and longer", "new": "n"}
    for name in ("com_drivers_3", "new"):
        (folder / name).write_bytes(texts[name].encode())
    assert pack_pages(spark, where, archive) == 2 and packed() == texts
    assert read_packed(spark, archive).rdd.getNumPartitions() < 14  # by bytes, not by page


def test_page_files_are_those_of_the_text_writer(spark, tmp_path, monkeypatch):
    rows = [(f"com_drivers_{i}", f"<p>{i}\n\u00e9</p>") for i in range(50)]
    rows += [("none", None), (None, "no name"), ("twice", "same"), ("twice", "same"), ("a:b/c%d =[x]{y}^'\"#?*\\z\u00e9", "odd"), ("nul", "in\0side")]
    pages = spark.createDataFrame(rows, "name string, html string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # the same name in several batches
    try:
        for folder in ("by_python", "again", "again"):
            write_pages(pages, f"file://{tmp_path}/{folder}", 3)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    with monkeypatch.context() as m:
        m.setattr(P, "local_path", lambda *_: None)
        write_pages(pages, f"file://{tmp_path}/by_spark", 3)

    def written(folder):
        return {(f.parent.name, f.name.split("-")[1]): f.read_bytes() for f in (tmp_path / folder).glob("*/part-*")}

    assert written("by_python") == written("by_spark") == written("again")
    assert len(written("by_python")) == 55
    assert not [*(tmp_path / "again").glob("*/.*")]
    assert (tmp_path / "by_python" / "_SUCCESS").exists()
    write_pages(pages.where("false"), f"{tmp_path}/empty", 1)
    assert read_pages(spark, f"{tmp_path}/empty").count() == 0 == pack_pages(spark, f"{tmp_path}/empty", f"{tmp_path}/no-archive")
    assert not (tmp_path / "no-archive").exists()


def test_small_files_are_packed_together_and_read_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "PACKED_FILES", 30)
    folder, archive = tmp_path / "pages", str(tmp_path / "archive")
    folder.mkdir()
    texts = {f"p{i}": f"page {i}" for i in range(60)}
    for name, text in texts.items():
        (folder / name).write_text(text)
    packed = lambda: {r.filename.rsplit("/", 1)[1]: r.content for r in read_packed(spark, archive).collect()}
    plan = lambda: read_packed(spark, archive)._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a scan task for each file
    try:
        assert pack_pages(spark, str(folder), archive) == 60 and packed() == texts
        assert len([*(tmp_path / "archive").glob("part-*")]) == 2
        assert "Exchange" not in plan() and "Join" not in plan()
        for name in ("p1", "new"):
            texts[name] = "another text"
            (folder / name).write_text(texts[name])
        assert pack_pages(spark, str(folder), archive) == 2 and packed() == texts
        assert "BroadcastHashJoin" in plan() and "SortMergeJoin" not in plan()
        monkeypatch.setattr(P, "BROADCAST_FILES", 0)
        monkeypatch.setattr(P, "PUSHED_FILES", 0)
        for name in ("p1", "p2"):
            texts[name] = "a third, longer text"
            (folder / name).write_text(texts[name])
        assert pack_pages(spark, str(folder), archive) == 2 and packed() == texts
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_page_files_are_listed_once_to_be_packed(spark, tmp_path, monkeypatch):
    rows = [(i, f"<p>{i}</p>" if i % 9 else None) for i in range(40)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    listed = []
    reader = type(spark.read)
    for kind in ("load", "text"):
        read = getattr(reader, kind)
        monkeypatch.setattr(reader, kind, lambda self, path, *a, read=read, **b: (listed.append(path), read(self, path, *a, **b))[1])
    packed = Q.pages_packed(spark, str(tmp_path))
    assert len([x for x in listed if "page-files" in x]) == 1
    assert sorted(packed.collect()) == sorted((f"com_drivers_{i}", html or "") for i, html in rows if i % 4)
