"""Files to hits, and extraction on a stream."""

import pytest

from gridscout import pipeline
from gridscout.operators.index import read_index
from gridscout.operators.profiles import extract_profiles
from gridscout.schemas import ENRICHED_COLUMNS
from gridscout.sources.tables import folders, work_dir

PAGE = """<html><title>Driver: {name} | Driver Database</title><script>x</script>
<div>nationality</div>
<div>Finnish</div>
<div>a</div></div><div class="s">Formula 3</div>
</div><h2>Driver Stats</h2><div>wins</div><div>{wins}</div><p>{body}</p></html>"""
DUMP = """<mediawiki><page>
<title>Formula 3</title><id>1</id><revision><text bytes="1">'''Formula 3''' is a series.
More</text></revision></page>
<page><title>Ann Lee</title><id>2</id><redirect title="Ann B. Lee" /><revision><text>#R</text></revision></page>
<page><title>Ann B. Lee</title><id>3</id><revision><text>| team = [[Red]]
'''Ann''' is a racing driver &amp; more.
x</text></revision></page>
<page><title>Red</title><id>4</id><revision><text>'''Red''' is a team.
x</text></revision></page></mediawiki>"""


def test_files_to_hits(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    people = [("Ann Lee", 3, "gravel gravel"), ("Bob Fox", 0, "gravel"), ("Cy Day", 9, "ice don't")]
    for i, (name, wins, body) in enumerate(people):
        (pages / f"com_drivers_{i}.html").write_text(PAGE.format(name=name, wins=wins, body=body))
    (pages / "com_teams_1.html").write_text(PAGE.format(name="No", wins=1, body="gravel"))
    (tmp_path / "dump.xml").write_text(DUMP)
    out = str(tmp_path / "out")
    staged = set(folders(spark, work_dir(spark)))
    enriched = pipeline.parse_and_enrich(spark, str(pages), str(tmp_path / "dump.xml"), out)
    assert set(folders(spark, work_dir(spark))) == staged  # nothing is left behind
    with pytest.raises(ValueError, match="made from"):
        pipeline.parse_and_enrich(spark, str(pages), str(tmp_path / "other.xml"), out)
    assert enriched.columns == ENRICHED_COLUMNS
    rows = {r.name: r for r in enriched.collect()}
    assert set(rows) == {"Ann Lee", "Bob Fox", "Cy Day"}
    ann = rows["Ann Lee"]
    assert ann.series_description == "'''Formula 3''' is a series."
    assert (ann.current_team, ann.team_description) == ("Red", "'''Red''' is a team.")
    assert ann.bio == "'''Ann''' is a racing driver & more." and rows["Bob Fox"].bio == ""
    pipeline.build_index(spark, str(pages), out, buckets=3)
    stored = read_index(spark, f"{out}/index").docs
    assert {r.name: list(r.bad_columns) for r in stored.collect()} == {"Ann Lee": [], "Bob Fox": [], "Cy Day": []}

    def names(request):
        return [r.name for r in pipeline.search_index(spark, out, request).orderBy("rank").collect()]

    assert names("gravel") == ["Ann Lee", "Bob Fox"]
    assert names("gravel @driver_name=fox") == ["Bob Fox"]
    assert names("formula ^wins=3 $wins=5") == ["Ann Lee"]
    assert names("@current_team=red_blue") == ["Ann Lee"]
    assert sorted(names("^wins=1")) == ["Ann Lee", "Cy Day"]
    assert names("@wins=3") == [] and names("") == []
    assert names("don't") == ["Cy Day"] and names("don") == []

    more = tmp_path / "more"
    more.mkdir()
    (more / "com_drivers_9.html").write_text(PAGE.format(name="Di Roe", wins=5, body="gravel don't"))
    pipeline.add_pages(spark, str(more), out)
    assert sorted(names("gravel")) == ["Ann Lee", "Bob Fox", "Di Roe"] and sorted(names("don't")) == ["Cy Day", "Di Roe"]
    assert names("formula ^wins=4 $wins=6") == ["Di Roe"] and sorted(names("^wins=1")) == ["Ann Lee", "Cy Day", "Di Roe"]
    (more / "com_drivers_9.html").write_text(PAGE.format(name="Di Roe", wins=6, body="ice"))
    pipeline.add_pages(spark, str(more), out)
    assert sorted(names("gravel")) == ["Ann Lee", "Bob Fox"] and sorted(names("ice")) == ["Cy Day", "Di Roe"]
    assert set(folders(spark, work_dir(spark))) == staged


def test_extraction_runs_on_a_stream(spark, tmp_path):
    pages = [(f"file:/com_drivers_{i}.html", PAGE.format(name=f"N{i}", wins=i, body="")) for i in range(4)]
    df = spark.createDataFrame(pages, "filename string, content string")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        extract_profiles(stream)
        .writeStream.format("memory")
        .queryName("profiles_out")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .start()
    )
    query.processAllAvailable()
    query.stop()
    got = spark.table("profiles_out")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, extract_profiles(df).collect()))
