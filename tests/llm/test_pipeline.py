"""The pipeline against a brute-force version of its stages."""

import re

import corpus_pipeline as C
from tests.llm.cases import awkward_rows, frame
from tests.llm.test_decontamination import brute as decontaminated
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_packing import check_sequences, pieces_of
from tests.llm.test_substring_dedup import brute as cut

from gridscout.llm.common import documents

SF_DIR = "/root/testdata/sf0.001"


def expected(texts, items):
    """Stage by stage: the texts that each keeps. Language ID keeps what has a letter."""
    texts = {i: t for i, t in texts.items() if t and re.search(r"[^\W\d_]", t)}
    stages = [texts]
    kept = near(texts)
    stages.append({i: t for i, t in texts.items() if kept[i][2]})
    cuts = cut(stages[-1])
    stages.append({i: cuts[i][2] if cuts[i][1] else t for i, t in stages[-1].items()})
    bad = decontaminated(stages[-1], items)
    stages.append({i: t for i, t in stages[-1].items() if not bad[i][3]})
    return stages


def test_stages_on_the_smallest_tables(spark):
    docs = documents(spark, SF_DIR)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    stages = expected({r.doc_id: r.text for r in docs.collect()}, items)
    folder = spark.conf.get("spark.checkpoint.dir")
    for (name, step), texts in zip(C.STAGES, stages, strict=False):
        out = step(spark, docs, SF_DIR)
        assert out.columns == C.COLUMNS, name
        path = f"{folder}/pipeline-{name.replace(' ', '-')}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        assert {r.doc_id: r.text for r in docs.collect()} == texts, name
        assert docs.count() == len(texts)
    assert docs.where("n_chars <> length(text)").count() == 0
    rows = C.run(spark, SF_DIR).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == pieces_of(stages[-1], 2048)
    check_sequences(rows, 2048)


def test_stages_stand_awkward_rows_and_empty_tables(spark):
    for rows in (awkward_rows(), []):
        docs = frame(spark, rows)
        for _, step in C.STAGES:
            out = step(spark, docs, SF_DIR)
            assert len(out.collect()) == 0 or rows
        assert C.STAGES[0][1](spark, docs, SF_DIR).count() == (13 if rows else 0)
