from tests.llm.cases import awkward_rows, awkward_texts, by_id, frame, prose

from gridscout.llm.substring_dedup import substring_dedup


def brute(texts, window=20):
    seen, out = set(), {}
    for i in sorted(texts):
        words = (texts[i] or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            run = tuple(words[k : k + window])
            if run in seen:
                gone[k : k + window] = [True] * window
            seen.add(run)
        out[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


def found(df):
    return {i: (r.n_words, r.n_removed, r.kept) for i, r in by_id(df).items()}


def test_awkward_rows(spark):
    assert found(substring_dedup(frame(spark, awkward_rows()))) == brute(awkward_texts())


def test_same_result_whatever_the_sketch_and_groups(spark):
    texts = {i: f"{prose(i % 7, 60)} {prose(1000 + i, 50)}" for i in range(60)}
    docs = frame(spark, list(texts.items()))
    expected = brute(texts)
    assert sum(x[1] for x in expected.values()) > 1000
    assert found(substring_dedup(docs)) == expected
    assert found(substring_dedup(docs, sketch_bytes=1, group_bytes=1000)) == expected  # many groups


def test_a_passage_in_most_documents(spark, monkeypatch):
    monkeypatch.setattr("gridscout.llm.substring_dedup.FLUSH_WINDOWS", 500)
    shared = prose(1, 60)
    texts = {i: f"{prose(100 + i, 15)} {shared} {prose(900 + i, 15)}" for i in range(80)}
    assert found(substring_dedup(frame(spark, list(texts.items())))) == brute(texts)


def test_carried_columns_and_whole_text(spark):
    out = by_id(substring_dedup(frame(spark, [(1, "a  b"), (2, None)]), carry=("source", "n_chars"), whole=True))
    assert (out[1].text, out[1].kept, out[1].source, out[1].n_chars) == ("a  b", "a b", "s", None)
    assert out[2].text is None


def test_empty_table(spark):
    assert substring_dedup(frame(spark, [])).collect() == []
