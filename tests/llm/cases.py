"""Tables with the awkward cases that every operator has to stand."""

from __future__ import annotations

import random

#: Extra columns whose names the operators use themselves.
CLASHING = ["_id", "_text", "id", "key", "n", "bands", "kept", "comp", "_held", "_letters", "length", "piece", "rank"]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_texts() -> dict[int, str | None]:
    """One text per id, after repeated rows have been settled."""
    base, other = prose(1, 90), prose(2, 120)
    words = base.split()
    return {
        0: base,
        1: base,
        2: None,
        3: "",
        4: " \t\n ",
        5: "...!? 123",
        6: " ".join(words[:40] + ["changed"] + words[41:]),
        7: other,
        8: "one two",
        9: "One Two",
        10: prose(3, 30_000, 3000),
        11: "x" * 50_000,
        12: f"{prose(4, 30)} {other} {prose(5, 30)}",
        13: "Été naïve 日本語 \U0001f600 İstanbul nbsp",
        14: "same same same " * 30,
        17: "the smaller text of a repeated id",
        2**40: base,
    }


def awkward_rows() -> list[tuple]:
    """(doc_id, text): the texts above, with repeated rows, a row without id and repeated ids."""
    rows = list(awkward_texts().items())
    rows += [(0, rows[0][1]), (2, None), (None, "no id"), (None, None), (17, "the smaller text of a repeated id, but longer"), (17, None)]
    random.Random(0).shuffle(rows)
    return rows


def frame(spark, rows, text: str = "string"):
    """documents with the given (doc_id, text) and columns with clashing names."""
    langs = ["en", "fr", None]
    full = [(i, t, langs[k % 3], "s", None, *[k] * len(CLASHING)) for k, (i, t) in enumerate(rows)]
    clashing = ", ".join(f"`{c}` int" for c in CLASHING)
    return spark.createDataFrame(full, f"doc_id long, text {text}, lang string, source string, n_chars long, {clashing}").repartition(3)


def by_id(df, key: str = "doc_id") -> dict:
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r for r in rows}
