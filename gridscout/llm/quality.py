"""Quality classifier without hand labels: heuristic labellers, a label model, a hashed linear scorer.

1. Labellers vote good, bad or nothing on each document. Only the count of each combination of votes is
   needed from the corpus, at most 3 ** labellers rows.
2. Expectation-maximisation over these counts estimates how often each labeller votes what on good and
   on bad documents, and with that the posterior of every combination.
3. The posteriors of `train_docs` documents, those with the smallest id hashes, train a logistic scorer
   on hashed byte trigrams and word shapes. That sample is the only thing that is bounded; votes,
   posteriors and scores cover all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import unique_texts

TRAIN_DOCS = 6_000
HASH_BITS = 12
ROUNDS = 100
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = _UPPER.copy()
_LETTER[0x61:0x7B] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,!?;:\"')"]] = True

#: (name, feature, good below, bad from): a document is voted good below, bad at or above.
LABELLERS = [
    ("symbol_share", "symbols", 0.05, 0.10),
    ("upper_share", "upper", 0.06, 0.30),
    ("odd_word_ends", "odd_ends", 0.02, 0.20),
    ("symbol_words", "lone_symbols", 0.01, 0.05),
    ("repeated_lines", "repeated_lines", 0.05, 0.30),
    ("repeated_words", "repeated_words", 0.35, 0.60),
    ("long_words", "mean_word", 5.6, 6.5),
    ("open_lines", "open_lines", 0.10, 0.50),
]
FEATURES = [feature for _, feature, _, _ in LABELLERS]


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x FEATURES; a row without words has nan."""
    starts, ends, bounds = W.find_words(data, offsets)
    n_words = np.diff(bounds).astype(float)

    def per_row(mask: np.ndarray, places: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[places]).astype(float)

    size = per_row(W.NON_SPACE[data], offsets)
    last = data[ends - 1]
    repeated_words, repeated_lines, open_lines = (np.full(len(n_words), np.nan) for _ in range(3))
    hashes = W.hash_words(data, starts, ends)
    for i in np.flatnonzero(n_words):
        repeated_words[i] = 1 - len(np.unique(hashes[bounds[i] : bounds[i + 1]])) / n_words[i]
        lines = [x for x in data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n") if x.strip()]
        repeated_lines[i] = 1 - len(set(lines)) / len(lines)
        open_lines[i] = sum(x.rstrip()[-1:] not in b".!?" for x in lines) / len(lines)
    with np.errstate(invalid="ignore", divide="ignore"):
        columns = {
            "symbols": per_row(_SYMBOL[data], offsets) / size,
            "upper": np.nan_to_num(per_row(_UPPER[data], offsets) / per_row(_LETTER[data], offsets)),
            "odd_ends": per_row(_SYMBOL[last] & ~_STOP[last], bounds) / n_words,
            "lone_symbols": per_row(_SYMBOL[last] & (ends - starts == 1), bounds) / n_words,
            "repeated_lines": repeated_lines,
            "repeated_words": repeated_words,
            "mean_word": size / n_words,
            "open_lines": open_lines,
        }
    out = np.stack([columns[f] for f in FEATURES], 1)
    out[n_words == 0] = np.nan
    return out


def votes(values: np.ndarray) -> np.ndarray:
    """rows x labellers: 0 no vote, 1 bad, 2 good."""
    good, bad = (np.array([x[i] for x in LABELLERS]) for i in (2, 3))
    out = np.zeros(values.shape, np.int8)
    out[values < good] = 2
    out[values >= bad] = 1
    return out


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """EM: (posterior of good for each combination of votes, labellers x [bad, good] x votes)."""
    bad, good = (patterns == 1).sum(1), (patterns == 2).sum(1)
    posterior = (good + 1.0) / (good + 3.0 * bad + 2.0)
    table = np.zeros((patterns.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack([1 - posterior, posterior]) * counts
        for vote in range(3):
            table[:, :, vote] = ((weight[:, :, None] * (patterns == vote)).sum(1) + 1).T
        table /= table.sum(2, keepdims=True)
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        logs = np.log(prior) + sum(np.log(table[j][:, patterns[:, j]]).T for j in range(patterns.shape[1]))
        posterior = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return posterior, table


def hashed(data: np.ndarray, offsets: np.ndarray, bits: int = HASH_BITS) -> np.ndarray:
    """rows x 2 ** bits: damped counts of byte trigrams and word shapes, each row of length 1."""
    n = len(offsets) - 1
    starts, ends, bounds = W.find_words(data, offsets)
    out = np.zeros((n, 1 << bits), np.float32)
    if not len(starts):
        return out
    kind = np.full(256, 3, np.uint32)
    kind[_LETTER], kind[_UPPER], kind[_SYMBOL], kind[0x80:] = 0, 1, 2, 0
    shape = kind[data[starts]] << np.uint32(16) | kind[data[ends - 1]] << np.uint32(8) | np.minimum(ends - starts, 15).astype(np.uint32)
    left, right = np.empty_like(data), np.empty_like(data)
    left[1:], right[:-1] = data[:-1], data[1:]
    left[starts], right[ends - 1] = 0x20, 0x20
    inside = W.NON_SPACE[data]
    gram = (left.astype(np.uint32) << np.uint32(16) | data.astype(np.uint32) << np.uint32(8) | right)[inside]
    row_of_byte = np.repeat(np.arange(n), np.diff(offsets))[inside]
    for code, rows in ((gram, row_of_byte), (shape | np.uint32(1 << 24), W.row_of(bounds))):
        place = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
        out += np.bincount(rows * (1 << bits) + place, minlength=out.size).reshape(out.shape)
    out = np.log1p(out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def fit_scorer(x: np.ndarray, target: np.ndarray, rounds: int = 300, rate: float = 0.2, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression by Adam on soft targets: weights, the last one the bias."""
    w, m, s = (np.zeros(x.shape[1] + 1) for _ in range(3))
    for step in range(1, rounds + 1):
        # products in the precision of x, which would be copied otherwise
        error = 1 / (1 + np.exp(-np.clip((x @ w[:-1].astype(x.dtype)).astype(float) + w[-1], -50, 50))) - target
        gradient = np.append((x.T @ error.astype(x.dtype)).astype(float) / len(x) + decay * w[:-1], error.mean())
        m, s = 0.9 * m + 0.1 * gradient, 0.99 * s + 0.01 * gradient**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return w


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, threshold: float = 0.5) -> DataFrame:
    """(id, votes, posterior, score, keep) per document.

    votes: one of g, b and - for each of LABELLERS. posterior: of good, by the label model. score: by the
    linear scorer. keep: score >= `threshold`.

    A null, empty or blank text gets no votes, posterior and score 0 and is not kept. Equal texts have
    equal results. Several rows of one id count as one, see `unique_texts`; rows without an id are left
    out. An empty table, or one without words, teaches nothing: all scores are 0. Other columns of
    `docs` play no part, whatever they are called.
    """
    rows = unique_texts(docs, id_col, text_col).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    counted = rows.select("_text").mapInArrow(_vote_counts, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    posterior: dict[str, float] = {}
    weights = np.zeros((1 << HASH_BITS) + 1)
    if counted:
        counted.sort(key=lambda r: r.votes)
        patterns = np.array([["-bg".index(c) for c in r.votes] for r in counted])
        found, _ = label_model(patterns, np.array([r.n for r in counted], float))
        posterior = {r.votes: float(p) for r, p in zip(counted, found, strict=True)}
        chosen = rows.select("_id").orderBy(F.xxhash64("_id"), "_id").limit(train_docs)
        sample = rows.join(chosen, "_id", "left_semi").mapInArrow(_sample, f"_id {kind}, votes string, places binary, values binary").collect()
        sample.sort(key=lambda r: r._id)
        x = np.zeros((len(sample), 1 << HASH_BITS), np.float32)
        for i, r in enumerate(sample):
            x[i, np.frombuffer(bytes(r.places), np.uint16)] = np.frombuffer(bytes(r.values), np.float32)
        weights = fit_scorer(x, np.array([posterior[r.votes] for r in sample]))
    shared = rows.sparkSession.sparkContext.broadcast((posterior, weights))
    return rows.mapInArrow(_scores(shared, threshold), f"_id {kind}, votes string, posterior double, score double, keep boolean").withColumnRenamed("_id", id_col)


def _voted(data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(votes as text, whether the row has words)."""
    values = features(data, offsets)
    return ["".join("-bg"[v] for v in row) for row in votes(values)], ~np.isnan(values[:, 0])


def _vote_counts(batches):
    counts: dict[str, int] = {}
    for batch in batches:
        for _, _, data, offsets in W.sliced(batch.column("_text")):
            for text, ok in zip(*_voted(data, offsets), strict=True):
                if ok:
                    counts[text] = counts.get(text, 0) + 1
    if counts:
        yield pa.record_batch([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["votes", "n"])


def _sample(batches):
    for batch in batches:
        for lo, hi, data, offsets in W.sliced(batch.column("_text")):
            text, ok = _voted(data, offsets)
            x = hashed(data, offsets)
            rows = np.flatnonzero(ok)
            places = [np.flatnonzero(x[i]) for i in rows]
            columns = [batch.column("_id").slice(lo, hi - lo).take(pa.array(rows)), pa.array([text[i] for i in rows], pa.string())]
            columns += [W.binary([p.astype(np.uint16) for p in places]), W.binary([x[i, p] for i, p in zip(rows, places, strict=True)])]
            yield pa.record_batch(columns, ["_id", "votes", "places", "values"])


def _scores(shared, threshold: float):
    def run(batches):
        posterior, weights = shared.value
        for batch in batches:
            for lo, hi, data, offsets in W.sliced(batch.column("_text")):
                text, ok = _voted(data, offsets)
                score = np.zeros(hi - lo)
                for a in range(0, hi - lo, 256):
                    b = min(a + 256, hi - lo)
                    x = hashed(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    score[a:b] = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -50, 50)))
                score[~ok] = 0
                known = [posterior.get(t, 0.0) if o else 0.0 for t, o in zip(text, ok, strict=True)]
                columns = [batch.column("_id").slice(lo, hi - lo), pa.array(text, pa.string()), pa.array(known, pa.float64()), pa.array(score), pa.array(score >= threshold) if threshold > 0 else pa.array(ok)]
                yield pa.record_batch(columns, ["_id", "votes", "posterior", "score", "keep"])

    return run
