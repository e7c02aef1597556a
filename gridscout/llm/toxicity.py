"""Toxicity by maximum-scoring segments: passages whose words speak for toxic text more than chance allows.

1. A word's score is the log-odds of its rates in toxic and clean training documents, each under a
   two-cell Dirichlet prior (this word, all others) centred on the word's rate in all training documents,
   less a small cost per word. A document counts each of its words once. Words are told apart by hash, so
   the table has a fixed size.
2. A linear-time scan finds all maximal scoring segments of a document: no part of such a segment and no
   segment around it scores more.
3. The best segments of clean documents follow an extreme-value law, P(best > s) = 1 - exp(-K n exp(-c s))
   for n words. c and K are fitted by maximum likelihood; they give every segment its chance value, and a
   document that of its r best segments together. A logistic curve turns that into the score.

The documents that fit 3 are scored with the log-odds of the half they are not in; all others, and these in
the end, with the mean of both halves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import held_out, unique_texts

BITS = 20
PRIOR = 10.0  # documents that the prior of a word counts for
WORD_COST = 0.2
UNIT = 1000  # word scores are whole multiples of 1 / UNIT, so sums do not depend on their order
SIGNIFICANT = 0.01
TRAIN_DOCS = 40_000
COUNTS = ["c0", "t0", "c1", "t1", "every"]  # documents with a word: clean and toxic ones of either half, all training documents
SEGMENTS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("p_value", pa.float64())]))


def word_buckets(data: np.ndarray, offsets: np.ndarray, bits: int = BITS):
    """(bucket of each word, starts, ends, bounds): runs of letters, digits and non-ASCII, A-Z lower-cased."""
    lowered = W.LOWER[data]
    starts, ends, bounds = W.find_words(lowered, offsets, W.ALPHANUMERIC)
    return (W.mix(W.hash_words(lowered, starts, ends)) >> np.uint64(64 - bits)).astype(np.int64), starts, ends, bounds


def log_odds(clean: np.ndarray, toxic: np.ndarray, every: np.ndarray, prior: float = PRIOR, cost: float = WORD_COST) -> np.ndarray:
    """Score of each bucket in 1 / UNIT. A bucket without labelled words speaks for neither side."""
    rate = np.maximum(every, clean + toxic) / max(every.sum(), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        share = lambda n: (n + prior) / (n.sum() * rate + prior)
        score = np.where(clean + toxic > 0, np.log(share(toxic)) - np.log(share(clean)), 0.0)
    return np.clip(np.rint((score - cost) * UNIT), -32767, 32767).astype(np.int16)


def maximal_segments(before: list[int], after: list[int]) -> list[tuple[int, int, int]]:
    """(first run, last run, score) of the maximal scoring segments, in text order. `before` and `after`:
    the running sums before and after each run of positive scores.

    Each candidate keeps a link to the last one that begins at a smaller sum; candidates between them are
    passed over, so that every candidate is looked at a bounded number of times on average.
    """
    low: list[int] = []
    high: list[int] = []
    first: list[int] = []
    last: list[int] = []
    link: list[int] = []
    for k, (b, a) in enumerate(zip(before, after, strict=True)):
        begin = k
        j = len(low) - 1
        while True:
            while j >= 0 and low[j] >= b:
                j = link[j]
            if j < 0 or high[j] >= a:
                break
            b, begin = low[j], first[j]  # the new segment takes in all from j on
            del low[j:], high[j:], first[j:], last[j:]
            j = link[j]
            del link[len(low) :]
        low.append(b)
        high.append(a)
        first.append(begin)
        last.append(k)
        link.append(j)
    return [(f, e, h - s) for f, e, h, s in zip(first, last, high, low, strict=True)]


def segments(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, word after the last, score) of the maximal segments of a text's word scores."""
    positive = scores > 0
    if not positive.any():
        return (np.zeros(0, np.int64),) * 3
    edges = np.diff(np.concatenate([[False], positive, [False]]).astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.concatenate([[0], np.cumsum(scores, dtype=np.int64)])
    found = np.array(maximal_segments(sums[begins].tolist(), sums[ends].tolist()), np.int64)
    return begins[found[:, 0]], ends[found[:, 1]], found[:, 2]


@dataclass(frozen=True)
class Law:
    """Extreme-value law of the best segment of a clean document of n words."""

    rate: float
    k: float

    def normal(self, score: np.ndarray, n_words: int) -> np.ndarray:
        return self.rate * score - math.log(self.k * max(n_words, 1))

    def log_p(self, normal: float) -> float:
        """Log of the chance that the best segment is this good."""
        return -normal if normal > 30 else math.log(-math.expm1(-math.exp(-max(normal, -30.0))))

    def document(self, best: np.ndarray, n_words: int) -> float:
        """-log of the chance value of the document's segments: of the r best together, the r for which it is smallest."""
        if not len(best):
            return 0.0
        normal = self.normal(np.sort(best)[::-1], n_words)
        found, total = self.log_p(float(normal[0])), float(normal[0])
        for r, x in enumerate(normal[1:].tolist(), 2):
            total += x
            if x <= 0 or total <= r:  # more segments make it no smaller
                break
            found = min(found, -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r))
        return -found


def fit_law(best: np.ndarray, n_words: np.ndarray) -> Law:
    """Maximum likelihood for best segment scores of clean documents."""
    size = np.maximum(n_words, 1).astype(float)
    if not len(best) or best.max() <= 0:
        return Law(1.0, 1.0)

    def slope(rate: float) -> float:
        weight = size * np.exp(-rate * best)
        return 1 / rate - best.mean() + (best * weight).sum() / weight.sum()

    low, high = 0.02, 20.0
    for _ in range(60):
        middle = math.sqrt(low * high)
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    return Law(low, float(len(best) / (size * np.exp(-low * best)).sum()))


def fit_curve(x: np.ndarray, target: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """(intercept, slope) of a logistic curve by Newton steps."""
    design, w = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -40, 40)))
        gradient = design.T @ (p - target) + ridge * w
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), gradient)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-300))
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0]), float(w[1])


def curve(value: float | np.ndarray) -> float | np.ndarray:
    """The scale on which the logistic curve is fitted."""
    return np.log1p(value)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_docs: int = TRAIN_DOCS,
    significant: float = SIGNIFICANT,
) -> DataFrame:
    """(id, held_out, n_words, segments, score, predicted) per document.

    segments: every maximal segment whose chance value among the segments of a clean text of this length is
    at most `significant`, in text order: begin and end in code points, score, p_value. score: the chance
    that the document is toxic; predicted: 1 where it is at least 0.5.

    Labels teach only where `held_out` is false: those of the `train_docs` documents with the smallest id
    hashes, which bounds what is broadcast. Word rates come from all documents that are not held out. A
    label that is null or not 0 or 1 is none; a document with both labels has none. Without labels of both
    kinds every score is the share of toxic ones, 0 without any.

    A null, empty or wordless text has no segments and the score of a text without any. Equal texts have
    equal results but for `held_out`. Several rows of one id count as one, see `unique_texts`; rows without
    an id are left out. An empty table gives an empty table. Other columns of both tables play no part.
    No text is shuffled; a very long text is worked on alone.
    """
    rows = unique_texts(docs, id_col, text_col).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    held = held_out("_id", 5, 0)
    labelled = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_toxic")).where("_id IS NOT NULL AND _toxic IN (0, 1)")
    labelled = labelled.groupBy("_id").agg(F.min("_toxic").cast("int").alias("_toxic"), F.max("_toxic").cast("int").alias("_most"))
    mixed = F.xxhash64("_id")
    train = labelled.where((F.col("_toxic") == F.col("_most")) & ~held).orderBy(mixed, "_id").limit(train_docs)
    train = F.broadcast(train.select("_id", "_toxic", F.pmod(F.shiftright(mixed, 20), F.lit(2)).cast("int").alias("_half")))

    marked = rows.where(~held).join(train, "_id", "left").select("_text", "_toxic", "_half")
    counted = marked.mapInArrow(_counts, "bucket int, " + ", ".join(f"{c} long" for c in COUNTS))
    sums = counted.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in COUNTS]).toArrow()
    table = np.zeros((len(COUNTS), 1 << BITS), np.int64)
    for row, c in zip(table, COUNTS, strict=True):
        row[sums.column("bucket").to_numpy()] = sums.column(c).to_numpy()
    (c0, t0, c1, t1, every), spark = table, rows.sparkSession
    tables = log_odds(c1, t1, every), log_odds(c0, t0, every)
    halves = spark.sparkContext.broadcast(tables)
    sample = rows.join(train, "_id").select("_text", "_toxic", "_half")
    best = sample.mapInArrow(_best(halves), "toxic int, n_words long, best double").toArrow().sort_by([("n_words", "ascending"), ("best", "ascending")])
    toxic, size, most = (best.column(c).to_numpy() for c in best.column_names)
    law, line = Law(1.0, 1.0), None
    if len(toxic) and 0 < toxic.sum() < len(toxic):
        law = fit_law(most[toxic == 0], size[toxic == 0])
        values = sample.mapInArrow(_values(halves, law), "toxic int, value double").toArrow().sort_by([("toxic", "ascending"), ("value", "ascending")])
        line = fit_curve(curve(values.column("value").to_numpy()), values.column("toxic").to_numpy().astype(float))
    share = float(toxic.mean()) if len(toxic) else 0.0
    model = spark.sparkContext.broadcast(((tables[0].astype(np.int32) + tables[1]) // 2, law, line, share))
    schema = f"_id {kind}, n_words long, segments array<struct<begin: long, end: long, score: double, p_value: double>>, score double, predicted int"
    out = rows.mapInArrow(_scores(model, significant), schema)
    return out.select(F.col("_id").alias(id_col), held.alias("held_out"), "n_words", "segments", "score", "predicted")


def _counts(batches):
    """Documents by bucket; one row per bucket that has any in this task."""
    table = np.zeros((len(COUNTS), 1 << BITS), np.int64)
    for batch in batches:
        toxic = batch.column("_toxic").to_numpy(zero_copy_only=False)
        half = batch.column("_half").to_numpy(zero_copy_only=False)
        kind = np.where(np.isnan(toxic.astype(float)), -1, np.nan_to_num(toxic.astype(float)) + 2 * np.nan_to_num(half.astype(float))).astype(int)
        for lo, hi, data, offsets in W.sliced(batch.column("_text")):
            buckets, _, _, bounds = word_buckets(data, offsets)
            distinct = np.unique(W.row_of(bounds) << BITS | buckets)
            buckets, of_word = distinct & ((1 << BITS) - 1), kind[lo:hi][distinct >> BITS]
            np.add.at(table[4], buckets, 1)
            for i in range(4):
                np.add.at(table[i], buckets[of_word == i], 1)
    found = np.flatnonzero(table[4])
    for at in range(0, len(found), 1 << 16):
        some = found[at : at + (1 << 16)]
        yield pa.record_batch([pa.array(some.astype(np.int32)), *[pa.array(row[some]) for row in table]], ["bucket", *COUNTS])


def _per_text(batch, tables):
    """(place in the batch, segments, words' (starts, ends), bytes) of each text; `tables`: one for each row."""
    for lo, hi, data, offsets in W.sliced(batch.column("_text")):
        buckets, starts, ends, bounds = word_buckets(data, offsets)
        for i in range(hi - lo):
            own = slice(bounds[i], bounds[i + 1])
            yield lo + i, segments(tables(lo + i)[buckets[own]]), (starts[own] - offsets[i], ends[own] - offsets[i]), data[offsets[i] : offsets[i + 1]]


def _best(halves):
    def run(batches):
        for batch in batches:
            half = batch.column("_half").to_pylist()
            found = [(len(places[0]), (score.max() if len(score) else 0) / UNIT) for _, (_, _, score), places, _ in _per_text(batch, lambda i: halves.value[half[i]])]
            yield pa.record_batch([batch.column("_toxic"), pa.array([n for n, _ in found], pa.int64()), pa.array([b for _, b in found], pa.float64())], ["toxic", "n_words", "best"])

    return run


def _values(halves, law: Law):
    def run(batches):
        for batch in batches:
            half = batch.column("_half").to_pylist()
            found = [law.document(score / UNIT, len(places[0])) for _, (_, _, score), places, _ in _per_text(batch, lambda i: halves.value[half[i]])]
            yield pa.record_batch([batch.column("_toxic"), pa.array(found, pa.float64())], ["toxic", "value"])

    return run


def _scores(model, significant: float):
    def run(batches):
        table, law, line, share = model.value
        for batch in batches:
            n_words, spans, scores = [], [], []
            for _, (first, last, units), (starts, ends), data in _per_text(batch, lambda i: table):
                n = len(starts)
                p_value = -np.expm1(-np.exp(np.clip(-law.normal(units / UNIT, n), -700, 30))) if line else np.ones(len(units))
                kept = np.flatnonzero(p_value <= significant)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if len(kept) else None
                spans.append(
                    [
                        {"begin": int(chars[starts[first[j]]]), "end": int(chars[ends[last[j] - 1]]), "score": units[j] / UNIT, "p_value": float(p_value[j])}
                        for j in kept
                    ]
                )
                n_words.append(n)
                at = None if line is None else line[0] + line[1] * float(curve(law.document(units / UNIT, n)))
                scores.append(share if at is None else 1 / (1 + math.exp(-min(max(at, -40.0), 40.0))))
            columns = [batch.column("_id"), pa.array(n_words, pa.int64()), pa.array(spans, SEGMENTS), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.record_batch(columns, ["_id", "n_words", "segments", "score", "predicted"])

    return run
