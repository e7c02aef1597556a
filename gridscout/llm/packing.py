"""Packing of tokenised documents into sequences: vector best-fit over the counts of piece lengths.

Tokens, documents and attention cost (the sum of squared lengths) of a sequence are each limited. All
three of a piece follow from its length, so what is packed are counts by length: one row for each
length up to the capacity, however many documents there are. The plan made from them is a list of
patterns ("this many sequences with these lengths"). Pieces get their place by their rank among
those of their length; ranks are counted in parts, so a length that a third of all pieces have is no
single group.
"""

from __future__ import annotations

import zlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import partitions, stage, unique_texts
from gridscout.llm.word_ids import word_ids

CAPACITY = 2048
PIECES = "piece int, start long, length long, ids_crc32 long"


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    most_docs: int | None = None,
    most_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001),
    score: str = "norm",
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) per piece of a document.

    A document is its ids by the tokenizer file (see `WordIds`), then id 0. Documents of more than `capacity` ids, and
    no others, are cut into pieces of `capacity`, the last one shorter. `start`: ids of the document
    before the piece. `ids_crc32`: of the ids as unsigned 32-bit little-endian numbers. With
    `with_ids` the ids themselves too, packed like that.

    No sequence holds more than `capacity` tokens, `most_docs` pieces, or `most_cost` as the sum of
    squared lengths; where these are not given they are as large as `capacity` allows at all. `score`
    "norm" takes what leaves the smallest weighted residual norm, "dot" the piece with the largest
    weighted dot product with the residual. Pieces stand in a sequence without gaps.

    A null or empty text is id 0 alone. Pieces of equal length are ranked by hash of the id, then the
    id, so the same table gives the same result. Several rows of one id count as one, see
    `unique_texts`; rows without an id are left out. An empty table gives an empty table. Other columns
    of `docs` play no part, whatever they are called.
    """
    rows = unique_texts(docs, id_col, text_col).withColumnsRenamed({id_col: "_id", text_col: "_text"})
    types = f"_id {rows.schema['_id'].dataType.simpleString()}, {PIECES}" + ", ids binary" * with_ids
    pieces = stage(rows.mapInArrow(_pieces(tokenizer, capacity, with_ids), types))
    parts = partitions(docs.sparkSession)
    pieces = pieces.withColumn("_part", F.pmod(F.xxhash64("_id", "piece"), F.lit(parts)))
    counts = stage(pieces.groupBy("length", "_part").agg(F.count("*").alias("n")))
    lengths = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(Plan(lengths, capacity, most_docs or capacity, most_cost or capacity**2, weights, score))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_part").orderBy("_id", "piece")
    ranked = pieces.join(firsts, ["length", "_part"]).withColumn("_rank", F.col("_first") + F.row_number().over(within) - 1)
    names = [x.split()[0] for x in types.split(", ")]
    out = ranked.select(*names, "_rank").mapInArrow(_places(plan, names), types + ", sequence_id long, offset long")
    return out.withColumnRenamed("_id", id_col)


# -- pieces


def _pieces(tokenizer: str, capacity: int, with_ids: bool):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in W.sliced(batch.column("_text")):
                ids, bounds = word_ids(tokenizer).of(data, offsets)
                rows = []
                for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    text = ids[a:b].tobytes() + b"\0\0\0\0"
                    for piece, at in enumerate(range(0, len(text), 4 * capacity)):
                        own = text[at : at + 4 * capacity]
                        rows.append((row, piece, at // 4, len(own) // 4, zlib.crc32(own), own if with_ids else None))
                of, *columns = zip(*rows, strict=True)
                columns = [batch.column("_id").slice(lo, hi - lo).take(pa.array(of)), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:4]), pa.array(columns[4], pa.binary())]
                names = ["_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = len(names) - (not with_ids)
                yield pa.record_batch(columns[:n], names[:n])

    return run


# -- plan


class Plan:
    """Patterns for counts by length, as arrays to look up a piece's place by (length, rank)."""

    def __init__(self, lengths: dict[int, int], capacity: int, most_docs: int, most_cost: int, weights, score: str) -> None:
        if lengths and max(lengths) ** 2 > most_cost:
            raise ValueError("a single piece is over most_cost")
        self.caps = (capacity, most_docs, most_cost)
        self.weights = np.array(weights)
        self.score = score
        left = np.zeros(capacity + 1, np.int64)
        for length, n in lengths.items():
            left[length] = n
        used = np.zeros(capacity + 1, np.int64)
        keys, rows, self.sequences = [], [], 0
        while left.any():
            found = self._pattern(left)
            n = min(int(left[x]) // k for x, k in found.items())
            offset = 0
            for x, k in found.items():
                keys.append((x << 44) + int(used[x]))
                rows.append((int(used[x]), k, self.sequences, offset))
                used[x] += n * k
                left[x] -= n * k
                offset += x * k
            self.sequences += n
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.rows = np.array(rows, np.int64).reshape(-1, 4)[order]

    def _pattern(self, left: np.ndarray) -> dict[int, int]:
        """One sequence: the longest piece, then again and again the best one or two that fit."""
        left = left.copy()
        room = np.array(self.caps, np.int64)
        found: dict[int, int] = {}

        def put(length: int) -> None:
            found[length] = found.get(length, 0) + 1
            left[length] -= 1
            room[:] -= (length, 1, length * length)

        put(int(np.flatnonzero(left)[-1]))
        while some := self._best(left, room):
            for length in some:
                put(length)
        return found

    def _best(self, left: np.ndarray, room: np.ndarray) -> tuple[int, ...]:
        most = min(int(room[0]), isqrt(int(room[2]))) if room[1] > 0 else 0
        fits = np.flatnonzero(left[: most + 1])
        if not len(fits):
            return ()
        caps = np.array(self.caps, float)
        if self.score == "dot":
            items = np.stack([fits, np.ones_like(fits), fits * fits], 1) / caps
            return (int(fits[np.argmax(items @ (self.weights * (room / caps)))]),)
        one = int(fits[-1])
        if one == room[0] or room[1] < 2:
            return (one,)
        # for each first piece the longest second one that the room then left allows
        second = np.minimum(room[0] - fits, np.sqrt(np.maximum(room[2] - fits * fits, 0)).astype(np.int64))
        place = np.searchsorted(fits, np.minimum(second, fits), "right") - 1
        ok = place >= 0
        first, second = fits[ok], fits[place[ok]]
        same = (first == second) & (left[first] < 2)
        lower = np.searchsorted(fits, second[same]) - 1
        second[same] = np.where(lower >= 0, fits[np.maximum(lower, 0)], 0)
        first, second = np.append(first, one), np.append(second, 0)
        rest = np.stack([room[0] - first - second, room[1] - 1 - (second > 0), room[2] - first**2 - second**2], 1) / caps
        best = int(np.argmin((rest**2) @ self.weights))
        return (int(first[best]), int(second[best])) if second[best] else (int(first[best]),)

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the piece of each length and rank."""
        before, each, sequence, offset = self.rows[np.searchsorted(self.keys, (lengths << 44) + ranks, "right") - 1].T
        nth = ranks - before
        return sequence + nth // each, offset + nth % each * lengths


def _places(plan, names: list[str]):
    def run(batches):
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            columns = [batch.column(c) for c in names]
            yield pa.record_batch([*columns, *map(pa.array, plan.value.place(lengths, ranks))], [*names, "sequence_id", "offset"])

    return run
