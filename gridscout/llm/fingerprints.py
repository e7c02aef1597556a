"""Order MinHash fingerprints: signatures that follow edit distance, not only the set of k-mers.

Each k-mer of bytes is numbered by its occurrence in the text, so repeats count. For each of `size`
hash functions the `tuple_size` numbered k-mers with the smallest hashes are selected, put back in
text order, and hashed as a tuple. The share of equal tuples is the likeness of two texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from gridscout.llm import words as W
from gridscout.llm.common import partitions, stage, unique_texts

SIZE = 32
TUPLE = 2
K = 8
LONG = 1 << 16  # k-mers hashed at a time in a long text
_factors = np.random.default_rng(20_240_229).integers(0, 1 << 63, 4096, dtype=np.uint64) * W.U64(2) + W.U64(1)


def order_minhash(text: bytes, size: int = SIZE, tuple_size: int = TUPLE, k: int = K) -> np.ndarray:
    """The signature, `size` 32-bit numbers. A text shorter than k bytes is one k-mer; an empty one has
    the signature of no k-mers. With fewer k-mers than `tuple_size` the tuple holds all there are."""
    kmers = _numbered(text, k)
    if not len(kmers):
        return np.zeros(size, np.uint32)
    kept = min(tuple_size, len(kmers))
    places = np.empty((size, kept), np.int64)
    best = np.full((size, 0), 0, np.uint64)
    held = np.zeros((size, 0), np.int64)
    for at in range(0, len(kmers), LONG):
        values = kmers[None, at : at + LONG] * _factors[:size, None]
        here = np.empty((size, min(kept, values.shape[1])), np.int64)
        least = np.empty(here.shape, np.uint64)
        every = np.arange(size)
        for i in range(here.shape[1]):
            here[:, i] = values.argmin(1)
            least[:, i] = values[every, here[:, i]]
            values[every, here[:, i]] = ~W.U64(0)
        best, held = np.concatenate([best, least], 1), np.concatenate([held, here + at], 1)
        order = np.argsort(best, 1, kind="stable")[:, :kept]
        best, held = np.take_along_axis(best, order, 1), np.take_along_axis(held, order, 1)
    places[:] = np.sort(held, 1)
    out = np.full(size, kept, W.U64)
    for i in range(kept):
        out = W.mix(out * W.U64(0x9E3779B97F4A7C15) + kmers[places[:, i]])
    return (out >> np.uint64(32)).astype(np.uint32)


def _numbered(text: bytes, k: int) -> np.ndarray:
    """Hashes of the k-mers in text order, each mixed with the number of its occurrence."""
    if not text:
        return np.zeros(0, W.U64)
    if len(text) < k or k != 8:
        parts = [text] if len(text) < k else [text[i : i + k] for i in range(len(text) - k + 1)]
        hashes = np.array([xxhash.xxh3_64_intdigest(p) for p in parts], W.U64)
    else:
        hashes = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,)).astype(W.U64)
        hashes = W.mix(hashes)
    # sorted by the upper bits with the place below, which a plain sort of numbers does
    bits = np.uint64(len(hashes).bit_length())
    ranked = np.sort(hashes >> bits << bits | np.arange(len(hashes), dtype=np.uint64))
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] >> bits != ranked[:-1] >> bits
    if not new.all():
        index = np.arange(len(ranked))
        number = np.empty(len(ranked), W.U64)
        number[(ranked & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = index - np.maximum.accumulate(np.where(new, index, 0))
        hashes += number * W.U64(0xC2B2AE3D27D4EB4F)
    hashes = W.mix(hashes)
    return hashes


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, other: str) -> str:
    """`text` with its last half replaced by as much of the beginning of `other`, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, tuple_size: int = TUPLE, k: int = K) -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) per document.

    The next document is the one with the next smaller id; after the smallest comes the largest.
    edited: SHA-256 of the edited text. Fingerprints are hex, near_*: the share of equal tuples.

    A null text is an empty one. Two empty texts have likeness 1. A single document is its own next one.
    Ids are unique, so there are no ties: several rows of one id count as one, see `unique_texts`; rows
    without an id are left out. An empty table gives an empty table. Other columns of `docs` play no
    part, whatever they are called.

    Documents are range-partitioned by id once. Where a partition begins or ends the neighbour stands in
    another one: these rows, two of each partition, are staged and paired afterwards.
    """
    rows = unique_texts(docs, id_col, text_col).select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType
    ranged = rows.repartitionByRange(partitions(docs.sparkSession), F.desc("_id")).sortWithinPartitions(F.desc("_id"))
    found = stage(ranged.mapInArrow(_pairs(kind, size, tuple_size, k), f"{_result(kind)}, edge string, text string"))
    edges = found.where("edge IS NOT NULL").select("_id", "edge", "text")
    order = Window.orderBy(F.desc("_id"))
    following = F.coalesce(F.lead("_id").over(order), F.first("_id").over(order))  # two ids a partition
    ids = edges.select("_id", "edge", following.alias("_next")).where("edge IN ('last', 'both')").select("_id", "_next")
    others = edges.select(F.col("_id").alias("_next"), F.col("text").alias("_other"))
    rest = ids.join(edges.select("_id", "text"), "_id").join(others, "_next").select("_id", "text", "_other")
    rest = rest.mapInArrow(_edge_pairs(kind, size, tuple_size, k), _result(kind))
    names = [x.split()[0] for x in _result(kind).split(", ")]
    return found.where("edited IS NOT NULL").select(*names).unionByName(rest).withColumnRenamed("_id", id_col)


def _result(kind: DataType) -> str:
    return f"_id {kind.simpleString()}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


NAMES = ["_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _compared(text: str, own: np.ndarray, other: str, theirs: np.ndarray, sign) -> tuple:
    changed = edited(text, other).encode()
    signature = sign(changed)
    return (len(text), hashlib.sha256(changed).hexdigest(), own.astype(">u4").tobytes().hex(), signature.astype(">u4").tobytes().hex(), likeness(own, signature), likeness(own, theirs))


def _pairs(kind: DataType, size: int, tuple_size: int, k: int):
    def sign(text: bytes) -> np.ndarray:
        return order_minhash(text, size, tuple_size, k)

    def run(batches):
        last = None  # (id, text, signature) of the row before
        first = True
        schema = None
        for batch in batches:
            schema = pa.schema([("_id", batch.schema.field("_id").type), *zip(NAMES[1:], TYPES[1:], strict=True), ("edge", pa.string()), ("text", pa.string())])
            rows = []
            for i, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                signature = sign(text.encode())
                if last is not None:
                    rows.append((last[0], *_compared(last[1], last[2], text, signature, sign), "first" if first else None, last[1] if first else None))
                    first = False
                last = (i, text, signature)
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        if last is not None:
            row = (last[0], *[None] * 6, "both" if first else "last", last[1])
            yield pa.record_batch([pa.array([c], f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

    return run


def _edge_pairs(kind: DataType, size: int, tuple_size: int, k: int):
    def sign(text: bytes) -> np.ndarray:
        return order_minhash(text, size, tuple_size, k)

    def run(batches):
        for batch in batches:
            ids = batch.column("_id")
            rows = [
                _compared(text, sign(text.encode()), other, sign(other.encode()), sign)
                for text, other in zip(batch.column("text").to_pylist(), batch.column("_other").to_pylist(), strict=True)
            ]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES[1:], strict=True)]
                yield pa.record_batch([ids, *columns], NAMES)

    return run
