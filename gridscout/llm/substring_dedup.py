"""Removal of passages that stand earlier in the corpus: count-min prefilter, then exact grouping.

1. Every task counts its windows of words in a count-min sketch of two rows. Sketches are sent as
   the gaps between used cells, about a byte a window, and merged by block of cells. Counters stop
   at 2, as only "more than once" is asked; a merged block is a bitmap. A cell's count is never
   below the count of a window in it, so no repeated window is missed.
2. A second pass keeps the windows whose cells all say "repeated". Within a task all but the
   earliest occurrence of a window are settled; only that one, with a 96-bit hash, goes to the
   window's cell group, where the earliest of all is found exactly. A window in a third of all
   documents so sends one row per few hundred thousand windows read, not one per
   occurrence.
3. Removed window starts go to their documents as runs, and the words they cover are cut.

The bitmaps are broadcast. Their size follows the input up to `sketch_bytes` and not beyond; past
that more windows pass the first filter, and the result is the same.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import text_size, unique_texts

WINDOW = 20
SKETCH_BYTES = 128 << 20
BLOCK_BITS = 20
GROUP_BYTES = 8 << 20  # text that one group of windows or documents stands for
FLUSH_SKETCH = 2_000_000
FLUSH_WINDOWS = 700_000
CELL_HASH = np.uint64(0x8CB92BA72F3D8DD7)
PACKED = "h1 binary, h2 binary, doc binary, pos binary, run binary"
FIELDS = (("h1", np.uint64), ("h2", np.uint32), ("doc", np.int64), ("pos", np.int32), ("run", np.int32))


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    carry: tuple[str, ...] = (),
    whole: bool = False,
    sketch_bytes: int = SKETCH_BYTES,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(id, n_words, n_removed, kept, carry...) per document: the words left, joined by one space.
    With `whole`, the text too.

    Words are `[^\\x20\\x09-\\x0D]+`. A word is removed if a window of `window` words over it also
    starts earlier: in a document of smaller id, or before in the same one. Windows are those of the
    input, not of what is left.

    A null or empty text has no words: 0, 0 and an empty string. Fewer words than `window` stay. The
    first of equal windows stays; the ids, whole numbers, decide, so there are no ties. Several rows
    of one id count as one, see `unique_texts`; rows without an id are left out. An empty table gives
    an empty table. Other columns of `docs` play no part, whatever they are called.
    """
    rows = unique_texts(docs, id_col, text_col, *carry).select(
        F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), *carry
    )
    size = text_size(rows, "_text")
    groups = max(1, size // group_bytes)
    bits = max(BLOCK_BITS, min((size // 6).bit_length(), (sketch_bytes * 4).bit_length() - 1))
    bitmaps = rows.sparkSession.sparkContext.broadcast(_merged_sketch(rows, window, bits))
    found = (
        rows.select("_id", "_text")
        .mapInArrow(_candidates(window, bits, bitmaps, groups), f"key int, {PACKED}")
        .groupBy("key")
        .applyInArrow(_later(groups), "key int, doc binary, pos binary, run binary")
    )
    bucket = F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int")
    types = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in carry)
    if whole:
        carry, types = (*carry, "_text"), types + ", _text string"
    kept = (
        rows.withColumn("_bucket", bucket)
        .groupBy("_bucket")
        .cogroup(found.groupBy("key"))
        .applyInArrow(_cut(window, carry), f"_id long, n_words long, n_removed long, kept string{types}")
    )
    return kept.withColumnsRenamed({"_id": id_col, "_text": text_col})


def _bucket(ids: np.ndarray, groups: int) -> np.ndarray:
    """The group of each id, as the column `_bucket` has it."""
    return W.xxhash64(np.ascontiguousarray(ids, np.int64)) % groups


def _cells(hashes: np.ndarray, bits: int, row: int) -> np.ndarray:
    """The cell of each window in one of the two rows of the sketch."""
    spread = hashes * CELL_HASH if row else hashes
    return (spread >> np.uint64(64 - bits)).astype(np.uint32)


def _windows(data, offsets, window: int):
    """(hash, row, place in the row, word hashes) of the windows of a slice."""
    starts, ends, bounds = W.find_words(data, offsets)
    hashes = W.hash_words(data, starts, ends)
    at = np.flatnonzero(W.whole_runs(bounds, window))
    return W.hash_runs(hashes, window)[at], at, (starts, ends, bounds)


# -- first pass


def _gaps(cells: np.ndarray) -> bytes:
    """Sorted cells as the four byte planes of their differences: the upper ones are zeros."""
    return np.diff(cells, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_gaps(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view("<u4").ravel(), dtype=np.int64)


def _sketch(window: int, bits: int):
    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.concatenate(held)
        keys, once, more = [], [], []
        for row in range(2):
            cells = _cells(hashes, bits, row)
            cells.sort()
            new = np.ones(len(cells), bool)
            new[1:] = cells[1:] != cells[:-1]
            first = np.flatnonzero(new)
            cells, single = cells[first], np.diff(first, append=len(new)) == 1
            block = cells >> np.uint32(BLOCK_BITS)
            edges = np.flatnonzero(np.diff(block, prepend=block[:1] + 1))
            for lo, hi in zip(edges, [*edges[1:], len(cells)], strict=True):
                within = cells[lo:hi] & np.uint32((1 << BLOCK_BITS) - 1)
                keys.append(row << (bits - BLOCK_BITS) | int(block[lo]))
                once.append(_gaps(within[single[lo:hi]]))
                more.append(_gaps(within[~single[lo:hi]]))
        return pa.record_batch([pa.array(keys, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["block", "once", "more"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for _, _, data, offsets in W.sliced(batch.column("_text")):
                hashes = _windows(data, offsets, window)[0]
                if len(hashes):
                    held.append(hashes)
                    n += len(hashes)
                if n >= FLUSH_SKETCH:
                    yield emit(held)
                    held, n = [], 0
        if n:
            yield emit(held)

    return run


def _merge(parts: pa.Table) -> pa.Table:
    """One block of the merged sketch: a bit for each cell that counts 2 or more."""
    counts = np.zeros(1 << BLOCK_BITS, np.uint8)
    for name, by in (("once", 1), ("more", 2)):
        for x in parts.column(name):
            cells = _from_gaps(x.as_py())
            counts[cells] = np.minimum(counts[cells] + by, 2)
    return pa.table({"block": parts.column("block")[:1], "bits": W.binary([np.packbits(counts == 2, bitorder="little")])})


def _merged_sketch(rows: DataFrame, window: int, bits: int) -> np.ndarray:
    """Both rows of the sketch as bitmaps, one after the other: 2 ** (bits - 2) bytes."""
    blocks = (
        rows.select("_text")
        .mapInArrow(_sketch(window, bits), "block int, once binary, more binary")
        .groupBy("block")
        .applyInArrow(_merge, "block int, bits binary")
    )
    width = 1 << (BLOCK_BITS - 3)
    out = np.zeros(1 << (bits - 2), np.uint8)
    for block, cells in blocks.collect():
        out[block * width : (block + 1) * width] = np.frombuffer(bytes(cells), np.uint8)
    return out


# -- second pass


def _runs(docs: np.ndarray, places: np.ndarray, lengths: np.ndarray | None = None):
    """Places next to each other in one document, as runs; sorted by document and place."""
    order = np.lexsort((places, docs))
    docs, places = docs[order], places[order]
    if lengths is not None:
        return docs, places, lengths[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (places[1:] != places[:-1] + 1)
    first = np.flatnonzero(new)
    return docs[first], places[first], np.diff(first, append=len(docs)).astype(np.int32)


def _earliest(h1, h2, docs, places):
    """The order by window, then place in the corpus, and where a window's first occurrence is."""
    order = np.lexsort((places, docs, h2, h1))
    h1, h2 = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return order, new


def _split(keys: np.ndarray, *columns: np.ndarray):
    """(key, columns of that key) for sorted keys."""
    edges = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    for lo, hi in zip(edges, [*edges[1:], len(keys)], strict=True):
        yield int(keys[lo]), [c[lo:hi] for c in columns]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.record_batch(
        [pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]],
        ["key", *(name for name, _ in FIELDS)],
    )


def _candidates(window: int, bits: int, bitmaps, groups: int):
    def emit(held: list[tuple]) -> pa.RecordBatch:
        h1, h2, docs, places = (np.concatenate(c) for c in zip(*held, strict=True))
        order, first = _earliest(h1, h2, docs, places)
        rows = []
        one = order[first]
        keys = (h1[one] % np.uint64(groups)).astype(np.int64)
        sort = np.lexsort((places[one], docs[one], keys))
        one, keys = one[sort], keys[sort]
        for key, (a, b, c, d) in _split(keys, h1[one], h2[one], docs[one], places[one]):
            rows.append((key, a.tobytes(), b.tobytes(), c.tobytes(), d.tobytes(), b""))
        rest = order[~first]
        if len(rest):
            docs, places, lengths = _runs(docs[rest], places[rest])
            keys = _bucket(docs, groups)
            sort = np.argsort(keys, kind="stable")
            for key, (c, d, e) in _split(keys[sort], docs[sort], places[sort], lengths[sort]):
                rows.append((key, b"", b"", c.tobytes(), d.tobytes(), e.tobytes()))
        return _packed(rows)

    def run(batches):
        maps = bitmaps.value
        half = len(maps) // 2
        held, n = [], 0
        for batch in batches:
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in W.sliced(batch.column("_text")):
                hashes, at, (starts, ends, bounds) = _windows(data, offsets, window)
                for row in range(2):
                    cells = _cells(hashes, bits, row)
                    hit = maps[row * half + (cells >> 3).astype(np.int64)] >> (cells & 7).astype(np.uint8) & 1 == 1
                    hashes, at = hashes[hit], at[hit]
                if not len(at):
                    continue
                more = W.hash_runs(W.hash_words(data, starts, ends, 1), window, 1)[at]
                row = np.searchsorted(bounds, at, "right") - 1
                held.append((hashes, (more >> np.uint64(32)).astype(np.uint32), ids[lo:hi][row], (at - bounds[row]).astype(np.int32)))
                n += len(at)
                if n >= FLUSH_WINDOWS:
                    yield emit(held)
                    held, n = [], 0
        if n:
            yield emit(held)

    return run


def _later(groups: int):
    """Of the windows of one group, all but the earliest of each, by bucket of their documents."""

    def run(parts: pa.Table) -> pa.Table:
        settled = pc.equal(pc.binary_length(parts.column("h1")), 0)
        kinds = [parts.filter(pc.invert(settled)), parts.filter(settled)]
        h1, h2, docs, places = (W.unpack(kinds[0].column(name), kind) for name, kind in FIELDS[:4])
        order, first = _earliest(h1, h2, docs, places)
        late = order[~first]
        all_docs, all_places, lengths = _runs(docs[late], places[late])
        more = [W.unpack(kinds[1].column(name), kind) for name, kind in FIELDS[2:]]
        docs, places, lengths = (np.concatenate(x) for x in zip((all_docs, all_places, lengths), more, strict=True))
        keys = _bucket(docs, groups)
        sort = np.lexsort((places, docs, keys))
        rows = [(key, c.tobytes(), d.tobytes(), e.tobytes()) for key, (c, d, e) in _split(keys[sort], docs[sort], places[sort], lengths[sort])]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.table({"key": pa.array(columns[0], pa.int32())} | {n: pa.array(c, pa.binary()) for n, c in zip(("doc", "pos", "run"), columns[1:], strict=True)})

    return run


# -- cutting


def _cut(window: int, carry: tuple[str, ...]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, places, lengths = (W.unpack(right.column(name), kind) for name, kind in FIELDS[2:])
        order = np.lexsort((places, docs))
        docs, places, lengths = docs[order], places[order], lengths[order]
        ids = left.column("_id").to_numpy()
        lows, highs = np.searchsorted(docs, ids), np.searchsorted(docs, ids, "right")
        n_words, n_removed, kept = [], [], []
        for text, lo, hi in zip(left.column("_text"), lows, highs, strict=True):
            found = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
            n_words.append(len(found))
            removed = 0
            if hi > lo:
                gone = W.covered(places[lo:hi], window, lengths[lo:hi], len(found))
                removed = int(gone.sum())
                found = list(compress(found, ~gone))
            n_removed.append(removed)
            kept.append(b" ".join(found))
        out = {"_id": left.column("_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
        out["kept"] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.table(out | {c: left.column(c) for c in carry})

    return run
