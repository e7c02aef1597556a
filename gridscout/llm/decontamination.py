"""Benchmark decontamination: windows of benchmark words, hashed and broadcast, looked up in all documents.

The windows of all items form a sorted array of hashes, next to a bitmap that rejects almost every
document window by one look-up. Windows whose hash is found are compared byte by byte. Items are cut into
stretches that overlap by a window less a word, and the bytes of these are summed before any is collected; of
a benchmark with more than `most_bytes`, parts of about that size are broadcast one after the other, each for a
scan of its own, and the hits of the scans are merged.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import unique_texts

WINDOW = 13
MOST_BYTES = 64 << 20  # of the windows that are broadcast at once
STRETCH = 10_000  # windows of an item that stay together
WORD_BYTES = 40  # of places and hashes, for each word
FILTER_BITS = 22
HIT = ("first", "last", "start", "end")  # words [first, last) of a document, bytes [start, end)
HITS = "array<struct<first:long,last:long,start:long,end:long>>"


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: int = 20,
    most_bytes: int = MOST_BYTES,
    stretch: int = STRETCH,
    carry: tuple[str, ...] = (),
    cleaned: bool = False,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items, contaminated, spans, carry...) per document. With `cleaned`,
    also the text without the spans.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A window is `window`
    words in a row of an item, or a shorter item as a whole. A document word inside an occurrence of
    a window is hit. `items`: the ids of the items with a window in the document, sorted as strings.
    `spans`: (start, end) in bytes of UTF-8 of each stretch of hit words. contaminated: at least one
    word hit, and one in `share` or more.

    A null or empty text has no words and is clean; an item without words, or without an id, has no
    windows. Equal windows of several items count for each of them. Several rows of one document id
    count as one, see `unique_texts`; several rows of an item id all count. Rows without a document id
    are left out. An item may be of any length. Empty tables: no documents give an empty table, no items leave
    everything clean. Other columns of both tables play no part, whatever they are called.
    """
    keep = tuple(dict.fromkeys((id_col, *carry, *([text_col] if cleaned else []))))
    rows = unique_texts(docs, id_col, text_col, *carry)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("item IS NOT NULL")
    pattern = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    lowered = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    items = items.select("item", F.regexp_extract_all(lowered, F.lit(pattern), F.lit(0)).alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(stretch))
    cut = items.select("item", "words", F.explode(starts).alias("at")).select("item", F.slice("words", F.col("at") + 1, stretch + window - 1).alias("words"))
    items = cut.select("item", F.array_join("words", " ").alias("words"), F.size("words").alias("n")).distinct()
    total = items.select(F.sum(F.octet_length("words") + WORD_BYTES * F.col("n"))).first()[0]
    parts = max(1, -(-int(total or 0) // most_bytes))
    known = [{f.name: f.dataType.simpleString() for f in rows.schema}[c] for c in keep]
    types = ", ".join(f"`{c}` {t}" for c, t in zip(keep, known, strict=True)) + f", n_words long, items array<string>, hits {HITS}"
    out_types = ", ".join(f"`{c}` {t}" for c, t in zip(keep, known, strict=True) if c != text_col or c in carry)
    out_types += ", n_words long, n_hit long, n_items long, items array<string>, contaminated boolean, spans array<struct<start:long,end:long>>" + ", cleaned string" * cleaned

    def windows(part: int):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part)
        return rows.sparkSession.sparkContext.broadcast(Windows([(r.item, r.words) for r in own.collect()], window))

    finish = _finish(keep, text_col, share, cleaned, carry)
    if parts == 1:
        scan = _scan(windows(0), text_col, keep)
        return rows.mapInArrow(lambda batches: finish(scan(batches)), out_types)
    found = rows.mapInArrow(_scan(windows(0), text_col, keep), types)
    more = None
    for part in range(1, parts):
        own = rows.mapInArrow(_scan(windows(part), text_col, (id_col,)), f"`{id_col}` {known[0]}, n_words long, items array<string>, hits {HITS}").where("size(hits) > 0")
        more = own if more is None else more.unionByName(own)
    more = more.groupBy(id_col).agg(F.flatten(F.collect_list("items")).alias("_items"), F.flatten(F.collect_list("hits")).alias("_hits"))
    both = found.join(more, id_col, "left")
    both = both.withColumns({c: F.concat(c, F.coalesce(f"_{c}", F.array().cast(f.dataType))) for c in ("items", "hits") for f in found.schema if f.name == c})
    return both.drop("_items", "_hits").mapInArrow(finish, out_types)


class Windows:
    """The windows of all stretches (item, words joined by blanks), by their number of words, in flat arrays.

    Equal windows are one, with the items that have it; they are told by two hashes.
    """

    def __init__(self, stretches: list[tuple[str, str]], window: int) -> None:
        self.names = sorted({item for item, _ in stretches})
        number = {name: i for i, name in enumerate(self.names)}
        of_row = np.array([number[item] for item, _ in stretches], np.int32)
        texts = [text.encode() for _, text in stretches]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        starts, ends, bounds = W.find_words(self.data, np.cumsum([0, *map(len, texts)]), W.ALPHANUMERIC)
        hashes = [W.hash_words(self.data, starts, ends, way) for way in (0, 1)]
        n_words, row = np.diff(bounds), W.row_of(bounds)
        self.sizes = {}
        for size in np.unique(np.minimum(n_words, window)).tolist():
            if size == window:
                at = np.flatnonzero(W.whole_runs(bounds, size))
            else:  # items of fewer words
                at = bounds[:-1][n_words == size]
            first, second = (W.hash_runs(h, size, way)[at] for way, h in enumerate(hashes))
            items = of_row[row[at]]
            order = np.lexsort((items, second, first))
            first, second, items, at = first[order], second[order], items[order], at[order]
            new = np.ones(len(at), bool)
            new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            kept = new.copy()
            kept[1:] |= items[1:] != items[:-1]
            places = np.append(np.flatnonzero(new[kept]), int(kept.sum()))  # where the items of each window begin
            bitmap = np.zeros(1 << FILTER_BITS, bool)
            bitmap[first >> np.uint64(64 - FILTER_BITS)] = True
            begin, end = starts[at[new]], ends[at[new] + size - 1]
            self.sizes[size] = (first[new], bitmap, begin, end, items[kept], places)

    def found(self, size: int, at: int, words: bytes) -> np.ndarray | None:
        """Numbers of the items with this window; `at`: the first place of its hash."""
        hashes, _, begin, end, items, places = self.sizes[size]
        hash_ = hashes[at]
        while at < len(hashes) and hashes[at] == hash_:
            if self.data[begin[at] : end[at]].tobytes() == words:
                return items[places[at] : places[at + 1]]
            at += 1
        return None

    @property
    def nbytes(self) -> int:
        return self.data.nbytes + sum(x.nbytes for arrays in self.sizes.values() for x in arrays)


def _scan(known, text_col: str, keep: tuple[str, ...]):
    """The columns of `keep`, n_words, items, and hits: the stretches of hit words, by word and by byte."""

    def of_slice(data: np.ndarray, offsets: np.ndarray):
        """Words of each row, the hit ones, and the items found."""
        data = W.LOWER[data]
        starts, ends, bounds = W.find_words(data, offsets, W.ALPHANUMERIC)
        hashes = W.hash_words(data, starts, ends)
        hit = np.zeros(len(starts), bool)
        items: dict[int, set[int]] = defaultdict(set)
        for size, (sorted_hashes, bitmap, *_) in known.value.sizes.items():
            runs = W.hash_runs(hashes, size)
            at = np.flatnonzero(bitmap[runs >> np.uint64(64 - FILTER_BITS)])
            at = at[W.whole_runs(bounds, size)[at]]
            place = np.minimum(np.searchsorted(sorted_hashes, runs[at]), len(sorted_hashes) - 1)
            same = sorted_hashes[place] == runs[at]
            at, place = at[same], place[same]
            rows = np.searchsorted(bounds, at, "right") - 1
            for i, row, j in zip(at.tolist(), rows.tolist(), place.tolist(), strict=True):
                words = b" ".join(data[a:b].tobytes() for a, b in zip(starts[i : i + size], ends[i : i + size], strict=True))
                found = known.value.found(size, j, words)
                if found is not None:
                    hit[i : i + size] = True
                    items[row].update(found.tolist())
        return starts, ends, bounds, hit, items

    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in W.sliced(batch.column(text_col)):
                starts, ends, bounds, hit, items = of_slice(data, offsets)
                hits: list[list[dict]] = [[] for _ in range(hi - lo)]
                for row in np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(hit)])[bounds])):
                    at = np.flatnonzero(hit[bounds[row] : bounds[row + 1]])
                    first, last = at[np.diff(at, prepend=-2) > 1], at[np.diff(at, append=at[-1] + 2) > 1]
                    begin, end = starts[bounds[row] + first] - offsets[row], ends[bounds[row] + last] - offsets[row]
                    hits[row] = [dict(zip(HIT, x, strict=True)) for x in zip(first.tolist(), (last + 1).tolist(), begin.tolist(), end.tolist(), strict=True)]
                columns = {c: batch.column(c).slice(lo, hi - lo) for c in keep}
                columns["n_words"] = pa.array(np.diff(bounds), pa.int64())
                columns["items"] = pa.array([[known.value.names[x] for x in items.get(i, ())] for i in range(hi - lo)], pa.list_(pa.string()))
                columns["hits"] = pa.array(hits, pa.list_(pa.struct([(x, pa.int64()) for x in HIT])))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def merged(hits: list[dict]) -> list[dict]:
    """Stretches of words joined where they meet or overlap."""
    out: list[dict] = []
    for x in sorted(hits, key=lambda h: (h["first"], h["last"])):
        if out and x["first"] <= out[-1]["last"]:
            out[-1] = out[-1] | {k: max(out[-1][k], x[k]) for k in ("last", "end")}
        else:
            out.append(x)
    return out


def _finish(keep: tuple[str, ...], text_col: str, share: int, cleaned: bool, carry: tuple[str, ...]):
    def run(batches):
        for batch in batches:
            hits = [merged(x) if len(x) > 1 else x for x in batch.column("hits").to_pylist()]
            items = [sorted(set(x)) for x in batch.column("items").to_pylist()]
            n_words = batch.column("n_words").to_numpy()
            n_hit = np.array([sum(h["last"] - h["first"] for h in x) for x in hits], np.int64)
            spans = [[{k: h[k] for k in ("start", "end")} for h in x] for x in hits]
            columns = {c: batch.column(c) for c in keep if c != text_col or c in carry}
            columns |= {
                "n_words": pa.array(n_words),
                "n_hit": pa.array(n_hit),
                "n_items": pa.array([len(x) for x in items], pa.int64()),
                "items": pa.array(items, pa.list_(pa.string())),
                "contaminated": pa.array((n_hit > 0) & (share * n_hit >= n_words)),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            }
            if cleaned:
                texts = [(x or "").encode() for x in batch.column(text_col).to_pylist()]
                columns["cleaned"] = pa.array([without_spans(x, s) for x, s in zip(texts, spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def without_spans(text: bytes, spans: list[dict]) -> str:
    out, at = [], 0
    for x in spans:
        out.append(text[at : x["start"]])
        at = x["end"]
    return b"".join([*out, text[at:]]).decode()
