"""Bigram language model in a log-frequency Bloom filter, with exact unigram counts beside it.

- **Counting.** Tasks count words and word pairs of the training documents by 64-bit hash and send each
  distinct one of a few million tokens once, packed by cell (the upper bits of the hash). A cell adds
  up its counts exactly. Cells grow in number with the input.
- **Filter.** A count c has the level 1 + floor(log_base(c)); an n-gram is inserted once for every level
  up to its own. Each cell owns a stretch of the filter, so a cell's task makes its bits alone, as many
  as its insertions need: 8 bits each, two of them probed, let an absent level pass in at most 5 %. To look
  up an n-gram, levels are probed from 1 until one is missing. A false positive can raise a count,
  nothing lowers one. A filter of at most `filter_bits` is broadcast. Of a larger one no task has more than a
  stretch: the distinct n-grams of each bucket of documents go to their cells, and the levels come back.
- **Exact base score.** Words whose count is in the upper levels, `most_words` at most, are broadcast with their
  counts. The other words of a document meet their counts in their cell's task, so the vocabulary may have any size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import held_out, stage, text_size, unique_texts

BASE = 1.5
MOST_FILTER_BITS = 1 << 30
BITS_PER_INSERTION = 8
MOST_WORDS = 1_000_000
GROUP_BYTES = 8 << 20
FLUSH_TOKENS = 3_000_000
SMOOTHING = 8.0
BEGIN, END = W.U64(0x1F83D9ABFB41BD6B), W.U64(0x5BE0CD19137E2179)
PAIR, LEVEL = W.U64(0x9FB21C651E98DF25), 0xD1342543DE82EF95
LEVELS = 128


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 7,
    rest: int = 2,
    smoothing: float = SMOOTHING,
    base: float = BASE,
    bits_per_byte: float = 0.5,
    filter_bits: int = MOST_FILTER_BITS,
    most_words: int = MOST_WORDS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per document.

    Learns from the documents whose crc32(id as text) mod `modulus` is not `rest`. Tokens: words
    `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased, then one end token. base_score: sum of
    log10((c + 1) / (N + V + 1)) with exact counts. score: sum of the log10 of
    (c(h, w) + smoothing * p(w)) / (c(h) + smoothing), with p(w) = (c(w) + 1) / (N + V + 1), where h is the
    token before (a begin token first) and all counts come from the filter.

    A null, empty or blank text is the end token alone. Without training documents N and V are 0 and
    every token is unknown: base_score is 0. Several rows of one id count as one, see
    `unique_texts`; rows without an id are left out. An empty table gives an empty table. Words are
    told apart by 64-bit hash. The filter has 8 bits per n-gram and level, and at least about `bits_per_byte` bits
    per byte of text; whether it is broadcast changes no score. Other columns of `docs` play no part, whatever
    they are called.
    """
    rows = unique_texts(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("_id"), held_out(id_col, modulus, rest).alias("_held"), F.col(text_col).alias("_text")
    )
    spark = rows.sparkSession
    size = text_size(rows, "_text")
    cell_bits = min((size // group_bytes).bit_length(), 20)
    groups = max(1, size // group_bytes)
    segment = min(max(6, 10 - cell_bits, int(size * bits_per_byte).bit_length() - cell_bits), 32)
    counts = rows.where(~F.col("_held")).select("_text").mapInArrow(_count(cell_bits), "cell int, pairs boolean, hashes binary, counts binary")
    model = stage(
        counts.groupBy("cell").applyInArrow(_cell_model(segment, base), "cell int, filter binary, n long, v long, levels array<long>, hashes binary, counts binary")
    )
    totals = model.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = totals.n or 0, totals.v or 0
    level = _broadcast_level(model, most_words)
    frequent = _frequent(model, level, base)
    n_train = rows.where(~F.col("_held")).count()
    score = _score(spark.sparkContext.broadcast(frequent), base, smoothing, n, v, n_train)
    types = "_id long, _held boolean, n_tokens long, known long, logs double, score double, rest binary, times binary"
    lengths = model.select("cell", F.octet_length("filter").alias("bytes"))
    if 8 * (lengths.agg(F.sum("bytes")).first()[0] or 0) <= filter_bits:
        stretches = np.zeros((1 << cell_bits) + 1, np.int64)
        for cell, length in lengths.collect():
            stretches[cell + 1] = 8 * length
        stretches = np.cumsum(stretches)
        filter_ = np.zeros(stretches[-1] >> 3, np.uint8)
        for cell, data in model.select("cell", "filter").toLocalIterator():
            filter_[stretches[cell] >> 3 : stretches[cell + 1] >> 3] = np.frombuffer(bytes(data), np.uint8)
        scored = rows.mapInArrow(_by_filter(spark.sparkContext.broadcast((filter_, stretches)), cell_bits, score), types)
    else:
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int"))
        wanted = dealt.select("bucket", "_text").groupBy("bucket").applyInArrow(_wanted(cell_bits), "cell int, bucket int, hashes binary")
        levels = wanted.groupBy("cell").cogroup(model.select("cell", "filter").groupBy("cell")).applyInArrow(_cell_levels, "bucket int, cell int, levels binary")
        scored = dealt.groupBy("bucket").cogroup(levels.groupBy("bucket")).applyInArrow(_by_levels(score, types), types)
    scored = stage(scored)
    total = F.lit(float(np.log10(n + v + 1)))
    out = scored.select("_id", "_held", "n_tokens", "known", "logs", "score")
    if level > 0:  # words that are not broadcast may have counts
        rare = scored.select("_id", "rest", "times").mapInArrow(_by_cell(cell_bits), "cell int, hashes binary, docs binary, times binary")
        found = rare.groupBy("cell").cogroup(model.select("cell", "hashes", "counts").groupBy("cell")).applyInArrow(_look_up(groups), "bucket int, docs binary, counts binary, times binary")
        sums = found.groupBy("bucket").applyInArrow(_sums, "_id long, more_known long, more_logs double")
        out = out.join(sums, "_id", "left")
    else:
        out = out.withColumns({"more_known": F.lit(0).cast("long"), "more_logs": F.lit(0.0)})
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_held").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * total).alias("base_score"),
        "score",
    )


def _broadcast_level(model: DataFrame, most_words: int) -> int:
    """The lowest level from which on at most `most_words` words have their counts; 0: all words."""
    sums = model.select(F.posexplode("levels")).groupBy("pos").agg(F.sum("col")).collect()
    by_level = np.zeros(LEVELS, np.int64)
    for level, n in sums:
        by_level[level] = n
    above = np.cumsum(by_level[::-1])[::-1]
    return int(np.flatnonzero(above <= most_words)[0]) if (above <= most_words).any() else LEVELS


def _frequent(model: DataFrame, level: int, base: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the words from `level` on."""

    def keep(batches):
        for batch in batches:
            hashes, counts = W.unpack(batch.column("hashes"), np.uint64), W.unpack(batch.column("counts"), np.int64)
            ok = _levels(counts, base) > level if level else np.ones(len(counts), bool)
            yield pa.record_batch([W.binary([hashes[ok]]), W.binary([counts[ok]])], ["hashes", "counts"])

    parts = model.select("hashes", "counts").mapInArrow(keep, "hashes binary, counts binary").collect()
    hashes = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(bytes(r.hashes), np.uint64) for r in parts]])
    counts = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(bytes(r.counts), np.int64) for r in parts]])
    order = np.argsort(hashes)
    return hashes[order], counts[order]


# -- tokens


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Hashes of all tokens of a slice, an end token after each row's words, and the rows' bounds."""
    data = W.LOWER[data]
    starts, ends, bounds = W.find_words(data, offsets)
    n_rows = len(offsets) - 1
    tokens = np.empty(len(starts) + n_rows, W.U64)
    last = bounds[1:] + np.arange(n_rows)
    is_word = np.ones(len(tokens), bool)
    is_word[last] = False
    tokens[is_word] = W.hash_words(data, starts, ends)
    tokens[last] = END
    return tokens, np.concatenate([[0], last + 1])


def _histories(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = BEGIN
    return before


def _pairs(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return W.mix(before * PAIR + tokens)


def _levels(counts: np.ndarray, base: float) -> np.ndarray:
    """1 + floor(log_base(count)); 0 for 0. The margin keeps exact powers on their level."""
    return np.where(counts > 0, 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9), 0).astype(np.int64)


def level_counts(base: float) -> np.ndarray:
    """The count that a level stands for: the middle of the counts on it."""
    levels = np.arange(LEVELS)
    low, high = np.ceil(base ** (levels - 1.0) - 1e-9), np.maximum(np.ceil(base**levels - 1e-9) - 1, np.ceil(base ** (levels - 1.0) - 1e-9))
    out = (low + high) / 2
    out[0] = 0
    return out


def _cell(hashes: np.ndarray, cell_bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - cell_bits)).astype(np.int64) if cell_bits else np.zeros(len(hashes), np.int64)


def _probes(hashes: np.ndarray, level: int, length):
    """Two places within the cell's stretch of the filter, of `length` bits, 2^32 at most."""
    x = W.mix(hashes + W.U64(level * LEVEL % (1 << 64)))
    half = np.uint64(32)
    return tuple((part * length >> half).astype(np.int64) for part in (x & np.uint64(0xFFFFFFFF), x >> half))


def _summed(hashes: np.ndarray, counts: np.ndarray | None = None):
    """Distinct sorted hashes and their summed counts."""
    if counts is None:
        hashes = np.sort(hashes)
    else:
        order = np.argsort(hashes)
        hashes, counts = hashes[order], counts[order]
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(new)
    sums = np.diff(first, append=len(hashes)) if counts is None else np.add.reduceat(counts, first) if len(first) else counts
    return hashes[first], sums.astype(np.int64)


def _split_cells(cells: np.ndarray):
    edges = np.flatnonzero(np.diff(cells, prepend=-1))
    yield from zip(cells[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(cells)], strict=True)


# -- counting


def _count(cell_bits: int):
    def emit(tokens: list[np.ndarray], pairs: list[np.ndarray]) -> pa.RecordBatch:
        keys, is_pair, hashes, counts = [], [], [], []
        for kind, held in ((False, tokens), (True, pairs)):
            own, n = _summed(np.concatenate(held))
            n = n.astype(np.uint32)
            for cell, lo, hi in _split_cells(_cell(own, cell_bits)):
                keys.append(cell)
                is_pair.append(kind)
                hashes.append(own[lo:hi].tobytes())
                counts.append(n[lo:hi].tobytes())
        return pa.record_batch(
            [pa.array(keys, pa.int32()), pa.array(is_pair), pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())], ["cell", "pairs", "hashes", "counts"]
        )

    def run(batches):
        held, pairs, n = [], [], 0
        for batch in batches:
            for _, _, data, offsets in W.sliced(batch.column("_text")):
                tokens, bounds = _tokens(data, offsets)
                held.append(tokens)
                pairs.append(_pairs(_histories(tokens, bounds), tokens))
                n += len(tokens)
                if n >= FLUSH_TOKENS:
                    yield emit(held, pairs)
                    held, pairs, n = [], [], 0
        if n:
            yield emit(held, pairs)

    return run


def _cell_model(segment: int, base: float):
    def run(parts: pa.Table) -> pa.Table:
        found = []
        for kind in (False, True):
            own = parts.filter(pc.equal(parts.column("pairs"), kind))
            hashes, counts = _summed(W.unpack(own.column("hashes"), np.uint64), W.unpack(own.column("counts"), np.uint32).astype(np.int64))
            found.append((hashes, counts, _levels(counts, base)))
        insertions = sum(int(levels.sum()) for _, _, levels in found)
        length = min(max(1 << segment, -(-insertions * BITS_PER_INSERTION // 64) * 64), 1 << 32)
        bits = np.zeros(length, bool)
        for hashes, _, levels in found:
            level = 1
            while len(hashes):
                for place in _probes(hashes, level, np.uint64(length)):
                    bits[place] = True
                level += 1
                more = levels >= level
                hashes, levels = hashes[more], levels[more]
        hashes, counts, levels = found[0]
        return pa.table(
            {
                "cell": parts.column("cell")[:1],
                "filter": W.binary([np.packbits(bits, bitorder="little")]),
                "n": pa.array([int(counts.sum())], pa.int64()),
                "v": pa.array([len(hashes)], pa.int64()),
                "levels": pa.array([np.bincount(np.maximum(levels - 1, 0), minlength=LEVELS).tolist()], pa.list_(pa.int64())),
                "hashes": W.binary([hashes]),
                "counts": W.binary([counts]),
            }
        )

    return run


# -- scoring


def probe(filter_: np.ndarray, hashes: np.ndarray, cell_bits: int, stretches: int | np.ndarray) -> np.ndarray:
    """The level of each n-gram in the filter. `stretches`: the bit where each cell's stretch begins, and the end of
    the last; or the log2 of the length that all have."""
    if isinstance(stretches, int):
        stretches = np.arange((1 << cell_bits) + 1) << stretches
    levels = np.zeros(len(hashes), np.int64)
    cell = _cell(hashes, cell_bits)
    begin, length = stretches[cell], (stretches[cell + 1] - stretches[cell]).astype(W.U64)
    active = np.flatnonzero(length)
    hashes, begin, length = hashes[active], begin[active], length[active]
    for level in range(1, LEVELS):
        ok = np.ones(len(hashes), bool)
        for place in _probes(hashes, level, length):
            place += begin
            ok &= filter_[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
        active, hashes, begin, length = active[ok], hashes[ok], begin[ok], length[ok]
        if not len(active):
            break
        levels[active] = level
    return levels


def _by_filter(shared, cell_bits: int, score):
    """Scores with the whole filter."""

    def run(batches):
        filter_, stretches = shared.value
        for batch in batches:
            yield from score(batch, lambda hashes: probe(filter_, hashes, cell_bits, stretches))

    return run


def _ngrams(column) -> np.ndarray:
    """Distinct sorted hashes of all tokens and pairs of a text column."""
    found = [np.zeros(0, W.U64)]
    for _, _, data, offsets in W.sliced(column):
        tokens, bounds = _tokens(data, offsets)
        found.append(_summed(np.concatenate([tokens, _pairs(_histories(tokens, bounds), tokens)]))[0])
    return _summed(np.concatenate(found))[0]


def _wanted(cell_bits: int):
    """The n-grams of a bucket of documents, to their cells."""

    def run(docs: pa.Table) -> pa.Table:
        bucket = docs.column("bucket")[0].as_py()
        hashes = _ngrams(docs.column("_text"))
        rows = [(cell, hashes[lo:hi].tobytes()) for cell, lo, hi in _split_cells(_cell(hashes, cell_bits))]
        cells, parts = zip(*rows, strict=True)
        return pa.table({"cell": pa.array(cells, pa.int32()), "bucket": pa.array([bucket] * len(rows), pa.int32()), "hashes": pa.array(parts, pa.binary())})

    return run


def _cell_levels(wanted: pa.Table, model: pa.Table) -> pa.Table:
    """The levels of a cell's n-grams, to the buckets that asked."""
    filter_, _ = W.text_bytes(model.column("filter"))
    levels = probe(filter_, W.unpack(wanted.column("hashes"), np.uint64), 0, np.array([0, 8 * len(filter_)]))
    _, places = W.text_bytes(wanted.column("hashes"))
    parts = [levels[a:b].astype(np.uint8).tobytes() for a, b in zip(places[:-1] // 8, places[1:] // 8, strict=True)]
    return pa.table({"bucket": wanted.column("bucket"), "cell": wanted.column("cell"), "levels": pa.array(parts, pa.binary())})


def _by_levels(score, types: str):
    """Scores of a bucket of documents with the levels from the cells."""
    schema = pa.schema([(name, {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}[t]) for name, t in map(str.split, types.split(", "))])

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        hashes = _ngrams(docs.column("_text"))
        order = np.argsort(found.column("cell").to_numpy())  # cells are the upper bits
        levels = W.unpack(found.column("levels").take(pa.array(order)), np.uint8)
        if len(levels) != len(hashes):
            raise RuntimeError(f"{len(levels)} levels for {len(hashes)} n-grams")
        batches = [x for b in docs.to_batches() for x in score(b, lambda own: levels[np.searchsorted(hashes, own)])]
        return pa.Table.from_batches(batches, schema)

    return run


def _score(shared, base: float, smoothing: float, n: int, v: int, n_train: int):
    """Scores the documents of a batch; `look` gives the levels of n-grams."""

    def run(batch, look):
        frequent, frequent_counts = shared.value
        values = level_counts(base)
        for lo, hi, data, offsets in W.sliced(batch.column("_text")):
            tokens, bounds = _tokens(data, offsets)
            begins = bounds[:-1]
            counts = np.zeros(len(tokens), np.int64)
            if len(frequent):
                place = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                same = frequent[place] == tokens
                counts[same] = frequent_counts[place[same]]
            rest, times = [], []
            unknown = counts == 0
            for a, b in zip(bounds, bounds[1:], strict=False):
                own, k = _summed(tokens[a:b][unknown[a:b]])
                rest.append(own.tobytes())
                times.append(k.astype(np.uint32).tobytes())
            # the model
            single = values[look(tokens)]
            before = _histories(tokens, bounds)
            history = np.empty_like(single)
            history[1:] = single[:-1]
            history[begins] = n_train
            both = np.minimum(values[look(_pairs(before, tokens))], np.minimum(history, single))
            p = (both + smoothing * (single + 1) / (n + v + 1)) / (history + smoothing)
            columns = [
                batch.column("_id").slice(lo, hi - lo),
                batch.column("_held").slice(lo, hi - lo),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(np.add.reduceat((counts > 0).astype(np.int64), begins)),
                pa.array(np.add.reduceat(np.log10(counts + 1.0), begins)),
                pa.array(np.add.reduceat(np.log10(np.minimum(p, 1.0)), begins)),
                pa.array(rest, pa.binary()),
                pa.array(times, pa.binary()),
            ]
            yield pa.record_batch(columns, ["_id", "_held", "n_tokens", "known", "logs", "score", "rest", "times"])

    return run


def _by_cell(cell_bits: int):
    """The words that were not broadcast, to their cells."""

    def emit(held: list[tuple]) -> pa.RecordBatch:
        hashes, docs, times = (np.concatenate(x) for x in zip(*held, strict=True))
        cells = _cell(hashes, cell_bits)
        order = np.argsort(cells, kind="stable")
        rows = [(cell, hashes[order[lo:hi]].tobytes(), docs[order[lo:hi]].tobytes(), times[order[lo:hi]].tobytes()) for cell, lo, hi in _split_cells(cells[order])]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.record_batch([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["cell", "hashes", "docs", "times"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            ids = batch.column("_id").to_numpy()
            _, places = W.text_bytes(batch.column("rest"))
            for lo, hi in W.slices(places, places, 8 * FLUSH_TOKENS // 4):
                own = batch.slice(lo, hi - lo)
                hashes = W.unpack(own.column("rest"), np.uint64)
                held.append((hashes, np.repeat(ids[lo:hi], np.diff(places[lo : hi + 1]) // 8), W.unpack(own.column("times"), np.uint32)))
                n += len(hashes)
                if n >= FLUSH_TOKENS:
                    yield emit(held)
                    held, n = [], 0
        if n:
            yield emit(held)

    return run


def _look_up(groups: int):
    def run(rare: pa.Table, model: pa.Table) -> pa.Table:
        hashes, docs, times = W.unpack(rare.column("hashes"), np.uint64), W.unpack(rare.column("docs"), np.int64), W.unpack(rare.column("times"), np.uint32)
        known, counts = W.unpack(model.column("hashes"), np.uint64), W.unpack(model.column("counts"), np.int64)
        if not len(known) or not len(hashes):
            rows = []
        else:
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            same = known[place] == hashes
            docs, times, found = docs[same], times[same], counts[place[same]]
            buckets = W.xxhash64(np.ascontiguousarray(docs)) % groups
            order = np.argsort(buckets, kind="stable")
            rows = [
                (bucket, docs[order[lo:hi]].tobytes(), found[order[lo:hi]].tobytes(), times[order[lo:hi]].tobytes())
                for bucket, lo, hi in _split_cells(buckets[order])
            ]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.table({"bucket": pa.array(columns[0], pa.int32())} | {n: pa.array(c, pa.binary()) for n, c in zip(("docs", "counts", "times"), columns[1:], strict=True)})

    return run


def _sums(parts: pa.Table) -> pa.Table:
    docs, counts, times = W.unpack(parts.column("docs"), np.int64), W.unpack(parts.column("counts"), np.int64), W.unpack(parts.column("times"), np.uint32)
    order = np.lexsort((times, counts, docs))  # one order of addition, however the parts came
    docs, counts, times = docs[order], counts[order], times[order].astype(np.int64)
    first = np.flatnonzero(np.diff(docs, prepend=docs[:1] - 1))
    return pa.table(
        {
            "_id": pa.array(docs[first]),
            "more_known": pa.array(np.add.reduceat(times, first)),
            "more_logs": pa.array(np.add.reduceat(np.log10(counts + 1.0) * times, first)),
        }
    )
