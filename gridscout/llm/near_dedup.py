"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification, components.

- **Signatures.** One permutation spreads the shingles over 2^32 places; a second one, shifted round
  by 1, 2, ... k places, gives all k coordinates. Both are bijections of 32-bit numbers.
- **Classes.** Documents with equal shingle sets are one class, so copies cost one row each and no pair.
- **Bands.** A coordinate group of `rows` in `bands` bands. With 48 bands of 4 a pair at similarity 0.75
  shares no band with a chance of 1.2e-8.
- **Pairs.** Only the component matters, so a bucket first compares all its members with one leader, and
  with other leaders while that finds links. A hot bucket of true copies so costs a row per member.
  Members of a bucket that are then still in different components are compared by finer signatures, in
  blocks of a bucket and within tasks: each pair in the first bucket it shares. Only pairs that come
  within five standard deviations of the threshold leave the task.
- **Verification.** Links are confirmed on the full shingle sets, recomputed from the two texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import drop_stage, stage, unique_texts
from gridscout.llm.components import components

SHINGLE = 5
BANDS, ROWS = 48, 4
STAR_ROUNDS = 6
LEAST_YIELD = 0.1  # links per tested pair that make another round of leaders worthwhile
PERCENT = 75
FINE = 768  # coordinates, one byte each, of the finer signatures
DEVIATIONS = 5
BLOCK = 2_000  # members of a bucket that one task compares with as many
CELL_ROWS = 10_000


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id, n_shingles, component_id, kept, class_id) per document.

    Texts are lower-cased in A-Z and split into words `[^\\x20\\x09-\\x0D]+`. A document's set holds
    its distinct runs of `shingle` words; with fewer words, the whole sequence. Two documents are
    linked if 100 * intersection >= percent * union. component_id: the smallest id reachable over
    links. class_id: the smallest id with the same set. kept: id = component_id.

    A null, empty or blank text has an empty set, 0 shingles and no links: it is kept. The smallest id,
    a whole number, decides, so there are no ties. Several rows of one id count as one, see
    `unique_texts`; rows without an id are left out. An empty table gives an empty table. Other columns
    of `docs` play no part, whatever they are called.
    """
    texts = unique_texts(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    marks = stage(texts.mapInArrow(_marks(shingle, bands, rows), "id long, n long, c0 long, c1 long, bands array<long>"))
    classes = stage(marks.where("n > 0").groupBy("c0", "c1").agg(F.min("id").alias("rep")))
    reps = marks.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    buckets = _shared_buckets(reps)
    # what the comparisons read: the documents that share a bucket at all, their texts shuffled once here
    compared = stage(texts.join(buckets.select("id").distinct(), "id", "left_semi"))
    labels = _linked(buckets, marks, compared, shingle, percent)
    drop_stage(buckets, compared)
    named = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("c0", "c1", "rep", F.coalesce("comp", "rep").alias("comp"))
    out = marks.select("id", "n", F.when(F.col("n") > 0, F.col("c0")).alias("c0"), "c1").join(named, ["c0", "c1"], "left")
    comp = F.coalesce("comp", "id")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), comp.alias("component_id"), (F.col("id") == comp).alias("kept"), F.coalesce("rep", "id").alias("class_id")
    )


def _shared_buckets(reps: DataFrame) -> DataFrame:
    """(key, id, n) for the buckets with at least two documents. A staged table."""
    members = reps.select("id", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most").select("key")
    return stage(members.join(shared, "key").select("key", "id", "n"))


def _linked(buckets: DataFrame, marks: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, comp) of all documents with a link."""
    labels = stage(buckets.sparkSession.createDataFrame([], "id long, comp long"))
    tested = None
    for turn in range(STAR_ROUNDS):
        members = stage(_mixed(buckets, labels))
        if members.isEmpty():
            return labels
        order = F.col("id") if turn == 0 else F.xxhash64("id", F.lit(turn))
        leaders = members.groupBy("key").agg(F.min(F.struct(order.alias("o"), "id", "n", "comp")).alias("x"))
        leaders = leaders.select("key", *[F.col(f"x.{c}").alias(f"{c}2") for c in ("id", "n", "comp")])
        close = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent
        pairs = members.join(leaders, "key").where((F.col("comp") != F.col("comp2")) & close)
        pairs = pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()
        pairs = stage(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        labels, n_links = _with_links(pairs, texts, labels, shingle, percent)
        tested = pairs if tested is None else tested.unionByName(pairs)
        drop_stage(members)
        if not n_links >= LEAST_YIELD * pairs.count() > 0:
            break
    members = stage(_mixed(buckets, labels))
    if not members.isEmpty():
        pairs = stage(_close_pairs(members, marks, texts, shingle, percent))
        labels, _ = _with_links(pairs, texts, labels, shingle, percent)
        drop_stage(pairs)
    drop_stage(members, *([tested] if tested is not None else []))
    return labels


def _with_links(pairs: DataFrame, texts: DataFrame, labels: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, int]:
    """The labels after the links among `pairs`, and the number of these."""
    links = stage(_verified(pairs, texts, shingle, percent))
    n = links.count()
    labels = components(links, labels) if n else labels
    drop_stage(links)
    return labels, n


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, id, n, comp): the buckets with members of different components."""
    members = buckets.join(labels, "id", "left").select("key", "id", "n", F.coalesce("comp", "id").alias("comp"))
    mixed = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return members.join(mixed, "key").select("key", "id", "n", "comp")


def _close_pairs(members: DataFrame, marks: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b): pairs that share a bucket, are of different components, and may be linked."""
    ids = members.select("id").distinct()
    fine = texts.join(ids, "id", "left_semi").mapInArrow(_fine(shingle), "id long, fine binary")
    fine = fine.join(marks.join(ids, "id", "left_semi").select("id", "bands"), "id")
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    n_rows = sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0]  # each member meets every block of its bucket
    large = sizes.where("blocks > 1").select("key", "blocks")
    rows = members.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", "id", "n", "comp", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).join(fine, "id")
    cells = max(1, n_rows // CELL_ROWS)
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(cells)))
    return rows.groupBy("cell").applyInArrow(_near_in_buckets(percent), "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets."""
    # the text of b goes to the pair first; many pairs may have one a, whose text then meets them in parts
    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return with_both.select("a", "b", "text_a", "text_b").mapInArrow(_compare(shingle, percent), "a long, b long")


# -- in tasks


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row."""
    data = W.LOWER[data]
    starts, ends, bounds = W.find_words(data, offsets)
    hashes = W.hash_words(data, starts, ends)
    runs = W.hash_runs(hashes, size)
    out = []
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        if hi - lo >= size:
            own = np.sort(runs[lo : hi - size + 1])
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            out.append(own[new])
        elif hi > lo:  # the number of words, so that it equals no shorter or longer sequence
            out.append(W.hash_runs(hashes[lo:hi], int(hi - lo)) ^ W.U64(hi - lo))
        else:
            out.append(np.zeros(0, W.U64))
    return out


def _permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of 32-bit numbers; overwrites x."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """k x rows: circulant MinHash of each set; an empty one has the largest value everywhere."""
    out = np.full((k, len(sets)), 0xFFFFFFFF, np.uint32)
    full = [i for i, x in enumerate(sets) if len(x)]
    if not full:
        return out
    sizes = np.array([len(sets[i]) for i in full])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    places = _permute((np.concatenate([sets[i] for i in full]) >> np.uint64(32)).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    moved = np.empty_like(places)
    for shift in range(k):
        np.subtract(places, np.uint32(shift + 1), out=moved)
        out[shift, full] = np.minimum.reduceat(_permute(moved, 0x7FEB352D, 0x846CA68B), begins)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """rows x bands: one 64-bit key for each band and its values."""
    keys = np.empty((signature.shape[1], bands), np.int64)
    for band in range(bands):
        key = np.full(signature.shape[1], band, W.U64)
        for value in signature[band * rows : (band + 1) * rows]:
            key = W.mix((key << np.uint64(32) | key >> np.uint64(32)) ^ value)
        keys[:, band] = key.view(np.int64)
    return keys


def _marks(shingle: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in W.sliced(batch.column("text")):
                sets = shingle_sets(data, offsets, shingle)
                keys = band_keys(signatures(sets, bands * rows), bands, rows)
                whole = [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]
                c = np.frombuffer(b"".join(whole), "<i8").reshape(-1, 2)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands), pa.int32()), pa.array(keys.ravel()))
                columns = [batch.column("id").slice(lo, hi - lo), pa.array([len(x) for x in sets], pa.int64()), pa.array(c[:, 0].copy()), pa.array(c[:, 1].copy()), lists]
                yield pa.record_batch(columns, ["id", "n", "c0", "c1", "bands"])

    return run


def _fine(shingle: int):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in W.sliced(batch.column("text")):
                low = np.ascontiguousarray((signatures(shingle_sets(data, offsets, shingle), FINE) & np.uint32(255)).astype(np.uint8).T)
                yield pa.record_batch([batch.column("id").slice(lo, hi - lo), W.binary(list(low))], ["id", "fine"])

    return run


def _near_in_buckets(percent: int):
    share = percent / 100
    least = share - DEVIATIONS * (share * (1 - share) / FINE) ** 0.5
    least = FINE * (least + (1 - least) / 256)  # other bytes agree by chance

    def run(rows: pa.Table) -> pa.Table:
        key, lo, hi, block, ids, n, comp = (rows.column(c).to_numpy() for c in ("key", "lo", "hi", "block", "id", "n", "comp"))
        fine = W.unpack(rows.column("fine"), np.uint8).reshape(len(ids), -1)
        bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        order = np.lexsort((ids, hi, lo, key))
        edges = np.flatnonzero(np.diff(key[order], prepend=key[order[:1]] - 1) | np.diff(lo[order], prepend=0) | np.diff(hi[order], prepend=0))
        found: list[tuple] = []
        for begin, end in zip(edges, [*edges[1:], len(order)], strict=True):
            own = order[begin:end]
            for k, i in enumerate(own[:-1]):
                j = own[k + 1 :]
                ok = (comp[j] != comp[i]) & (100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i]))
                if lo[i] != hi[i]:
                    ok &= block[j] != block[i]
                j = j[ok]
                j = j[np.count_nonzero(fine[j] == fine[i], axis=1) >= least]
                if len(j):  # each pair in the first bucket it shares
                    j = j[bands[i, np.argmax(bands[j] == bands[i], axis=1)] == key[i]]
                    found += zip([ids[i]] * len(j), ids[j], strict=True)
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return run


def _compare(shingle: int, percent: int):
    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in "ab")
            data_a, offsets_a = W.text_bytes(batch.column("text_a"))
            last, set_a, linked = None, None, []
            for lo, hi, data, offsets in W.sliced(batch.column("text_b")):
                for row, set_b in enumerate(shingle_sets(data, offsets, shingle), lo):
                    if a[row] != last:
                        own = data_a[offsets_a[row] : offsets_a[row + 1]]
                        last, set_a = a[row], shingle_sets(own, np.array([0, len(own)]), shingle)[0]
                    if 100 * min(len(set_a), len(set_b)) < percent * max(len(set_a), len(set_b)):
                        continue
                    both = len(np.intersect1d(set_a, set_b, assume_unique=True))
                    if 100 * both >= percent * (len(set_a) + len(set_b) - both) and both:
                        linked.append(row)
            yield pa.record_batch([pa.array(a[linked], pa.int64()), pa.array(b[linked], pa.int64())], ["a", "b"])

    return run
