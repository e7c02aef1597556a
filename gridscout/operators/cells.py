"""The best documents of a large table of free-text requests.

Postings of the requests' terms are dealt to parts by document, requests to blocks; a cell is one part and one block.
Within a cell the scores of a request are added up in one array over the part's documents, of which the k best
leave the cell. So hits, whose number grows with requests times documents, are neither shuffled nor kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridscout.functions import scoring as S
from gridscout.operators.index import Index
from gridscout.operators.joins import join_unique
from gridscout.sources.tables import stage

CELL_POSTINGS = 2_000_000  # postings of a part
CELL_TERMS = 1_000_000  # looked-up terms of a block of requests


def best_of_cells(index: Index, known: DataFrame, k: int, broadcast_rows: int) -> DataFrame:
    """(query_id, doc_id, units): of every request the k best documents of each part; equal ones by doc_id.

    `known`: query_id, bucket, term, field, mean_length, df, weight of terms that are in the index, a written table.
    """
    on = ["bucket", "term", "field"]
    distinct = known.groupBy(*on).agg(F.first("mean_length").alias("mean_length"), F.first("df").alias("df"))
    terms = stage(distinct.withColumn("term_id", F.monotonically_increasing_id()))
    size = terms.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("df"), F.lit(0)).alias("postings")).first()
    parts, blocks = -(-size.postings // CELL_POSTINGS) or 1, -(-known.count() // CELL_TERMS) or 1
    if size.n <= broadcast_rows:
        requests = known.join(F.broadcast(terms.select(*on, "term_id")), on)
        found = index.postings.join(F.broadcast(terms.drop("df")), on)
    else:
        requests = join_unique(known, terms.select(*on, "term_id"), on, ["query_id"], "inner")
        found = join_unique(index.postings, terms.drop("df"), on, ["doc_id"], "inner")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    requests = requests.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("_part", each(parts))
    found = found.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(parts))).withColumn("_block", each(blocks))
    cell = (F.col("_part") * blocks + F.col("_block")).cast("long").alias("cell")
    saturation = S.saturation(F.col("tf"), F.col("length"), F.col("mean_length")).alias("sat")
    requests, found = requests.select(cell, "query_id", "term_id", "weight"), found.select(cell, "doc_id", F.col("term_id").alias("term"), saturation)
    schema = StructType([requests.schema["query_id"], found.schema["doc_id"]]).add("units", "long")
    return requests.groupBy("cell").cogroup(found.groupBy("cell")).applyInArrow(_scorer(k), schema)


def _scorer(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda requests, found: _best(requests, found, k)


def _numbered(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in Spark's order, and the place of each row's value among them."""
    values = pc.unique(column)
    values = values.take(pc.sort_indices(values, null_placement="at_start"))
    return values, pc.index_in(column, value_set=values).to_numpy()


def _best(requests: pa.Table, found: pa.Table, k: int) -> pa.Table:
    docs, doc = _numbered(found["doc_id"])
    queries, query = _numbered(requests["query_id"])
    term, sat = found["term"].to_numpy(), found["sat"].to_numpy()
    order = np.lexsort((doc, term))
    term, doc, sat = term[order], doc[order], sat[order]
    repeated = bool(((term[1:] == term[:-1]) & (doc[1:] == doc[:-1])).any())  # an id that several documents have
    names, starts = np.unique(term, return_index=True)
    ends = np.append(starts[1:], len(term))
    wanted, weight = requests["term_id"].to_numpy(), requests["weight"].to_numpy()
    here = np.isin(wanted, names)
    query, place, weight = query[here], np.searchsorted(names, wanted[here]), weight[here]
    order = np.argsort(query, kind="stable")
    query, place, weight = query[order], place[order], weight[order]
    least = float(sat.min()) if len(sat) else 0.0
    units, out = np.zeros(len(docs), np.int64), []
    for own in np.split(np.arange(len(query)), np.flatnonzero(np.diff(query)) + 1) if len(query) else []:
        units[:] = 0
        nothing = []  # documents of terms that may add 0
        for p, w in zip(place[own].tolist(), weight[own].tolist(), strict=True):
            at = slice(starts[p], ends[p])
            add = np.floor(sat[at] * w * S.SCALE + 0.5).astype(np.int64)
            if repeated:
                np.add.at(units, doc[at], add)
            else:
                units[doc[at]] += add
            if least * w * S.SCALE < 1:
                nothing.append(doc[at])
        hit = np.flatnonzero(units)
        if nothing:
            hit = np.union1d(hit, np.concatenate(nothing))
        if len(hit) > k:
            hit = hit[units[hit] >= np.partition(units[hit], len(hit) - k)[len(hit) - k]]
            hit = hit[np.argsort(-units[hit], kind="stable")][:k]
        out.append((np.full(len(hit), query[own[0]]), hit, units[hit]))
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table({"query_id": queries.take(pa.array(columns[0])), "doc_id": docs.take(pa.array(columns[1])), "units": columns[2]})
