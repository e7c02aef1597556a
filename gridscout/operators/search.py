"""Ranked search of a table of requests over an index.

A request's text and each of its must values are clauses. A document matches where every clause
has a term in it and every number is in range. Its score is the sum of the BM25 of all matching
terms, times the field weight for terms of the free text, plus 1 for every range.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridscout.functions import scoring as S
from gridscout.functions.tokens import tokens
from gridscout.operators.cells import best_of_cells
from gridscout.operators.index import NUMBER_CLASSES, Index, bucket_of, number_class
from gridscout.operators.joins import join_unique
from gridscout.operators.requests import parse_requests
from gridscout.sources.tables import local_table, stage

BROADCAST_ROWS = 100_000  # rows that may be sent to every executor
BROADCAST_BYTES = 32 << 20  # and their bytes
PUSHED_KEYS = 1_000  # document ids that are pushed to the scans as literals
MOST_FEW = 1_000  # requests, and
FEW_BYTES = 32 << 10  # bytes of all their texts, that become literals of the plans
SLICE_DF = 1_000_000  # postings of one term that one task may join when there are many clauses
PROBED = 200_000  # postings from which on it pays to find out which of them can't be among the best, and to keep what is read twice
BLOCK = 1_000  # requests of one term that are fanned out from one row
PARTS = 64  # parts of a request's hits that are cut to k first
MOST_WEIGHT = 1e6  # keeps sums of scores within a long


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def request_table(spark: SparkSession, text: str) -> DataFrame:
    return local_table(spark, [Row(query_id=0, q=text)], StructType().add("query_id", "long").add("q", "string"))


def _parsed(index: Index, requests: DataFrame, word_bounds: bool) -> DataFrame:
    """query_id, terms, must, ranges array<field, low, high>, n_clauses."""
    low = lambda m: F.struct(m["field"].alias("field"), m["bound"].alias("low"), F.lit(float("inf")).alias("high"))
    high = lambda m: F.struct(m["field"].alias("field"), F.lit(float("-inf")).alias("low"), m["bound"].alias("high"))
    parsed = parse_requests(requests, "q", word_bounds)
    return parsed.select(
        "query_id",
        tokens(F.col("text"), index.token_pattern).alias("terms"),
        F.transform(
            "must",
            lambda m: F.struct(
                m["field"].alias("field"), tokens(m["value"], index.token_pattern).alias("terms")
            ),
        ).alias("must"),
        F.concat(F.transform("mins", low), F.transform("maxs", high)).alias("ranges"),
        ((F.col("text") != "").cast("int") + F.size("must")).alias("n_clauses"),
    )


def clause_terms(parsed: DataFrame, weights: Mapping[str, float], buckets: int) -> DataFrame:
    """(query_id, n_clauses, clause, bucket, term, field, boost): what has to be looked up.

    Clause 0 is the free text, on every weighted field; a repeated term counts each time. Clauses
    1, 2, ... are the must values, on their own field with weight 1.
    """
    boosts = F.expr(
        "array("
        + ", ".join(
            f"named_struct('field', {_quoted(f)}, 'boost', {float(w)}D)" for f, w in weights.items()
        )
        + ")"
    )
    free = (
        parsed.select("query_id", "n_clauses", F.explode("terms").alias("term"))
        .withColumn("clause", F.lit(0))
        .select("*", F.inline(boosts))
    )
    must = parsed.select("query_id", "n_clauses", F.posexplode("must").alias("pos", "m")).select(
        "query_id",
        "n_clauses",
        F.explode("m.terms").alias("term"),
        (F.col("pos") + 1).alias("clause"),
        F.col("m.field").alias("field"),
        F.lit(1.0).alias("boost"),
    )
    keys = ["query_id", "n_clauses", "clause", "term", "field"]
    return (
        free.unionByName(must)
        .groupBy(*keys)
        .agg(F.sum("boost").alias("boost"))
        .withColumn("bucket", bucket_of("term", buckets))
    )


def _bytes(*columns: str) -> Column:
    """Bytes of the columns of all rows, as text."""
    return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*columns)))), F.lit(0))


@dataclass(frozen=True)
class Batch:
    """Requests taken apart. `few`: so few that their rows and terms are literals of the plans."""

    parsed: DataFrame
    n_requests: int
    few: bool
    ranged: bool  # any request has ranges
    range_only: bool  # any has nothing else
    mixed: bool  # any that can match is not free text only
    rows: list  # `parsed`, where they are few

    @property
    def ranges(self) -> list:
        return self.rows[0].ranges if len(self.rows) == 1 else []

    @staticmethod
    def of(index: Index, requests: DataFrame, word_bounds: bool, large: bool | None) -> Batch:
        parsed = _parsed(index, requests, word_bounds)
        if large is None:
            head = requests.select("q").limit(MOST_FEW + 1).agg(F.count(F.lit(1)).alias("n"), _bytes("q").alias("bytes")).first()
            large = head.n > min(MOST_FEW, BROADCAST_ROWS) or head.bytes > min(FEW_BYTES, BROADCAST_BYTES)
        if not large:
            rows = parsed.collect()
            local = local_table(requests.sparkSession, rows, parsed.schema)
            ranged = [r for r in rows if r.ranges]
            return Batch(local, len(rows), True, bool(ranged), any(not r.n_clauses for r in ranged), any(r.must or r.ranges for r in rows), rows)
        ranged, must = F.size("ranges") > 0, F.size("must") > 0
        found = parsed.agg(F.count(F.lit(1)).alias("n"), F.bool_or(ranged).alias("r"), F.bool_or(ranged & (F.col("n_clauses") == 0)).alias("only"), F.bool_or(ranged | must).alias("mixed")).first()
        return Batch(parsed, found.n, False, bool(found.r), bool(found.only), bool(found.mixed), [])


def _few_clauses(index: Index, rows: list[Row], weights: Mapping[str, float], schema: StructType) -> list[Row]:
    """`clause_terms` of a few requests taken apart."""
    boosts: dict[tuple, float] = {}
    for r in rows:
        clauses = [(0, term, field, float(w)) for term in r.terms for field, w in weights.items()]
        clauses += [(i, term, m.field, 1.0) for i, m in enumerate(r.must, 1) for term in m.terms]
        for clause, term, field, boost in clauses:
            key = (r.query_id, r.n_clauses, clause, term, field)
            boosts[key] = boosts.get(key, 0.0) + boost
    plain = StructType([f for f in schema if f.name != "bucket"])
    found = [Row(*plain.names)(*key, boost) for key, boost in boosts.items()]
    return local_table(index.docs.sparkSession, found, plain).withColumn("bucket", bucket_of("term", index.buckets)).collect()


def _looked_up(index: Index, batch: Batch, weights: Mapping[str, float]) -> tuple[DataFrame, list[str] | None]:
    """The clause rows whose term is in the index, with df, weight, and `bound`, the most units a posting of
    the term can add; and all terms, where these are few."""
    on = ["bucket", "term", "field"]
    terms = None
    if batch.few:
        schema = StructType([batch.parsed.schema["query_id"], batch.parsed.schema["n_clauses"]]).add("clause", "integer")
        schema = schema.add("term", "string").add("field", "string").add("boost", "double").add("bucket", "integer")
        rows = _few_clauses(index, batch.rows, weights, schema)
        clauses = F.broadcast(local_table(index.docs.sparkSession, rows, schema))
        terms = sorted({r.term for r in rows})
        found = index.term_stats.where(_at(terms, sorted({r.bucket for r in rows}))).join(clauses, on)
    else:
        clauses = clause_terms(batch.parsed, weights, index.buckets)
        found = join_unique(stage(clauses), index.term_stats, on, ["query_id", "clause"], "inner")
    most = 1 / (1 + S.K1 * ((1 - S.B) / F.col("max_tf") + S.B * F.col("min_ratio") / F.col("mean_length")))
    weight = F.col("boost") * S.idf(F.col("n_docs"), F.col("df"))
    known = found.join(F.broadcast(index.field_stats), "field").select(
        "query_id", "n_clauses", "clause", *on, "mean_length", "df", weight.alias("weight"), (F.ceil(weight * most * S.SCALE) + 1).cast("long").alias("bound")
    )
    return known, terms


def _at(terms: list[str], buckets: list[int]) -> Column:
    """The folders and terms that are read; none without terms."""
    return F.col("bucket").isin(buckets) & F.col("term").isin(terms) if terms else F.lit(False)


def _in_order(known: DataFrame, parsed: DataFrame) -> DataFrame:
    """`known` with `first` and `probe`, without the requests of which a clause has no known term.

    first: the rows of the clause with the fewest postings. Only documents of that clause can match, so the
    other clauses are looked up for these alone. probe: the rarest terms of a request that is free text only,
    up to a quarter of its postings.
    """
    of_query, keys = Window.partitionBy("query_id"), ["query_id", "clause"]
    by_df = of_query.orderBy("df", "term", "field").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = known.withColumn("_clause_df", F.sum("df").over(Window.partitionBy(*keys)))
    sized = sized.withColumns({"_clauses": F.size(F.collect_set("clause").over(of_query)), "_rarest": F.min(F.struct("_clause_df", "clause")).over(of_query)})
    sized = sized.withColumns({"_up_to": F.sum("df").over(by_df), "_all": F.sum("df").over(of_query)})
    free = parsed.where((F.col("n_clauses") == 1) & (F.size("must") == 0) & (F.size("ranges") == 0)).select("query_id", F.lit(True).alias("_free"))
    sized = sized.where(F.col("_clauses") == F.col("n_clauses")).join(free, "query_id", "left")
    first = F.col("clause") == F.col("_rarest.clause")
    probe = F.coalesce(F.col("_free"), F.lit(False)) & (F.col("_up_to") * 4 <= F.col("_all"))
    return sized.select(*known.columns, first.alias("first"), probe.alias("probe"))


def _few_in_order(known: list[Row], free: set) -> list[dict]:
    """`_in_order` of a few rows; `free`: the requests that are free text only."""
    out = []
    for query_id, own in _grouped(known, lambda r: r.query_id):
        sizes: dict[int, int] = {}
        for r in own:
            sizes[r.clause] = sizes.get(r.clause, 0) + r.df
        if len(sizes) < own[0].n_clauses:
            continue
        rarest, up_to, every = min((n, c) for c, n in sizes.items())[1], 0, sum(sizes.values())
        for r in sorted(own, key=lambda r: (r.df, r.term, r.field)):
            up_to += r.df
            out.append(r.asDict() | {"first": r.clause == rarest, "probe": query_id in free and up_to * 4 <= every})
    return out


def _few_below(ordered: list[dict], least: dict) -> list[dict]:
    """`ordered` where `least`, by query_id, says what a document of the request must score: the terms whose
    bounds together stay below that are no longer `first`, as no document is among the best by them alone.
    Adds `least`, and `rest`, the sum of their bounds."""
    out = []
    for query_id, own in _grouped(ordered, lambda r: r["query_id"]):
        needed, rest, rows = least.get(query_id), 0, []
        for r in sorted(own, key=lambda r: (r["bound"], r["term"], r["field"])):
            low = needed is not None and rest + r["bound"] < needed
            rest += r["bound"] * low
            rows.append(r | {"first": r["first"] and not low, "least": needed})
        out += [r | {"rest": rest} for r in rows]
    return out


def _grouped(rows: list, key) -> list[tuple]:
    found: dict = {}
    for r in rows:
        found.setdefault(key(r), []).append(r)
    return list(found.items())


def _posting_scores(index: Index, wanted: DataFrame, terms: list[str] | None, buckets: list[int] | None) -> DataFrame:
    """(query_id, n_clauses, doc_id, clause, units): one row per matching posting of every row of `wanted`.

    Many requests: those of one term are put into blocks, so that each posting is read, shuffled and
    scored once for a block of requests and fanned out behind the join. The postings of terms with more
    than SLICE_DF of them are dealt to that many tasks.
    """
    on = ["bucket", "term", "field"]
    saturation = S.saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    columns = ["query_id", "n_clauses", "doc_id", "clause", S.to_units(F.col("weight") * F.col("_sat")).alias("units")]
    request = ["query_id", "n_clauses", "clause", "weight"]
    if terms is not None:
        rows = index.postings.where(_at(terms, buckets))
        hits = rows.join(F.broadcast(wanted.select(*on, *request, "mean_length")), on)
        return hits.withColumn("_sat", saturation).select(*columns)
    known = wanted.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    counted = join_unique(wanted, known, on, ["query_id", "clause"], "inner")  # a word may be in most requests
    block = F.pmod(F.xxhash64("query_id", "clause"), F.ceil(F.col("_n") / BLOCK)).alias("_block")
    blocks = counted.select(*on, "mean_length", "df", block, F.struct(*request).alias("_request")).groupBy(*on, "_block")
    blocks = blocks.agg(F.first("mean_length").alias("mean_length"), F.first("df").alias("df"), F.collect_list("_request").alias("_requests"))
    # only frequent terms are cut; there are at most postings / SLICE_DF of them
    slices = F.ceil(F.col("df") / SLICE_DF).cast("int")
    frequent = index.term_stats.where(F.col("df") > SLICE_DF).select(*on, slices.alias("_of"))
    part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_of")).cast("int"), F.lit(0))
    parted = index.postings.join(F.broadcast(frequent), on, "left").withColumn("slice", part).drop("_of")
    blocks = blocks.withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("df")
    hits = parted.join(blocks, [*on, "slice"]).withColumn("_sat", saturation)
    return hits.select("doc_id", "_sat", F.inline("_requests")).select(*columns)


def _term_matches(index: Index, batch: Batch, weights: Mapping[str, float], k: int | None) -> DataFrame:
    """(query_id, doc_id, units) of the documents that match every clause of the request; with `k`, at least of
    the k best of every request that is free text only."""
    known, terms = _looked_up(index, batch, weights)
    spark, buckets = index.docs.sparkSession, None
    schema = StructType([*known.schema.fields]).add("first", "boolean").add("probe", "boolean")
    rows: list[dict] = []
    if batch.few:
        free = {r.query_id for r in batch.rows if r.n_clauses == 1 and not r.must and not r.ranges}
        rows = _few_in_order(known.collect(), free)
        ordered, buckets = local_table(spark, rows, schema), sorted({r["bucket"] for r in rows})
    else:
        ordered = stage(_in_order(known, batch.parsed))

    def postings(which: str, value: bool = True) -> int:
        if batch.few:
            return sum(r["df"] for r in rows if r[which] == value)
        return ordered.where(F.col(which) == value).agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]

    def scores(wanted: DataFrame) -> DataFrame:
        return _posting_scores(index, wanted, terms, buckets)

    pairs, bounded = ["query_id", "doc_id"], False
    if k is not None and batch.few and postings("probe") >= k and postings("probe", False) >= PROBED:
        sums = scores(ordered.where("probe")).groupBy(*pairs).agg(F.sum("units").alias("score"))
        least = top_k(sums, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        bounded = True
        rows = _few_below(rows, {r.query_id: r.least for r in least.collect()})
        ordered = local_table(spark, rows, StructType([*schema.fields]).add("least", "long").add("rest", "long"))
    n_first, n_rest = postings("first"), postings("first", False)

    def matched(scored: DataFrame) -> DataFrame:
        found = _clause_matches(scored)
        twice = batch.few and batch.ranged and batch.n_requests > 1  # read for requests with ranges and for those without
        return stage(found) if twice and n_first + n_rest >= PROBED else found

    if not n_rest:
        return matched(scores(ordered))
    by_first = scores(ordered.where("first")).groupBy("query_id", "n_clauses", "doc_id", "clause").agg(F.sum("units").alias("units"))
    if bounded:
        reach = ordered.where("least IS NOT NULL").groupBy("query_id").agg(F.first("least").alias("least"), F.first("rest").alias("rest"))
        reached = by_first.join(F.broadcast(reach), "query_id", "left").where("least IS NULL OR units + rest >= least")
        by_first = reached.select(*by_first.columns)
    candidates = by_first.select(*pairs)
    if n_first <= BROADCAST_ROWS:
        candidates = F.broadcast(candidates)
    elif n_rest < 4 * n_first and not bounded:  # little to save
        return matched(scores(ordered))
    rest = scores(ordered.where("NOT first")).join(candidates, pairs, "left_semi")
    return matched(by_first.unionByName(rest))


def _clause_matches(scores: DataFrame) -> DataFrame:
    """(query_id, doc_id, units) of the documents that match every clause of the request.

    Postings of one document lie by term, so there is little to add up before the shuffle; one
    partitioning serves both groupings.
    """
    keys = ["query_id", "n_clauses", "doc_id"]
    by_clause = scores.repartition(*keys).groupBy(*keys, "clause").agg(F.sum("units").alias("units"))
    summed = by_clause.groupBy(*keys).agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("matched"))
    return summed.where(F.col("matched") == F.col("n_clauses")).select("query_id", "doc_id", "units")


def _wanted_ranges(parsed: DataFrame) -> DataFrame:
    """(query_id, n_ranges, wanted): a row per request with ranges, which are intersected by field; wanted: array<field,
    low, high, span, open>, the narrowest first by the number classes it spans. A request with a bound that is
    no number, or with an empty intersection, matches nothing and is left out."""
    bad = F.exists("ranges", lambda r: r["low"].isNull() | r["high"].isNull())
    each = parsed.where((F.size("ranges") > 0) & ~bad).select("query_id", F.size("ranges").alias("n_ranges"), F.explode("ranges").alias("r"))
    by_field = each.groupBy("query_id", "n_ranges", F.col("r.field").alias("field")).agg(
        F.max("r.low").alias("low"), F.min("r.high").alias("high"), F.bool_or(F.col("r.low") == float("-inf")).alias("open")
    )
    span = number_class(F.col("high")) - number_class(F.col("low"))
    lists = by_field.groupBy("query_id", "n_ranges").agg(F.array_sort(F.collect_list(F.struct(span.alias("span"), "field", "low", "high", "open"))).alias("wanted"))
    return lists.where(~F.exists("wanted", lambda r: r["low"] > r["high"]))


def _inside(positive_percentages: bool) -> Column:
    inside = F.col("value").between(F.col("low"), F.col("high"))
    if positive_percentages:
        inside = inside & (~F.col("field").contains("percentage") | ~F.col("open") | (F.col("value") > 0))
    return inside


def _within_ranges(index: Index, hits: DataFrame, fields: list[str] | None, positive_percentages: bool) -> DataFrame:
    """The `hits` (query_id, doc_id, units, wanted) with a number in every wanted range: each is looked up by field and
    document among the numbers of the wanted fields, and the ones met are counted."""
    numbers = index.numbers.select("doc_id", "field", "value")
    if fields is not None:
        numbers = numbers.where(F.col("field").isin(fields) if fields else F.lit(False))
    each = hits.select("query_id", "doc_id", "units", F.size("wanted").alias("_n"), F.inline("wanted"))
    met = each.join(numbers, ["doc_id", "field"]).where(_inside(positive_percentages))
    counted = met.groupBy("query_id", "doc_id").agg(F.first("units").alias("units"), F.first("_n").alias("_n"), F.count(F.lit(1)).alias("_met"))
    return counted.where("_met = _n").select("query_id", "doc_id", "units")


def _range_only_matches(index: Index, wanted: DataFrame, batch: Batch, fields: list[str] | None, positive_percentages: bool) -> DataFrame:
    """(query_id, doc_id, units) for requests made of ranges only, `units` being the ranges' number.

    The request's narrowest range is looked up by field and number class, an equi-join; what that finds
    is tested for the other ranges.
    """
    narrow = wanted.select("query_id", (F.col("n_ranges") * F.lit(S.SCALE)).cast("long").alias("units"), F.get("wanted", F.lit(0)).alias("r"), F.slice("wanted", 2, 1 << 20).alias("wanted"))
    narrow = narrow.select("query_id", "units", "wanted", "r.field", "r.low", "r.high", "r.open")
    classes = narrow.withColumn("number_class", F.explode(F.sequence(number_class(F.col("low")), number_class(F.col("high")))))
    rows = index.numbers if fields is None else index.numbers.where(F.col("field").isin(fields) if fields else F.lit(False))
    if batch.few and batch.n_requests * (2 * NUMBER_CLASSES + 1) <= BROADCAST_ROWS:
        classes = F.broadcast(classes)
    found = rows.join(classes, ["field", "number_class"]).where(_inside(positive_percentages)).select("query_id", "doc_id", "units", "wanted")
    if not batch.few:
        found = stage(found)
    more = _within_ranges(index, found.where(F.size("wanted") > 0), fields, positive_percentages)
    return found.where(F.size("wanted") == 0).select("query_id", "doc_id", "units").unionByName(more)


def _within_literal_ranges(index: Index, hits: DataFrame, ranges: list, positive_percentages: bool) -> DataFrame:
    """`hits` of a single request whose documents are in all ranges: the bounds reach the scan of `numbers`."""
    for field in dict.fromkeys(r["field"] for r in ranges):
        own = [r for r in ranges if r["field"] == field]
        if any(r["low"] is None or r["high"] is None for r in own) or index.numbers is None:
            return hits.where(F.lit(False))
        value = F.col("value")
        inside = (F.col("field") == field) & value.between(max(r["low"] for r in own), min(r["high"] for r in own))
        if positive_percentages and "percentage" in field and any(r["low"] == float("-inf") for r in own):
            inside = inside & (value > 0)
        hits = hits.join(index.numbers.where(inside).select("doc_id"), "doc_id", "left_semi")
    return hits


def _of_one_field(index: Index, parsed: DataFrame, field: str) -> DataFrame:
    """(query_id, doc_id, units) of all documents that have a number in the field, for a single request."""
    query_id = parsed.first().query_id
    kind = parsed.schema["query_id"].dataType
    return index.numbers.where(F.col("field") == field).select(F.lit(query_id).cast(kind).alias("query_id"), "doc_id", F.lit(0).cast("long").alias("units"))


def _matches(
    index: Index,
    requests: DataFrame,
    weights: Mapping[str, float],
    word_bounds: bool = False,
    positive_percentages: bool = False,
    large: bool | None = None,
    k: int | None = None,
) -> tuple[DataFrame, int]:
    """`matches` and the number of requests. With `k`, some documents may be missing that are not among the k best."""
    if any(not 0 <= w <= MOST_WEIGHT for w in weights.values()):
        raise ValueError(f"weights must be from 0 to {MOST_WEIGHT:g}")
    batch = Batch.of(index, requests, word_bounds, large)
    if k is None or batch.few:
        return _batch_matches(index, batch, weights, positive_percentages, k), batch.n_requests
    parsed, free = batch.parsed, (F.size("must") == 0) & (F.size("ranges") == 0)
    known, _ = _looked_up(index, replace(batch, parsed=parsed.where(free)), weights)
    best = best_of_cells(index, stage(known), k, BROADCAST_ROWS).select("query_id", "doc_id", S.from_units(F.col("units")).alias("score"))
    if batch.mixed:
        best = best.unionByName(_batch_matches(index, replace(batch, parsed=parsed.where(~free)), weights, positive_percentages, None))
    return best, batch.n_requests


def _batch_matches(index: Index, batch: Batch, weights: Mapping[str, float], positive_percentages: bool, k: int | None) -> DataFrame:
    """(query_id, doc_id, score) of what matches the requests of `batch`."""
    found = _term_matches(index, batch, weights, k)
    score = S.from_units(F.col("units"))
    if not batch.ranged:
        return found.select("query_id", "doc_id", score.alias("score"))
    parsed, positive = batch.parsed, positive_percentages
    if index.numbers is None:
        kept = found.join(parsed.where(F.size("ranges") == 0).select("query_id"), "query_id", "left_semi")
        return kept.select("query_id", "doc_id", score.alias("score"))
    if batch.few and batch.n_requests == 1:  # literal bounds reach the scan
        more = F.lit(len(batch.ranges) * S.SCALE)
        if batch.range_only:
            found = _of_one_field(index, parsed, batch.ranges[0]["field"])
        kept = _within_literal_ranges(index, found, batch.ranges, positive).select("query_id", "doc_id", S.from_units(F.col("units") + more).alias("score"))
        return kept
    wanted = _wanted_ranges(parsed.select("query_id", "ranges", "n_clauses"))
    fields = None
    if batch.few:
        rows = wanted.collect()
        fields = sorted({r.field for row in rows for r in row.wanted})
        wanted = F.broadcast(local_table(index.docs.sparkSession, rows, wanted.schema))
    else:
        wanted, found = stage(wanted), stage(found)
    only = parsed.where("n_clauses = 0").select("query_id")
    mixed = wanted.join(only, "query_id", "left_anti")
    with_ranges = found.join(F.broadcast(mixed), "query_id") if batch.few else join_unique(found, mixed, ["query_id"], ["doc_id"], "inner")
    with_ranges = with_ranges.withColumn("units", F.col("units") + F.col("n_ranges") * F.lit(S.SCALE))
    kept = _within_ranges(index, with_ranges, fields, positive)
    free = parsed.where(F.size("ranges") == 0).select("query_id")
    kept = kept.unionByName(found.join(F.broadcast(free) if batch.few else free, "query_id", "left_semi").select("query_id", "doc_id", "units"))
    if batch.range_only:
        kept = kept.unionByName(_range_only_matches(index, wanted.join(only, "query_id", "left_semi"), batch, fields, positive))
    return kept.select("query_id", "doc_id", score.alias("score"))


def matches(
    index: Index, requests: DataFrame, weights: Mapping[str, float], **options
) -> DataFrame:
    """(query_id, doc_id, score) of every matching document of every request (query_id, q).

    `query_id` tells the requests apart. The requests are read several times: a table that is
    costly to compute should be written first.

    Options: `word_bounds` reads bounds as whole words; `positive_percentages` lets an upper bound
    on a percentage leave out values that are not above 0; `large` says whether the requests are a
    large table, which is found out where it is not given.
    """
    return _matches(index, requests, weights, **options)[0]


def top_k(hits: DataFrame, k: int = 10, parts: int = PARTS) -> DataFrame:
    """The k best hits per query with their rank; equal scores by doc_id.

    Cut to k per part of a query first, so that a query which matches a third of all documents
    is not ranked in one task.
    """
    order = [F.desc("score"), "doc_id"]
    within = hits.withColumn("_part", bucket_of("doc_id", parts))
    part = Window.partitionBy("query_id", "_part").orderBy(*order)
    kept = within.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    whole = Window.partitionBy("query_id").orderBy(*order)
    return (
        kept.drop("_part")
        .withColumn("rank", F.row_number().over(whole))
        .where(F.col("rank") <= k)
    )


def search(
    index: Index, requests: DataFrame, weights: Mapping[str, float], k: int = 10, **options
) -> DataFrame:
    """The k best documents of each request: query_id, rank, score, doc_id, stored columns."""
    hits, n_requests = _matches(index, requests, weights, k=k, **options)
    return with_stored(index, top_k(hits, k), n_requests * k)


def search_one(
    index: Index, text: str, weights: Mapping[str, float], k: int = 10, **options
) -> DataFrame:
    """`search` for one request text; the cut to k needs no sort of all hits."""
    large = len(text) > FEW_BYTES
    hits, _ = _matches(index, request_table(index.docs.sparkSession, text), weights, large=large, k=k, **options)
    best = hits.orderBy(F.desc("score"), "doc_id").limit(k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    if k > PUSHED_KEYS:
        return with_stored(index, ranked, k)
    ranked = ranked.withColumn("bucket", bucket_of("doc_id", index.buckets))
    rows = ranked.collect()  # at most k, whose ids and folders reach the scan of the stored columns
    ranked = local_table(index.docs.sparkSession, rows, ranked.schema)
    return with_stored(index, ranked, k, rows)


def with_stored(index: Index, best: DataFrame, n_hits: int, known: list | None = None) -> DataFrame:
    """Hits with the stored columns of their documents; `n_hits` bounds the rows of `best`, `known` are these
    rows, with their bucket, where they are few.

    Both sides have the bucket of the doc_id, so a short list of hits prunes the folders of `docs`
    that are read.
    """
    hits = best.withColumn("bucket", bucket_of("doc_id", index.buckets))
    if n_hits <= BROADCAST_ROWS:
        hits = F.broadcast(hits)
    stored = [c for c in index.docs.columns if c not in ("doc_id", "bucket")]
    docs = index.docs
    if known is not None:
        docs = docs.where(F.col("bucket").isin(sorted({r.bucket for r in known})) & F.col("doc_id").isin([r.doc_id for r in known]) if known else F.lit(False))
    return docs.join(hits, ["bucket", "doc_id"]).select("query_id", "rank", "score", "doc_id", *stored)


def total_hits(hits: DataFrame, requests: DataFrame) -> DataFrame:
    """(query_id, n_hits) for every request, 0 where nothing matches."""
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"))
    return requests.select("query_id").join(counts, "query_id", "left").select(
        "query_id", F.coalesce("n_hits", F.lit(0)).alias("n_hits")
    )
