"""Redirect pages: which article a title stands for."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.operators.joins import HOT_ROWS, join_unique
from gridscout.sources.tables import stage

RECURSION_LEVELS = 100


def redirect_edges(pages: DataFrame) -> DataFrame:
    """(id, source, target) of the redirect pages."""
    return pages.where("is_redirect").select("id", F.col("title").alias("source"), "target")


def real_articles(pages: DataFrame) -> DataFrame:
    """(id, title, text) of the pages that are not redirects."""
    return pages.where(~F.col("is_redirect")).select("id", "title", "text")


def unique_edges(edges: DataFrame) -> DataFrame:
    """One edge per source, that of the lowest page id."""
    first = edges.groupBy("source").agg(F.min(F.struct("id", "target")).alias("e"))
    return first.select("e.id", "source", "e.target")


def follow_edges(edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, source, target, is_cycle): edges, a staged table with one per source, with the end of their chain.

    Each round lets every open edge take over the target its target has by then, so a chain of n
    edges closes in about log2(n) rounds. An edge is closed once its target is no source. A round
    that closes none leaves only edges in or leading into a cycle. Closed edges are staged once.
    """
    n_edges = edges.count()
    again = (
        edges.select("target")
        .distinct()
        .join(edges.select(F.col("source").alias("target")), "target", "left_semi")
        .withColumn("again", F.lit(True))
    )
    first = join_unique(edges, again, ["target"], ["source"], "left", hot_rows, n_edges)
    state = stage(
        first.select("id", "source", "target", F.col("again").isNull().alias("closed"))
    )
    closed, open_edges = [state.where("closed")], state.where(~F.col("closed"))
    n_open = open_edges.count()
    while n_open:
        known = reduce(DataFrame.unionByName, closed, open_edges).select(
            F.col("source").alias("target"),
            F.col("target").alias("next_target"),
            F.col("closed").alias("next_closed"),
        )
        step = join_unique(
            open_edges.select("id", "source", "target"),
            known,
            ["target"],
            ["source"],
            "inner",
            hot_rows,
            n_open,
        )
        state = stage(
            step.select(
                "id",
                "source",
                F.col("next_target").alias("target"),
                F.col("next_closed").alias("closed"),
            )
        )
        closed.append(state.where("closed"))
        open_edges = state.where(~F.col("closed"))
        n_before, n_open = n_open, open_edges.count()
        if n_open == n_before:
            break
    ended = reduce(DataFrame.unionByName, closed, open_edges)
    return ended.select("id", "source", "target", (~F.col("closed")).alias("is_cycle"))


def follow_edges_recursive(edges: DataFrame, hot_rows: int = HOT_ROWS, levels: int = RECURSION_LEVELS) -> DataFrame:
    """`follow_edges` as one recursive query, which joins all edges with the ends reached so far, a level at a time.

    It takes as many levels as the longest chain has edges, and carries a row with the chain so far per edge and level,
    so it is for short chains. A chain that has no end after `levels`, or comes to a title again, counts as a cycle.
    """
    spark = edges.sparkSession
    limits = {"spark.sql.cteRecursionLevelLimit": str(levels + 2), "spark.sql.cteRecursionRowLimit": "-1"}
    before = {name: spark.conf.get(name) for name in limits}
    chains = """WITH RECURSIVE chains(id, source, target, level, seen) AS (
        SELECT id, source, target, 1, array(source) FROM {edges}
        UNION ALL
        SELECT c.id, c.source, e.target, c.level + 1, array_append(c.seen, c.target) FROM chains c JOIN {edges} e ON c.target = e.source
        WHERE c.level < {levels} AND NOT array_contains(c.seen, c.target)
      )
      SELECT id, source, max_by(target, level) AS target FROM chains GROUP BY id, source"""
    try:
        for name, value in limits.items():
            spark.conf.set(name, value)
        ends = stage(spark.sql(chains, edges=edges, levels=levels))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    sources = edges.select(F.col("source").alias("target"), F.lit(True).alias("_open"))
    n_edges = ends.count()
    return join_unique(ends, sources, ["target"], ["source"], "left", hot_rows, n_edges).select("id", "source", "target", F.col("_open").isNotNull().alias("is_cycle"))


def title_map(pages: DataFrame, hot_rows: int = HOT_ROWS, follow: Callable[[DataFrame, int], DataFrame] = follow_edges) -> DataFrame:
    """(id, title, article_title, article_id, is_cycle): what every title stands for.

    `id` is the id of the page with that title. Articles stand for themselves. A redirect has the
    lowest-id article at the end of its chain; `article_id` is null where there is none or the
    chain is a cycle.
    """
    articles = real_articles(pages).select("id", "title")
    ends = follow(stage(unique_edges(redirect_edges(pages))), hot_rows)
    n_ends = ends.count()
    wanted = ends.where(~F.col("is_cycle")).select(F.col("target").alias("title")).distinct()
    goals = (
        articles.join(wanted, "title", "left_semi")  # titles are nearly unique
        .groupBy(F.col("title").alias("target"))
        .agg(F.min("id").alias("article_id"))
        .withColumn("is_cycle", F.lit(False))
    )
    resolved = join_unique(ends, goals, ["target", "is_cycle"], ["source"], "left", hot_rows, n_ends)
    same = articles.select(
        "id",
        "title",
        F.col("title").alias("article_title"),
        F.col("id").alias("article_id"),
        F.lit(False).alias("is_cycle"),
    )
    return same.unionByName(
        resolved.select(
            "id",
            F.col("source").alias("title"),
            F.col("target").alias("article_title"),
            "article_id",
            "is_cycle",
        )
    )


def article_texts(
    titles: DataFrame,
    pages: DataFrame,
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    n_titles: int | None = None,
) -> DataFrame:
    """`titles`, at most `n_titles` where that is known, with the text of their article."""
    texts = real_articles(pages).select(F.col("id").alias("article_id"), "text")
    return join_unique(titles, texts, ["article_id"], ["id", "title"], how, hot_rows, n_titles)


def step_or_source(edges: DataFrame) -> DataFrame:
    """(source, target) after one step, duplicates kept: the target's own target where it is a
    redirect, else the *source*."""
    steps = edges.select(F.col("source").alias("target"), F.col("target").alias("next"))
    return join_unique(edges, steps, ["target"], ["source"]).select(
        "source",
        F.when(F.col("next").isNotNull(), F.col("next")).otherwise(F.col("source")).alias("target"),
    )


def unchanged_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row (n_same, n_before): pairs of equal edges, and edges before the step.

    Equal edges are counted on each side first, so a frequent edge costs one row, not n * m.
    """
    keys = ["source", "target"]
    n_after = after.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_after"))
    grouped = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return grouped.join(n_after, keys, "left").agg(
        F.coalesce(F.sum(F.col("n") * F.col("n_after")), F.lit(0)).alias("n_same"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_before"),
    )


def one_pass_titles(pages: DataFrame) -> DataFrame:
    """(title, article_title, text) after one `step_or_source`, bag semantics.

    Kept for comparison: a redirect to an article ends at itself, and so has no text.
    """
    edges = stage(redirect_edges(pages).select("source", "target"))
    after = step_or_source(edges)
    same = unchanged_count(edges, after).first()
    ends = edges if same.n_same == same.n_before else after
    articles = real_articles(pages).select("title", "text")
    texts = articles.withColumnRenamed("title", "target")
    resolved = join_unique(ends, texts, ["target"], ["source"]).select(
        F.col("source").alias("title"), F.col("target").alias("article_title"), "text"
    )
    return articles.select("title", F.col("title").alias("article_title"), "text").unionByName(resolved)
