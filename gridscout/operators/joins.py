"""Joins to a side with one row per key, safe where few keys hold most rows of the other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # rows of one key that one task may hold


def hot_keys(left: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(h0, h1, ..., salts): the keys with at least `hot_rows` rows.

    These can never be more than rows / hot_rows, 100,000 short rows at 10^11, so they may be broadcast.
    """
    counts = left.groupBy(*[F.col(c).alias(f"h{i}") for i, c in enumerate(on)]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    names = [f"h{i}" for i in range(len(on))]
    return (
        counts.where(F.col("_n") >= hot_rows)
        .select(*names, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    left_rows: int | None = None,
) -> DataFrame:
    """Join `left` to `right`, which has about one row per key `on`.

    A key held by many left rows is cut into parts by a hash of `spread_by`, a column set that
    tells the rows of one key apart; the right row of such a key is repeated once per part, in
    total no more than left rows / hot_rows times. The hash repeats exactly when a task is rerun.

    `left_rows`, where known, bounds the rows of `left`: with fewer than `hot_rows` no key is hot.
    """
    if left_rows is not None and left_rows < hot_rows:
        return left.join(right, on, how)
    hot = hot_keys(left, on, hot_rows)

    def marked(df: DataFrame) -> DataFrame:
        same = [F.col(c).eqNullSafe(F.col(f"h{i}")) for i, c in enumerate(on)]
        condition = same[0]
        for s in same[1:]:
            condition = condition & s
        return df.join(F.broadcast(hot), condition, "left").drop(*[f"h{i}" for i in range(len(on))])

    part = F.when(
        F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int")
    ).otherwise(0)
    parts = F.when(
        F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)
    ).otherwise(F.array(F.lit(0)))
    parted_left = marked(left).withColumn("_part", part).drop("_salts")
    parted_right = marked(right).withColumn("_part", F.explode(parts)).drop("_salts")
    return parted_left.join(parted_right, [*on, "_part"], how).drop("_part")
