"""What the operators share: the tables, one row per id, the size of the input, removal of staged tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscout.sources.tables import remove, stage, work_dir

__all__ = ["documents", "drop_stage", "held_out", "partitions", "remove", "stage", "table", "text_size", "unique_texts", "work_folder"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def unique_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(id, text, more...): one row per id. Rows without an id are left out, as nothing can refer to
    them. Of several rows with one id, the one with the smallest (text, more...) counts, null last.

    Only ids are counted for this; texts are shuffled only where an id repeats.
    """
    more = tuple(c for c in dict.fromkeys(more) if c not in (id_col, text_col))
    rows = docs.select(F.col(id_col), F.col(text_col), *more).where(F.col(id_col).isNotNull())
    repeated = rows.groupBy(id_col).count().where("count > 1").select(id_col)
    if repeated.isEmpty():
        return rows
    least = F.min(F.struct(F.col(text_col).isNull().alias("_null"), text_col, *more)).alias("_row")
    chosen = rows.join(repeated, id_col, "left_semi").groupBy(id_col).agg(least)
    chosen = chosen.select(id_col, *[F.col(f"_row.{c}").alias(c) for c in (text_col, *more)])
    return rows.join(repeated, id_col, "left_anti").unionByName(chosen)


def text_size(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts."""
    return docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(id_col: str, modulus: int, rest: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % modulus == rest


def drop_stage(*staged: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in staged:
        for path in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
            remove(df.sparkSession, path)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
