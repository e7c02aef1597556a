"""Tables between stages: staged Parquet, read-through reuse, TSV."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

TSV = {
    "sep": "\t",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def work_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: `spark.checkpoint.dir` of the session, or where that is
    unset a folder in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/gridscout-work"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def local_path(spark: SparkSession, path: str) -> str | None:
    """Where `path` lies in the file system that all machines have mounted; None if it lies in another store."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def mark_complete(spark: SparkSession, path: str) -> None:
    """The mark that Spark's writers leave in a folder that is written."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(hadoop_path).close()


_scopes: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged within are removed at the end; by then what reads them must be written."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def stage(df: DataFrame) -> DataFrame:
    """Write `df` to a new staged table and read it back: cuts lineage, survives lost executors,
    and gives the optimiser the real size."""
    path = f"{work_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[Row] | list[dict], schema: StructType) -> DataFrame:
    """A few rows as a table that is part of the plan; no job is needed to read or broadcast it."""
    table = pa.Table.from_pylist([r if isinstance(r, dict) else r.asDict(recursive=True) for r in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders at `path`; none if it does not exist."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.listStatus(hadoop_path) if system.exists(hadoop_path) else []
    return [f.getPath().getName() for f in found if f.isDirectory()]


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], arguments: dict | None = None
) -> DataFrame:
    """Read the Parquet table at `path`, building and writing it first if it is not complete.

    `arguments`, what the table was made from, is kept beside it; a table made from others is an error.
    Tables staged on the way are removed.
    """
    made_from = json.dumps(arguments or {}, sort_keys=True)
    record = f"{path}/_arguments"  # readers of the table pass over it
    if not path_exists(spark, f"{path}/_SUCCESS"):
        with staging(spark):
            build().write.mode("overwrite").parquet(path)
        spark.range(1).select(F.lit(made_from).alias("value")).repartition(1).write.mode("overwrite").text(record)
    elif path_exists(spark, record):
        kept = spark.read.text(record).first().value
        if kept != made_from:
            raise ValueError(f"{path} was made from {kept}, not from {made_from}")
    return spark.read.parquet(path)


def _on_one_line(value: Column) -> Column:
    """Line ends as \\n and \\r, backslashes doubled: a value never ends a line, so files stay splittable."""
    for plain, code in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        value = F.replace(value, F.lit(plain), F.lit(code))
    return value


def _with_line_ends(value: Column) -> Column:
    parts = F.split(value, r"\\\\", -1)  # at two backslashes
    restored = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(restored, "\\")


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """TSV with header. One file only on request: that is one writing task, for small exports.

    Line ends in texts are written as \\n and \\r, a backslash as two.
    """
    coded = df.withColumns({f.name: _on_one_line(F.col(f.name)) for f in df.schema if f.dataType == StringType()})
    out = coded.repartition(1) if single_file else coded
    out.write.options(**TSV).mode("overwrite").csv(path)


def read_tsv(spark: SparkSession, path: str, schema: StructType, defaults: str | None = None) -> DataFrame:
    """TSV of `write_tsv` by declared schema. An empty field reads as null, or as `defaults` where given."""
    df = spark.read.options(**TSV).schema(schema).csv(path)
    df = df.withColumns({f.name: _with_line_ends(F.col(f.name)) for f in schema if f.dataType == StringType()})
    return df if defaults is None else df.fillna(defaults)


def with_columns_or(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """Exactly the columns of `defaults`; one that is missing, or null in a row, gets its default."""
    return df.select(
        *[
            (F.coalesce(F.col(c), F.lit(d)) if c in df.columns else F.lit(d)).alias(c)
            for c, d in defaults.items()
        ]
    )
