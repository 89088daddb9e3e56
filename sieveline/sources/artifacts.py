"""Artifact sinks and their re-read: CSV with header, zstd Parquet (plain, or bucketed for joins without a shuffle), JSON."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="sieveline-")


def work_folder(spark: SparkSession, what: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share; a temporary one only in local mode without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to a new work folder and read back, so that its plan runs once, whatever reads it."""
    path = work_folder(df.sparkSession, what)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Text sinks keep microseconds, which Spark's own formats cut to milliseconds.
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, **TEXT_TIMES).csv(path)


def write_parquet(df: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    df.write.mode("overwrite").option("compression", "zstd").option(
        "maxRecordsPerFile", max_records_per_file
    ).parquet(path)


def _bucketed_name(path: str) -> str:
    """The catalog name under which a session knows the bucketed table at ``path``."""
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, dealt: bool = False) -> DataFrame:
    """Writes ``df`` hashed into ``buckets`` by ``keys`` and sorted inside them, one file each, and reads it back.

    Two tables with the same keys (of equal types) and buckets join on these keys without a shuffle.  Rows of one key share
    a bucket, so the keys should be many and none of them hot.  ``dealt`` says that ``df`` comes from such a join, dealt out
    by bucket as it is, and is not shuffled again.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_bucketed_name(path)}")
    dealt = df if dealt else df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    writer = dealt.write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).format("parquet").saveAsTable(_bucketed_name(path))
    return spark.table(_bucketed_name(path))


def read_bucketed(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """The table that :func:`write_bucketed` left at ``path``, in this or another session."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    names = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_bucketed_name(path)} ({columns}) USING parquet"
        f" CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(_bucketed_name(path))


def write_record(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    """One row as a JSON folder; it is there as a whole or not at all."""
    write_json(spark.createDataFrame([row], schema).coalesce(1), path)


def read_record(spark: SparkSession, path: str, schema: str) -> Row | None:
    """The row that :func:`write_record` left at ``path``; None where there is none."""
    try:
        return spark.read.schema(schema).json(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**TEXT_TIMES).json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Typed when a schema is given, otherwise every column as text; never an inference pass."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
