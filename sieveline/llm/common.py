"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the blank and the five control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode, where nobody else has to see it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_folder()
    return folder.rstrip("/")


def stored(df: DataFrame, what: str, *partition_by: str) -> DataFrame:
    """Writes ``df`` to a new folder under the shared one and reads it back, which cuts its lineage."""
    path = f"{shared_folder(df.sparkSession)}/llm-{what}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: Iterable[str], wish: str) -> str:
    """``wish``, or with underscores after it, so that it names none of ``columns`` (Spark's names ignore case)."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def is_held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a missing id counts as the text ``null``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % folds == fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of each class that are not held out.

    Which ones is settled by a digest of the id.  Null ids, null labels and labels other than 0 and 1 are left out; where an id
    has several labels the larger counts, where it has several rows the text with the smallest hash.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~is_held_out(F.col("doc_id"), folds, held_out))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    place = F.md5(F.col("doc_id").cast("string").cast("binary"))
    chosen = [known.where(F.col("label") == c).orderBy(place, "doc_id").limit(per_class) for c in (0, 1)]
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * per_class rows at most
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")
