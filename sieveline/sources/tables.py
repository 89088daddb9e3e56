"""Discovery, loading, checking and counting of telemetry tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sieveline.sources.schemas import SCHEMAS

SHARED = ("enrichment_ip", "accounts", "orgs", "devices")
REQUIRED = {
    "coordinated": (*SHARED, "llm_requests", "moderation_events"),
    "takeover": (*SHARED, "identity_events"),
    "dns": ("dns_events",),
    "cluster": ("k8s_audit_logs", "resource_metrics", "network_flows"),
}
OPTIONAL = ("sessions", "rate_limit_events", "osint_observations")


class MissingTables(RuntimeError):
    """A strict run lacks tables its pack reads."""


def discover(spark: SparkSession, directory: str) -> dict[str, str]:
    """``{table: path}`` of the Parquet files or Parquet directories in ``directory``, by name.

    Spark lists the files, whatever store they are in; contents are not read.
    """
    root, suffix = directory.rstrip("/"), ".parquet"
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    try:
        files = reader.load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no such data directory: {directory}") from None
    below = F.element_at(F.split("path", f"{re.escape(root)}/"), -1)
    names = files.select(F.split(below, "/")[0].alias("name")).distinct().where(F.col("name").endswith(suffix))
    found = [r.name for r in names.collect()]  # one for each table
    return {name.removesuffix(suffix): f"{root}/{name}" for name in sorted(found)}


def file_states(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, str]:
    """For each table a text that changes whenever a file of it is added, removed, resized or written again.

    Listed by Spark: names, sizes and times of the files are digested where they are listed, contents are not read.
    """
    states = {}
    for name, path in paths.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        each = F.xxhash64("path", "length", "modificationTime")
        n, digest = files.agg(F.count(F.lit(1)), F.bit_xor(each)).first()
        states[name] = f"{n}-{digest}"
    return states


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: cast where present, NULL where absent.

    Malformed values of a castable column become NULL instead of failing the read.
    """
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def load(spark: SparkSession, directory: str, register: bool = False) -> dict[str, DataFrame]:
    """Every discovered table, conformed to its declared schema if it has one.

    ``register`` makes each a temporary view of its name, replacing any view of that name.
    """
    tables = {}
    for name, path in discover(spark, directory).items():
        df = spark.read.parquet(path)
        tables[name] = conform(df, SCHEMAS[name]) if name in SCHEMAS else df
        if register:
            tables[name].createOrReplaceTempView(name)
    return tables


def missing(available: Iterable[str], pack: str) -> list[str]:
    have = set(available)
    return [t for t in REQUIRED[pack] if t not in have]


def require(available: Iterable[str], pack: str) -> None:
    lacking = missing(available, pack)
    if lacking:
        raise MissingTables(f"pack {pack!r} lacks tables {lacking}; found {sorted(available)}")


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def with_optional(spark: SparkSession, tables: Mapping[str, DataFrame], register: bool = False) -> dict[str, DataFrame]:
    """``tables`` plus an empty typed stand-in for each optional table that is absent, as a view too with ``register``."""
    stand_ins = {name: empty(spark, name) for name in OPTIONAL if name not in tables}
    if register:
        for name, df in stand_ins.items():
            df.createOrReplaceTempView(name)
    return {**tables, **stand_ins}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: name and row count (columns are pruned from the scans)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in sorted(tables.items())
    ]
    return reduce(DataFrame.unionByName, counts)
