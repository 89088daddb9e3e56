"""Detections over stored days: reach from daily sketches, rarity from a count table that grows day by day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sieveline.functions.clock import bucket_start
from sieveline.functions.scores import ratio
from sieveline.operators import sketches
from sieveline.operators.heavy import same_keys
from sieveline.operators.lookup import attach_by_frequency
from sieveline.plans.coordinated import DISTINCT_WHO, FLAGGED_INFRA
from sieveline.sources import artifacts

NETWORK = ["asn"]
BUCKET = "bucket_ts"


class ReachStore:
    """Requests per network and day as sketches of their organisations and accounts, at one folder.

    ``width`` adds time buckets of that width as a group, for detections that look inside a day.
    """

    def __init__(self, spark: SparkSession, path: str, width: str | None = None, lg_k: int = sketches.LG_K):
        self.spark, self.path, self.width, self.lg_k = spark, path, width, lg_k
        self.by = [*NETWORK, *([BUCKET] if width else [])]

    def _sketched(self, requests: DataFrame) -> DataFrame:
        if self.width:
            requests = requests.withColumn(BUCKET, bucket_start("ts", self.width))
        seen = {"first_seen_ts": F.col("ts")}
        return sketches.daily_sketches(requests, "ts", self.by, DISTINCT_WHO, "requests", mins=seen, lg_k=self.lg_k)

    def add(self, requests: DataFrame) -> None:
        """Stores the days of ``requests``, each of which must be there whole."""
        sketches.store_days(self._sketched(requests), self.path)

    def schema(self, requests_like: DataFrame) -> StructType:
        """Columns of the store, from requests of which only the column types are used."""
        return self._sketched(requests_like).schema

    def united(self, requests_like: DataFrame, by: Sequence[str], first: date | None = None, last: date | None = None) -> DataFrame:
        """Reach by ``by`` over stored days; of ``requests_like`` only the column types are used."""
        days = sketches.read_days(self.spark, self.path, self.schema(requests_like), first, last)
        return sketches.unite(days, by, list(DISTINCT_WHO), "requests", mins=["first_seen_ts"])


def first_seen_infra(reach: DataFrame, enrichment: DataFrame, types: Sequence[str] = FLAGGED_INFRA) -> DataFrame:
    """First appearance and early spread of each network of the given types, from united ``reach`` by network."""
    about = enrichment.where(F.col("asn_type").isin(*types)).select(
        "asn", "asn_type", "provider_category", "provider_brand_bucket"
    )
    return reach.join(about, "asn").select(
        "asn", "asn_type", "provider_category", "provider_brand_bucket",
        "first_seen_ts", "requests", "distinct_orgs", "distinct_accounts",
    )


def tenant_diversity(reach: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Organisations and accounts sharing one network, from united ``reach`` by network."""
    return reach.join(enrichment.select("asn", "asn_type", "provider_brand_bucket"), "asn").select(
        "asn", "asn_type", "provider_brand_bucket", "distinct_orgs", "distinct_accounts", "requests",
        ratio(F.col("requests"), F.col("distinct_accounts"), 2).alias("reqs_per_account"),
    )


def synchronized_org_spikes(days: DataFrame, enrichment: DataFrame, types: Sequence[str] = FLAGGED_INFRA, min_orgs: int = 10) -> DataFrame:
    """Time buckets in which many organisations are active on one flagged provider bucket, from stored ``days`` with buckets.

    Sketches of a provider's networks are united, so an organisation on several of them counts once.
    """
    about = enrichment.where(F.col("asn_type").isin(*types)).select("asn", "asn_type", "provider_brand_bucket")
    spikes = sketches.unite(days.join(about, "asn"), [BUCKET, "provider_brand_bucket", "asn_type"], list(DISTINCT_WHO), "requests")
    return spikes.where(F.col("distinct_orgs") >= min_orgs).select(
        BUCKET, "provider_brand_bucket", "asn_type", F.col("requests").alias("reqs"),
        F.col("distinct_orgs").alias("orgs"), F.col("distinct_accounts").alias("accounts"),
    )


class DomainCounts:
    """How often each domain was queried, kept as versions of a bucketed table at one folder.

    A day is reduced to one row per domain before anything is shuffled, and meets the table bucket by bucket: the
    table itself is read in place, so the shuffle grows with the day and not with the history.  Counts saturate just
    above ``rare_threshold``, as more tells nothing about rarity; a popular domain is one that has got there.
    """

    KEY = "base_domain"
    SCHEMA = StructType([StructField(KEY, StringType()), StructField("queries", LongType())])

    def __init__(self, spark: SparkSession, path: str, rare_threshold: int, buckets: int = 64):
        self.spark, self.path, self.rare_threshold, self.buckets = spark, path, rare_threshold, buckets

    def _at(self, version: int) -> DataFrame:
        path = f"{self.path}/v{version}"
        if version == 0:
            return self.spark.createDataFrame([], self.SCHEMA)
        return artifacts.read_bucketed(self.spark, path, self.SCHEMA, [self.KEY], self.buckets)

    def with_rarity(self, day: DataFrame, version: int) -> DataFrame:
        """``day`` with ``rare_domain`` as a recount of all days up to this one would have it, and the next version stored.

        ``version`` is the number of days counted before; a day that failed half way is run again with the same number.
        Rows without a domain are neither rare nor counted.
        """
        today = day.where(F.col(self.KEY).isNotNull()).groupBy(self.KEY).agg(F.count(F.lit(1)).alias("today"))
        today = artifacts.staged(today, "day-domains")
        merged = self._merged(self._at(version), today)
        artifacts.write_bucketed(merged.select(self.KEY, "queries"), f"{self.path}/v{version + 1}", [self.KEY], self.buckets)
        counted = self._at(version + 1).join(today, self.KEY).select(self.KEY, "today", (F.col("queries") <= self.rare_threshold).alias("rare_domain"))
        flagged = attach_by_frequency(day, artifacts.staged(counted, "day-rarity"), self.KEY, "today")
        return flagged.withColumn("rare_domain", F.coalesce("rare_domain", F.lit(False))).drop("today")

    def _merged(self, before: DataFrame, today: DataFrame) -> DataFrame:
        """Counts after a day: a full outer join on the domain, for which the bucketed side needs no shuffle."""
        both = before.alias("b").join(today.alias("t"), same_keys("b", "t", [self.KEY]), "full")
        total = F.coalesce("b.queries", F.lit(0)) + F.coalesce("t.today", F.lit(0))
        return both.select(
            F.coalesce(f"b.{self.KEY}", f"t.{self.KEY}").alias(self.KEY), F.least(total, F.lit(self.rare_threshold + 1)).alias("queries")
        )
