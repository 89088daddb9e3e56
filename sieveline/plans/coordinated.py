"""Coordinated activity: many accounts and organisations behind shared infrastructure.

Inputs are a request fact table and an ASN dimension with one row per ASN.  Every
detection reduces the requests by ASN (or device) before it meets the dimension, so
the join moves aggregated rows only and needs no broadcast of unknown size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.clock import bucket_start
from sieveline.functions.scores import flag, ratio
from sieveline.operators.baseline import group_zscore
from sieveline.operators.spread import spread_profile

FLAGGED_INFRA = ("hosting", "vpn")
WHO = {"orgs": "org_id", "accounts": "account_id"}
DISTINCT_WHO = {"distinct_orgs": "org_id", "distinct_accounts": "account_id"}


def _flagged(enrichment: DataFrame, types: Sequence[str]) -> DataFrame:
    return enrichment.where(F.col("asn_type").isin(*types))


def first_seen_infra(requests: DataFrame, enrichment: DataFrame, types: Sequence[str] = FLAGGED_INFRA) -> DataFrame:
    """First appearance and early spread of each ASN of the given types."""
    per_asn = spread_profile(
        requests, ["asn"], DISTINCT_WHO, rows="requests", mins={"first_seen_ts": F.col("ts")}
    )
    about = _flagged(enrichment, types).select("asn", "asn_type", "provider_category", "provider_brand_bucket")
    return per_asn.join(about, "asn").select(
        "asn", "asn_type", "provider_category", "provider_brand_bucket",
        "first_seen_ts", "requests", "distinct_orgs", "distinct_accounts",
    )


def flagged_infra_share(requests: DataFrame, enrichment: DataFrame, types: Sequence[str] = FLAGGED_INFRA) -> DataFrame:
    """Percentage of each account's requests that come from flagged infrastructure."""
    per_origin = requests.groupBy("asn", "account_id", "org_id").agg(F.count(F.lit(1)).alias("n"))
    typed = per_origin.join(enrichment.select("asn", "asn_type"), "asn")
    hits = F.when(F.col("asn_type").isin(*types), F.col("n")).otherwise(F.lit(0))
    totals = typed.groupBy("account_id", "org_id").agg(
        F.sum("n").alias("total_reqs"), F.sum(hits).alias("hosting_vpn_reqs")
    )
    return totals.withColumn(
        "pct_hosting_vpn", F.round(ratio(100.0 * F.col("hosting_vpn_reqs"), F.col("total_reqs")), 2)
    )


def tenant_diversity(requests: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Organisations and accounts sharing one ASN."""
    per_asn = spread_profile(requests, ["asn"], DISTINCT_WHO, rows="requests")
    about = enrichment.select("asn", "asn_type", "provider_brand_bucket")
    return per_asn.join(about, "asn").select(
        "asn", "asn_type", "provider_brand_bucket", "distinct_orgs", "distinct_accounts", "requests",
        ratio(F.col("requests"), F.col("distinct_accounts"), 2).alias("reqs_per_account"),
    )


def device_reuse(requests: DataFrame, devices: DataFrame, min_accounts: int = 5) -> DataFrame:
    """Device fingerprints shared by several accounts; unknown devices are kept."""
    per_device = spread_profile(requests, ["device_fingerprint"], DISTINCT_WHO, rows="requests").where(
        F.col("distinct_accounts") >= min_accounts
    )
    about = devices.select("device_fingerprint", "is_headless", "browser_family", "os_family")
    return per_device.join(about, "device_fingerprint", "left").select(
        "device_fingerprint", "is_headless", "browser_family", "os_family",
        "distinct_accounts", "distinct_orgs", "requests",
    )


def burst_zscore(requests: DataFrame, enrichment: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Request bursts per ASN: z-score of each non-empty bucket against the ASN's own buckets."""
    bucketed = requests.select("asn", bucket_start("ts", width).alias("bucket_ts"), "org_id", "account_id")
    buckets = spread_profile(bucketed, ["asn", "bucket_ts"], WHO, rows="reqs")
    scored = group_zscore(buckets, ["asn"], "reqs").where(F.col("zscore").isNotNull())
    about = enrichment.select("asn", "asn_type", "provider_brand_bucket")
    return scored.join(about, "asn").select(
        "asn", "asn_type", "provider_brand_bucket", "bucket_ts", "reqs", "accounts", "orgs",
        F.round("zscore", 2).alias("zscore"),
    )


def synchronized_org_spikes(
    requests: DataFrame,
    enrichment: DataFrame,
    types: Sequence[str] = FLAGGED_INFRA,
    width: str = "15 minutes",
    min_orgs: int = 10,
) -> DataFrame:
    """Time buckets in which many organisations are active on one flagged provider bucket."""
    reduced = (
        requests.select("asn", bucket_start("ts", width).alias("bucket_ts"), "org_id", "account_id")
        .groupBy("asn", "bucket_ts", "org_id", "account_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    about = _flagged(enrichment, types).select("asn", "asn_type", "provider_brand_bucket")
    return (
        reduced.join(about, "asn")
        .groupBy("bucket_ts", "provider_brand_bucket", "asn_type")
        .agg(
            F.sum("n").alias("reqs"),
            F.count_distinct("org_id").alias("orgs"),
            F.count_distinct("account_id").alias("accounts"),
        )
        .where(F.col("orgs") >= min_orgs)
    )


def _reuse(requests: DataFrame, key: str) -> DataFrame:
    seen = {"first_seen_ts": F.col("ts")}
    profile = spread_profile(
        requests, [key], {"accounts": "account_id", "orgs": "org_id"}, rows="reqs",
        mins=seen, maxs={"last_seen_ts": F.col("ts")},
    )
    return profile.select(key, "reqs", "accounts", "orgs", "first_seen_ts", "last_seen_ts")


def template_reuse(requests: DataFrame, min_accounts: int = 8) -> DataFrame:
    """Prompt templates used by many accounts."""
    return _reuse(requests, "template_hash").where(F.col("accounts") >= min_accounts)


def content_cluster_spread(requests: DataFrame) -> DataFrame:
    """Reach of each content cluster."""
    return _reuse(requests, "content_cluster_id")


def policy_funnel(requests: DataFrame, enrichment: DataFrame, moderation: DataFrame) -> DataFrame:
    """Moderation outcomes by infrastructure type and provider bucket."""
    origin = requests.select("request_id", "asn", "org_id", "account_id")
    outcome = moderation.select("request_id", "policy_action")
    reduced = (
        origin.join(outcome, "request_id")
        .groupBy("asn", "policy_action", "account_id", "org_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    about = enrichment.select("asn", "asn_type", "provider_brand_bucket")
    return (
        reduced.join(about, "asn")
        .groupBy("asn_type", "provider_brand_bucket", "policy_action")
        .agg(
            F.sum("n").alias("events"),
            F.count_distinct("account_id").alias("accounts"),
            F.count_distinct("org_id").alias("orgs"),
        )
    )


def cluster_keys(
    requests: DataFrame, enrichment: DataFrame, min_orgs: int = 5, min_accounts: int = 8
) -> DataFrame:
    """Investigation keys joining infrastructure, device, content cluster and template."""
    keys = ["device_fingerprint", "content_cluster_id", "template_hash"]
    reduced = requests.groupBy("asn", *keys, "org_id", "account_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(flag(F.col("is_automation_suspected"))).alias("automated"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    about = enrichment.select("asn", "asn_type", "provider_brand_bucket")
    return (
        reduced.join(about, "asn")
        .groupBy("asn_type", "provider_brand_bucket", *keys)
        .agg(
            F.sum("n").alias("reqs"),
            F.count_distinct("org_id").alias("orgs"),
            F.count_distinct("account_id").alias("accounts"),
            F.sum("automated").alias("automation_flags"),
            F.min("first_ts").alias("first_seen_ts"),
            F.max("last_ts").alias("last_seen_ts"),
        )
        .where((F.col("orgs") >= min_orgs) & (F.col("accounts") >= min_accounts))
    )


def rate_limit_summary(rate_limits: DataFrame) -> DataFrame:
    """Enforcement by scope; an empty account id marks infrastructure-wide enforcement."""
    scope = F.when(F.col("account_id") == "", F.lit("infra")).otherwise(F.lit("account"))
    return spread_profile(
        rate_limits.select(scope.alias("scope"), "enforcement_action", "asn", "account_id"),
        ["scope", "enforcement_action"],
        {"asns": "asn", "accounts": "account_id"},
        rows="events",
    )
