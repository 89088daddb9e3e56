"""Streaming forms of the two windowed detections.

Both emit a window once the watermark passes it (append mode) and give the rows of
their batch counterparts for the windows that are closed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.spread import first_non_null
from sieveline.plans.coordinated import FLAGGED_INFRA
from sieveline.plans.takeover import ENTITY, SIGNIN


def failed_login_buckets(
    identity: DataFrame, width: str = "10 minutes", min_failures: int = 6, lateness: str = "10 minutes"
) -> DataFrame:
    """Bursts of failed sign-ins per account from a stream of identity events."""
    failed = identity.where((F.col("event_type") == SIGNIN) & (F.col("outcome") == "failure"))
    windows = failed.withWatermark("ts", lateness).groupBy(F.window("ts", width).alias("w"), *ENTITY).agg(
        F.count(F.lit(1)).alias("failures_in_10m"),
        F.min("ts").alias("first_fail_ts"),
        F.max("ts").alias("last_fail_ts"),
        first_non_null("ip", ["ts"]).alias("sample_fail_ip"),
        first_non_null("asn", ["ts"]).alias("sample_fail_asn"),
    )
    return windows.where(F.col("failures_in_10m") >= min_failures).select(
        *ENTITY, F.col("w.start").alias("bucket_start"), "failures_in_10m", "first_fail_ts", "last_fail_ts",
        "sample_fail_ip", "sample_fail_asn",
    )


def synchronized_org_spikes(
    requests: DataFrame,
    enrichment: DataFrame,
    types: Sequence[str] = FLAGGED_INFRA,
    width: str = "15 minutes",
    min_orgs: int = 10,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Many organisations on one flagged provider bucket, from a stream of requests.

    Exact distinct counts come from chained aggregations: one row per organisation and account,
    then one per organisation and one per account, then one per window.  An account that is
    active in several organisations counts once.
    """
    about = enrichment.where(F.col("asn_type").isin(*types)).select("asn", "asn_type", "provider_brand_bucket")
    infra = ["provider_brand_bucket", "asn_type"]
    per_account = (
        requests.withWatermark("ts", lateness)
        .join(about, "asn")
        .groupBy(F.window("ts", width).alias("w"), *infra, "org_id", "account_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    org, account = (
        F.struct(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("id"), n.cast("bigint").alias("n"))
        for kind, column, n in (("org", "org_id", F.col("n")), ("account", "account_id", F.lit(0)))
    )
    tagged = per_account.withColumn("tag", F.explode(F.array(org, account))).select("w", *infra, "tag.*")
    per_id = tagged.groupBy(F.window(F.window_time("w"), width).alias("w"), *infra, "kind", "id").agg(F.sum("n").alias("n"))
    spikes = per_id.groupBy(F.window(F.window_time("w"), width).alias("w"), *infra).agg(
        F.sum("n").alias("reqs"),
        F.count(F.when(F.col("kind") == "org", F.col("id"))).alias("orgs"),
        F.count(F.when(F.col("kind") == "account", F.col("id"))).alias("accounts"),
    )
    return spikes.where(F.col("orgs") >= min_orgs).select(
        F.col("w.start").alias("bucket_ts"), *infra, "reqs", "orgs", "accounts"
    )
