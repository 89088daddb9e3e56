"""DNS triage over queries that already carry the domain heuristics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scores import band, flag, ratio
from sieveline.operators.confusion import confusion_sums, with_quality
from sieveline.operators.spread import spread_profile

HEURISTICS = ("suspicious_tld", "keyword_hit", "high_entropy", "rare_domain")


def _flag_sums(suffix: str, names: tuple[str, ...] = HEURISTICS) -> dict[str, Column]:
    return {f"{name}_{suffix}": flag(F.col(name)) for name in names}


def top_suspicious_domains(dns: DataFrame) -> DataFrame:
    """Scored domains with reach, heuristic counts and a sample host."""
    profile = spread_profile(
        dns.where(F.col("score") > 0),
        ["base_domain", "tld"],
        {"affected_accounts": "account_id", "affected_orgs": "org_id"},
        rows="query_count",
        sums={"score_sum": F.col("score"), **_flag_sums("count")},
        maxs={"max_score": F.col("score")},
        sample_min={"sample_host": "host_raw"},
    )
    return profile.withColumn("avg_score", ratio(F.col("score_sum"), F.col("query_count"))).select(
        "base_domain", "tld", "query_count", "affected_accounts", "affected_orgs", "avg_score", "max_score",
        *[f"{name}_count" for name in HEURISTICS], "sample_host",
    )


def domain_chain_clusters(dns: DataFrame, min_occurrences: int = 3) -> DataFrame:
    """Recurring parent-to-child domain transitions and their risk category."""
    edges = dns.where(F.col("parent_domain") != "").withColumnRenamed("base_domain", "child_domain")
    profile = spread_profile(
        edges, ["parent_domain", "child_domain"], {"affected_accounts": "account_id"}, rows="chain_occurrences",
        sums={"score_sum": F.col("score"), "scored": F.col("score").isNotNull().cast("bigint")},
    ).where(F.col("chain_occurrences") >= min_occurrences)
    mean = ratio(F.col("score_sum"), F.col("scored"))
    category = band(F.col("avg_child_score"), [(4, "high_risk_chain"), (2, "medium_risk_chain")], "low_risk_chain")
    return profile.withColumn("avg_child_score", mean).select(
        "parent_domain", "child_domain", "chain_occurrences", "affected_accounts", "avg_child_score",
        category.alias("chain_risk_category"),
    )


def exposed_accounts(dns: DataFrame, min_domains: int = 2) -> DataFrame:
    """Accounts and devices that queried several suspicious domains."""
    keys = ["account_id", "org_id", "device_fingerprint"]
    flags = ("suspicious_tld", "keyword_hit", "high_entropy")
    profile = spread_profile(
        dns.where(F.col("score") > 0), keys, {"distinct_suspicious_domains": "base_domain"}, rows="n",
        sums={"total_risk_score": F.col("score"), **_flag_sums("queries", flags)},
        mins={"first_suspicious_query": F.col("ts")},
        maxs={"max_risk_score": F.col("score"), "last_suspicious_query": F.col("ts")},
    ).where(F.col("distinct_suspicious_domains") >= min_domains)
    return profile.withColumn("avg_risk_score", ratio(F.col("total_risk_score"), F.col("n"))).select(
        *keys, "distinct_suspicious_domains", "total_risk_score", "avg_risk_score", "max_risk_score",
        *[f"{name}_queries" for name in flags], "first_suspicious_query", "last_suspicious_query",
    )


def heuristic_breakdown(dns: DataFrame) -> DataFrame:
    """How often each heuristic fired, and how many queries reached each score; one scan."""
    per_score = dns.groupBy("score").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(flag(F.col(name))).alias(name) for name in HEURISTICS]
    )
    totals = per_score.agg(*[F.sum(name).alias(name) for name in HEURISTICS])
    fired = totals.unpivot([], list(HEURISTICS), "heuristic", "trigger_count")
    spread = per_score.select(
        F.concat(F.lit("SCORE_DIST_"), F.col("score").cast("string")).alias("heuristic"),
        F.col("n").alias("trigger_count"),
    )
    return fired.unionByName(spread)


def dns_rollup(dns: DataFrame) -> DataFrame:
    """One-row summary with precision and recall of ``score > 0`` against the label."""
    terms = confusion_sums(F.col("score"), F.col("is_malicious"))
    counts = spread_profile(
        dns, [], {"distinct_domains": "base_domain", "distinct_accounts": "account_id"},
        rows="total_dns_events", sums=terms,
    )
    return with_quality(
        counts.select("total_dns_events", "distinct_domains", "distinct_accounts", *terms)
    )
