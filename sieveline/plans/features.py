"""Feature builds: DNS heuristics per domain, transition edges, unified sign-in events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.hosts import base_domain, domain_entropy, keyword_hit, last_label, suspicious_tld
from sieveline.functions.scores import flag
from sieveline.operators.lookup import attach_by_frequency, frequency
from sieveline.operators.neighbours import previous_value

# Default heuristic settings.
SUSPICIOUS_TLDS = (
    "xyz", "top", "icu", "club", "link", "click", "tk", "cf", "ml", "ga", "gq", "pw", "win", "loan", "date",
    "party", "racing", "stream", "bid", "trade", "accountant", "faith", "science", "download", "webcam",
)
KEYWORDS = (
    "login", "secure", "verification", "verify", "update", "account", "support", "auth", "office",
    "microsoft", "apple", "paypal", "bank", "wallet", "crypto", "giftcard", "helpdesk",
)
ENTROPY_THRESHOLD = 3.5
RARE_THRESHOLD = 5
SCORE_WEIGHTS = {"suspicious_tld": 2, "keyword_hit": 3, "high_entropy": 1, "rare_domain": 1}


@dataclass(frozen=True)
class DomainHeuristics:
    """Settings of the four domain heuristics and their weights."""

    tlds: Sequence[str] = SUSPICIOUS_TLDS
    keywords: Sequence[str] = KEYWORDS
    entropy_threshold: float = ENTROPY_THRESHOLD
    rare_threshold: int = RARE_THRESHOLD
    weights: dict[str, int] = field(default_factory=lambda: dict(SCORE_WEIGHTS))


def with_domain_parts(df: DataFrame, host: str = "host_raw") -> DataFrame:
    """Adds ``base_domain`` (last two labels) and its ``tld``."""
    return df.withColumn("base_domain", base_domain(F.col(host))).withColumn("tld", last_label(F.col("base_domain")))


def composite_score(weights: dict[str, int]) -> Column:
    """Weighted sum of the 0/1 heuristics named in ``weights``."""
    return sum((flag(F.col(name)) * weight for name, weight in weights.items()), F.lit(0)).cast("bigint")


def domain_features(df: DataFrame, heuristics: DomainHeuristics = DomainHeuristics(), domain: str = "base_domain") -> DataFrame:
    """One row per distinct domain: frequency, the four flags, entropy and composite score."""
    name = F.col(domain)
    counted = frequency(df.where(name.isNotNull()), domain, "domain_count")
    flagged = (
        counted.withColumn("suspicious_tld", suspicious_tld(last_label(name), heuristics.tlds))
        .withColumn("keyword_hit", keyword_hit(name, heuristics.keywords))
        .withColumn("entropy", domain_entropy(name))
        .withColumn("high_entropy", F.col("entropy") > heuristics.entropy_threshold)
        .withColumn("rare_domain", F.col("domain_count") <= heuristics.rare_threshold)
    )
    return flagged.withColumn("score", composite_score(heuristics.weights))


def with_dns_features(
    df: DataFrame, heuristics: DomainHeuristics = DomainHeuristics(), counted: DataFrame | None = None
) -> DataFrame:
    """Adds the domain heuristics to DNS rows that carry ``base_domain``.

    Entropy and matching run once per distinct domain rather than once per query; the
    frequency needed for rarity is also what keeps popular domains off a hot task.
    ``counted`` may name a cheaper frame with the same domains per row to count from.
    """
    features = domain_features(df if counted is None else counted, heuristics)
    return attach_by_frequency(df, features, "base_domain", "domain_count").drop("domain_count", "entropy")


def with_transition_edges(
    df: DataFrame,
    entity: Sequence[str] = ("account_id", "device_fingerprint"),
    order: Sequence[str] = ("ts",),
    max_gap: str | None = None,
) -> DataFrame:
    """Adds ``parent_domain``: the entity's previous domain, ``''`` when there is none."""
    edged = previous_value(df, entity, order, "base_domain", "parent_domain", max_gap=max_gap)
    return edged.withColumn("parent_domain", F.coalesce("parent_domain", F.lit("")))


def build_dns_events(
    queries: DataFrame,
    heuristics: DomainHeuristics = DomainHeuristics(),
    entity: Sequence[str] = ("account_id", "device_fingerprint"),
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """Full feature build from raw queries (``host_raw`` and entity columns)."""
    split = with_domain_parts(queries)
    edged = with_transition_edges(split, entity, order)
    return with_dns_features(edged, heuristics, counted=split).dropna(subset=["ts", "org_id", "account_id", "base_domain"])


def dns_summary(dns: DataFrame) -> DataFrame:
    """Row, label, rarity and edge counts of a DNS table."""
    return dns.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(flag(F.col("is_malicious"))), F.lit(0)).alias("malicious_events"),
        F.coalesce(F.sum(flag(~F.col("is_malicious"))), F.lit(0)).alias("benign_events"),
        F.coalesce(F.sum(flag(F.col("rare_domain"))), F.lit(0)).alias("rare_domains"),
        F.coalesce(F.sum(flag(F.col("parent_domain") != "")), F.lit(0)).alias("chains"),
    )


SIGNIN_REQUIRED = ["start_ts", "account_id", "org_id", "ip", "asn", "device_fingerprint"]


def signins_from_sessions(sessions: DataFrame, user_agent: str = "", campaign_id: str = "") -> DataFrame:
    """Session starts as successful, unlabelled sign-in events; incomplete sessions are dropped."""
    return sessions.dropna(subset=SIGNIN_REQUIRED).select(
        F.col("start_ts").alias("ts"), "org_id", "account_id", "ip", "asn", "device_fingerprint",
        F.lit(user_agent).alias("user_agent"),
        F.lit("auth.signin").alias("event_type"),
        F.lit("success").alias("outcome"),
        F.lit(campaign_id).alias("campaign_id"),
        F.lit(False).alias("is_attack"),
    )


def unified_identity_events(sessions: DataFrame, *others: DataFrame, user_agent: str = "") -> DataFrame:
    """Session sign-ins and other identity events as one table without keyless rows."""
    events = signins_from_sessions(sessions, user_agent)
    for other in others:
        events = events.unionByName(other.select(*events.columns))
    return events.dropna(subset=["ts", "org_id", "account_id"])
