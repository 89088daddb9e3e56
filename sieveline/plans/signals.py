"""Explainable signals: one scored row per detection result, and the overall risk.

Scorers are aggregations over the whole detection result rather than over the rows a
report keeps, so no signal changes with a report's row limit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.scores import band, clamp01, f1_score, ratio

SEVERITY_STEPS = [(70, "high"), (40, "medium")]
SIGNAL_SEVERITY_STEPS = [(80, "high"), (40, "medium")]
SIGNAL_COLUMNS = ["id", "title", "weight", "score_0_1", "score", "rationale", "evidence"]


@dataclass(frozen=True)
class Signal:
    """How one detection result becomes a score between 0 and 1."""

    id: str
    title: str
    weight: float
    metrics: Mapping[str, Column]
    score: Column
    rationale: tuple[str, ...]
    usable: Column | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None

    def of(self, result: DataFrame) -> DataFrame:
        """At most one row: nothing when the result is empty or lacks what the score needs."""
        rows = self.prepare(result) if self.prepare else result
        summary = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[c.alias(n) for n, c in self.metrics.items()])
        present = F.col("n_rows") > 0
        kept = summary.where(present if self.usable is None else present & self.usable)
        scored = kept.withColumn("score_0_1", self.score)
        template, *names = self.rationale
        pairs = [part for n in self.metrics for part in (F.lit(n), F.col(n).cast("string"))]
        return scored.select(
            F.lit(self.id).alias("id"),
            F.lit(self.title).alias("title"),
            F.lit(self.weight).alias("weight"),
            "score_0_1",
            F.bround(F.col("score_0_1") * 100, 1).alias("score"),
            F.format_string(template, *[F.col(n).cast("string") for n in names]).alias("rationale"),
            F.create_map(F.lit("rows"), F.col("n_rows").cast("string"), *pairs).alias("evidence"),
        )


def _top(order: list[str], field: str) -> Column:
    """``field`` of the row that is largest in ``order``."""
    return F.max(F.struct(*order))[field]


def _entities(column: str, condition: Column | None = None) -> Column:
    known = F.col(column).cast("string") != ""
    return F.count_distinct(F.when(known if condition is None else known & condition, F.col(column)))


def _reaching(column: str, threshold: float, below: float | None = None) -> Column:
    hit = F.col(column) >= threshold
    return F.count_if(hit if below is None else hit & (F.col(column) < below))


def _saturating(metric: str, full: float, start: float = 0) -> Column:
    return clamp01((F.col(metric) - F.lit(start)) / F.lit(float(full)))


def _funnel_rates(funnel: DataFrame) -> DataFrame:
    """Long funnel to warn and block counts of its busiest infrastructure group."""
    per_group = funnel.groupBy("asn_type", "provider_brand_bucket").agg(
        F.sum("events").alias("total"),
        F.sum(F.when(F.col("policy_action") == "warn", F.col("events")).otherwise(0)).alias("warn"),
        F.sum(F.when(F.col("policy_action") == "block", F.col("events")).otherwise(0)).alias("block"),
    )
    busiest = per_group.orderBy(F.desc("total"), F.desc("asn_type"), F.desc("provider_brand_bucket")).limit(1)
    return busiest.select(
        ratio(F.col("warn"), F.col("total")).alias("warn"), ratio(F.col("block"), F.col("total")).alias("block")
    )


def catalog(saturation: Mapping[str, tuple[float, float]] | None = None) -> dict[str, Signal]:
    """Scorer of each detection that has one; needs an active session, as columns do.

    ``saturation`` overrides, by detection, the span over which a count's score rises and the count it starts at.
    """

    def rising(detection: str, metric: str, full: float, start: float = 0) -> Column:
        return _saturating(metric, *(saturation or {}).get(detection, (full, start)))

    diversity = ["distinct_orgs", "distinct_accounts", "requests"]
    share = ["pct_hosting_vpn", "hosting_vpn_reqs", "total_reqs"]
    quality = F.when(
        F.col("precision").isNotNull() & F.col("recall").isNotNull(), f1_score(F.col("precision"), F.col("recall"))
    ).otherwise(2 * F.col("flagged_rate"))
    # Signal ids, titles, weights and saturation points.  Keyed by detection.
    return {
        "q03_tenant_diversity": Signal(
            "cross_tenant_diversity_asn", "Cross-tenant diversity on shared infrastructure", 1.2,
            {name: _top(diversity, name) for name in diversity},
            rising("q03_tenant_diversity", "distinct_orgs", 25, 5),
            ("One network serves %s organisations and %s accounts.", "distinct_orgs", "distinct_accounts"),
        ),
        "q02_pct_flagged_infra": Signal(
            "hosting_vpn_concentration", "Hosting/VPN concentration", 0.9,
            {"pct_hosting_vpn": _top(share, "pct_hosting_vpn"), "total_reqs": _top(share, "total_reqs")},
            clamp01(F.col("pct_hosting_vpn") / 100) * _saturating("total_reqs", 200),
            ("At least one account sends %s%% of %s requests from flagged infrastructure.", "pct_hosting_vpn", "total_reqs"),
            usable=F.col("pct_hosting_vpn").isNotNull(),
        ),
        "q06_sync_org_spikes": Signal(
            "synchronized_spikes", "Synchronized spikes across tenants", 1.0,
            {"reqs": _top(["reqs", "orgs"], "reqs"), "orgs": _top(["reqs", "orgs"], "orgs")},
            rising("q06_sync_org_spikes", "reqs", 500),
            ("The largest shared spike has %s requests from %s organisations.", "reqs", "orgs"),
        ),
        "q07_template_reuse": Signal(
            "template_reuse", "Template reuse across orgs", 0.8,
            {"orgs": F.max("orgs")}, rising("q07_template_reuse", "orgs", 10),
            ("One template is used in %s organisations.", "orgs"),
        ),
        "q08_content_cluster_spread": Signal(
            "content_cluster_spread", "Content cluster spread", 0.7,
            {"orgs": F.max("orgs")}, rising("q08_content_cluster_spread", "orgs", 12),
            ("One content cluster appears in %s organisations.", "orgs"),
        ),
        "q09_policy_funnel": Signal(
            "policy_funnel", "Policy funnel concentration", 0.6,
            {"warn_rate": F.max("warn"), "block_rate": F.max("block")},
            clamp01(0.8 * F.col("warn_rate") + 1.2 * F.col("block_rate")),
            ("The busiest provider group is warned at rate %s and blocked at rate %s.", "warn_rate", "block_rate"),
            prepare=_funnel_rates,
        ),
        "q11_rate_limit_summary": Signal(
            "rate_limit_pressure", "Rate limit / throttling pressure", 0.5,
            {
                "pct_throttled": ratio(
                    F.sum(F.when(F.col("enforcement_action") == "throttle", F.col("events")).otherwise(0)), F.sum("events")
                )
            },
            clamp01(1.2 * F.col("pct_throttled")),
            ("Share of enforcement events that throttle: %s.", "pct_throttled"),
        ),
        "q12_failed_login_bursts": Signal(
            "failed_login_bursts", "Failed Login Bursts", 1.0,
            {"max_burst": F.max("failures_in_10m")}, rising("q12_failed_login_bursts", "max_burst", 24, 6),
            ("The largest burst has %s failed sign-ins.", "max_burst"),
        ),
        "q13_new_asn_after_failures": Signal(
            "new_asn_after_failures", "New ASN Success After Failures", 1.5,
            {"account_count": _entities("account_id")}, rising("q13_new_asn_after_failures", "account_count", 15),
            ("%s accounts signed in from a new network after failures.", "account_count"),
        ),
        "q14_mfa_device_added": Signal(
            "mfa_manipulation", "MFA Device Manipulation", 1.3,
            {"account_count": _entities("account_id")}, rising("q14_mfa_device_added", "account_count", 10),
            ("%s accounts enrolled a second-factor device.", "account_count"),
        ),
        "q16_mailbox_rule_creation": Signal(
            "mailbox_rule_abuse", "Mailbox Rule Abuse", 1.2,
            {"account_count": _entities("account_id")}, rising("q16_mailbox_rule_creation", "account_count", 10),
            ("%s accounts created mailbox rules.", "account_count"),
        ),
        "q17_oauth_consent_grants": Signal(
            "oauth_consent_abuse", "OAuth Consent Abuse", 1.1,
            {"account_count": _entities("account_id")}, rising("q17_oauth_consent_grants", "account_count", 8),
            ("%s accounts granted application consent.", "account_count"),
        ),
        "q18_ato_chain_candidates": Signal(
            "ato_chain_detection", "Account Takeover Chain Detection", 2.0,
            {"high_risk_count": _reaching("risk_score", 80), "medium_risk_count": _reaching("risk_score", 50, 80)},
            rising("q18_ato_chain_candidates", "high_risk_count", 20),
            ("%s high-risk and %s medium-risk takeover chains.", "high_risk_count", "medium_risk_count"),
        ),
        "q24_dns_rollup": Signal(
            "dns_triage_detection", "DNS Triage Detection Quality", 1.5,
            {
                "precision": F.max("precision"),
                "recall": F.max("recall"),
                "flagged_events": F.max("flagged_events"),
                "total_dns_events": F.max("total_dns_events"),
                "flagged_rate": F.coalesce(ratio(F.max("flagged_events"), F.max("total_dns_events")), F.lit(0.0)),
            },
            clamp01(quality),
            ("%s of %s queries are flagged.", "flagged_events", "total_dns_events"),
        ),
        "q25_unusual_pod_creation": Signal(
            "unusual_pod_creation", "Unusual Pod Creation Patterns", 0.8,
            {"high_anomaly_count": _reaching("anomaly_score", 4)}, rising("q25_unusual_pod_creation", "high_anomaly_count", 15),
            ("%s creation spikes score 4 or more.", "high_anomaly_count"),
        ),
        "q26_non_standard_registries": Signal(
            "non_standard_registries", "Non-Standard Container Registries", 1.0,
            {"high_risk_count": _reaching("avg_risk_score", 4)}, rising("q26_non_standard_registries", "high_risk_count", 15),
            ("%s service account and registry pairs have an average risk of 4 or more.", "high_risk_count"),
        ),
        "q27_resource_anomalies": Signal(
            "resource_anomalies", "K8s Resource Anomalies", 1.2,
            {"critical_count": _reaching("resource_anomaly_score", 5)}, rising("q27_resource_anomalies", "critical_count", 20),
            ("%s pods show sustained high utilisation.", "critical_count"),
        ),
        "q28_mining_pool_egress": Signal(
            "mining_pool_egress", "Mining Pool Connections (DEFINITIVE)", 2.0,
            {"pod_count": _entities("pod_id")}, rising("q28_mining_pool_egress", "pod_count", 10),
            ("%s pods talk to known mining pools.", "pod_count"),
        ),
        "q29_service_account_abuse": Signal(
            "service_account_abuse", "Service Account Abuse", 1.1,
            {"high_abuse_count": _reaching("abuse_score", 5)}, rising("q29_service_account_abuse", "high_abuse_count", 15),
            ("%s service account origins score 5 or more.", "high_abuse_count"),
        ),
        "q30_correlated_signals": Signal(
            "correlated_k8s_signals", "Correlated K8s Attack Signals", 2.5,
            {"correlated_pod_count": _entities("pod_id", F.col("confidence_score") == 10)},
            rising("q30_correlated_signals", "correlated_pod_count", 10),
            ("%s pods show all three signals.", "correlated_pod_count"),
        ),
    }


def score_results(
    results: Mapping[str, DataFrame], saturation: Mapping[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Signals of every detection result that has a scorer; the others are skipped."""
    scorers = catalog(saturation)
    rows = [scorers[name].of(df) for name, df in sorted(results.items()) if name in scorers]
    if not rows:
        raise ValueError("none of the given detection results has a scorer")
    return reduce(DataFrame.unionByName, rows)


def ranked_signals(signals: DataFrame) -> DataFrame:
    """Signals by weighted contribution, with their own severity band."""
    contribution = F.col("weight") * F.col("score_0_1")
    banded = signals.withColumn("severity", band(F.col("score"), SIGNAL_SEVERITY_STEPS, "low"))
    return banded.orderBy(contribution.desc(), F.col("id"))


def overall_risk(signals: DataFrame) -> DataFrame:
    """Weighted mean of the signals as 0-100 with its severity; 0 and low when there are none."""
    mean = ratio(F.sum(F.col("weight") * F.col("score_0_1")), F.sum("weight"))
    return signals.agg(
        F.coalesce(F.bround(100 * mean, 0), F.lit(0.0)).cast("int").alias("overall_risk_score"),
        F.count(F.lit(1)).alias("signal_count"),
    ).withColumn("severity", band(F.col("overall_risk_score"), SEVERITY_STEPS, "low"))


# Additive weights of the cluster pack, risk levels and their advice.
ADDITIVE_WEIGHTS = {
    "q25_unusual_pod_creation": 0.15,
    "q26_non_standard_registries": 0.20,
    "q27_resource_anomalies": 0.25,
    "q28_mining_pool_egress": 0.40,
    "q29_service_account_abuse": 0.22,
    "q30_correlated_signals": 0.50,
}
ADDITIVE_LEVELS = [(0.40, "CRITICAL"), (0.25, "HIGH"), (0.15, "MEDIUM")]
ADDITIVE_ADVICE = {
    "CRITICAL": "Immediate investigation required - high confidence cryptomining detected",
    "HIGH": "Priority investigation - multiple abuse indicators present",
    "MEDIUM": "Review flagged pods and service accounts for anomalous behavior",
    "LOW": "Continue monitoring - isolated signals detected",
}


def additive_counts(results: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and weight of each cluster detection result."""
    rows = [
        results[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("signal"), "row_count", F.lit(weight).alias("weight")
        )
        for name, weight in ADDITIVE_WEIGHTS.items()
        if name in results
    ]
    if not rows:
        raise ValueError("no cluster detection result given")
    return reduce(DataFrame.unionByName, rows)


def additive_shares(counts: DataFrame, full: Column | float = 10.0) -> DataFrame:
    """Normalised and weighted score of each count; a detection with ``full`` rows reaches its whole weight."""
    share = F.least(F.lit(1.0), F.col("row_count") / (full if isinstance(full, Column) else F.lit(float(full))))
    return counts.select(
        "*",
        F.round(share, 3).alias("normalized_score"),
        F.round(share * F.col("weight"), 3).alias("weighted_score"),
        (share * F.col("weight")).alias("contribution"),
    )


def additive_signals(results: Mapping[str, DataFrame]) -> DataFrame:
    """Row count, normalised and weighted score of each cluster detection result."""
    return additive_shares(additive_counts(results))


def additive_risk(signals: DataFrame, *by: str) -> DataFrame:
    """Total of the additive scores with level and advice, for each ``by``."""
    total = F.round(F.sum("contribution"), 9)
    level = band(F.col("total"), ADDITIVE_LEVELS, "LOW")
    advice = F.create_map(*[F.lit(x) for pair in ADDITIVE_ADVICE.items() for x in pair])
    return signals.groupBy(*by).agg(total.alias("total")).withColumn("risk_level", level).select(
        *by, F.round("total", 3).alias("total_score"), "risk_level", advice[F.col("risk_level")].alias("recommendation")
    )


def no_signals(spark: SparkSession) -> DataFrame:
    """Empty signal table, for a pack run in which nothing could be scored."""
    return spark.createDataFrame(
        [],
        "id string, title string, weight double, score_0_1 double, score double, "
        "rationale string, evidence map<string,string>",
    )


def evidence_table(signals: DataFrame, keys: int | None = None) -> DataFrame:
    """Ranked signals with all evidence entries, or the first ``keys``, as readable text."""
    entries = F.map_entries("evidence") if keys is None else F.slice(F.map_entries("evidence"), 1, keys)
    text = F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), ", "
    )
    return ranked_signals(signals).select(
        "severity", "id", "title", "score", "weight", "rationale", text.alias("evidence_text")
    )
