"""Kubernetes resource hijack: audit log, resource metrics and network flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.clock import business_hours, calendar_start, span_hours
from sieveline.functions.hosts import address_class, registry_domain
from sieveline.functions.scores import flag, points_if, tier
from sieveline.operators.spread import spread_profile

GB, MB = 1e9, 1e6


def _created(audit: DataFrame) -> DataFrame:
    return audit.where((F.col("event_type") == "pod_create") & F.col("response_code").between(200, 299))


def unusual_pod_creation(audit: DataFrame, unit: str = "hour", min_score: int = 4) -> DataFrame:
    """Creation spikes per calendar unit, namespace and service account, weighted by off-hours use."""
    off_hours = F.when(business_hours(F.col("timestamp")), F.lit(0)).otherwise(F.lit(1))
    created = _created(audit).withColumn("hour", calendar_start(audit, "timestamp", unit))
    keys = ["hour", "namespace", "service_account"]
    spikes = spread_profile(
        created, keys, {"unique_images": "container_image"}, rows="pod_creation_count",
        sums={
            "off_hours_count": off_hours,
            "total_cpu_requested": F.col("resource_requests_cpu"),
            "total_gpu_requested": F.col("resource_requests_gpu"),
        },
        maxs={"is_malicious": F.col("is_malicious")},
    )
    share = F.round(F.col("off_hours_count") / F.col("pod_creation_count") * 100, 1)
    score = (
        tier(F.col("pod_creation_count"), [(10, 3), (5, 2)], 1)
        + tier(F.col("off_hours_pct"), [(70, 2), (50, 1)])
        + tier(F.col("total_gpu_requested"), [(10, 2), (5, 1)])
    )
    scored = spikes.withColumn("off_hours_pct", share).withColumn("anomaly_score", score)
    return scored.where(F.col("anomaly_score") >= min_score).select(
        *keys, "pod_creation_count", "off_hours_count", "off_hours_pct", "unique_images",
        "total_cpu_requested", "total_gpu_requested", "anomaly_score", "is_malicious",
    )


def non_standard_registries(audit: DataFrame, min_score: int = 4) -> DataFrame:
    """Pods from external registries, scored per image and summed per registry domain."""
    images = (
        _created(audit).where(F.col("registry_type") == "external")
        .groupBy("namespace", "service_account", "container_image")
        .agg(
            F.count(F.lit(1)).alias("pods"),
            F.min("timestamp").alias("seen_from"),
            F.max("timestamp").alias("seen_to"),
            F.sum("resource_requests_cpu").alias("cpu"),
            F.sum("resource_requests_gpu").alias("gpu"),
            F.max("is_malicious").alias("label"),
        )
    )
    score = 3 + tier(F.col("gpu"), [(10, 3), (5, 2), (1, 1)]) + tier(F.col("pods"), [(10, 2), (5, 1)])
    risky = images.withColumn("risk_score", score).where(F.col("risk_score") >= min_score)
    # Images are unique per (namespace, service account), so counting rows counts images.
    return (
        risky.withColumn("registry_domain", registry_domain(F.col("container_image")))
        .groupBy("namespace", "service_account", "registry_domain")
        .agg(
            F.count("container_image").alias("unique_images"),
            F.sum("pods").alias("total_pods"),
            F.min("seen_from").alias("first_seen"),
            F.max("seen_to").alias("last_seen"),
            F.sum("cpu").alias("total_cpu_requested"),
            F.sum("gpu").alias("total_gpu_requested"),
            F.avg("risk_score").alias("avg_risk_score"),
            F.max("label").alias("is_malicious"),
        )
    )


def resource_anomalies(metrics: DataFrame, min_score: int = 5) -> DataFrame:
    """GPU pods with sustained high utilisation over a long life."""
    pods = (
        metrics.groupBy("namespace", "pod_id", "pod_name")
        .agg(
            F.avg("cpu_cores_used").alias("cpu"),
            F.max("cpu_cores_used").alias("max_cpu_cores"),
            F.avg("memory_gb_used").alias("memory"),
            F.avg("gpu_utilization_pct").alias("gpu"),
            F.max("gpu_utilization_pct").alias("max_gpu_utilization"),
            F.count(F.lit(1)).alias("sample_count"),
            F.min("timestamp").alias("seen_from"),
            F.max("timestamp").alias("seen_to"),
            F.max("is_malicious").alias("is_malicious"),
        )
        .where(F.col("gpu") > 0)
        .withColumn("lifetime", span_hours(F.col("seen_from"), F.col("seen_to")))
    )
    score = (
        tier(F.col("gpu"), [(85, 3), (75, 2), (65, 1)])
        + tier(F.col("cpu"), [(14, 3), (10, 2), (8, 1)])
        + tier(F.col("lifetime"), [(48, 2), (24, 1)])
    )
    scored = pods.withColumn("resource_anomaly_score", score).where(F.col("resource_anomaly_score") >= min_score)
    return scored.select(
        "namespace", "pod_id", "pod_name",
        F.round("cpu", 1).alias("avg_cpu_cores"), "max_cpu_cores",
        F.round("memory", 1).alias("avg_memory_gb"),
        F.round("gpu", 1).alias("avg_gpu_utilization"), "max_gpu_utilization",
        "sample_count", F.round("lifetime", 1).alias("lifetime_hours"),
        "resource_anomaly_score", "is_malicious",
    )


def mining_pool_egress(flows: DataFrame) -> DataFrame:
    """Traffic to known pools per pod and endpoint; any such row is conclusive."""
    keys = ["namespace", "pod_id", "pod_name", "dst_host", "dst_port"]
    pools = flows.where(F.col("is_mining_pool")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("connection_count"),
        F.sum("bytes_sent").alias("sent"),
        F.sum("bytes_received").alias("received"),
        F.avg("connection_duration_sec").alias("duration"),
        F.min("timestamp").alias("first_connection"),
        F.max("timestamp").alias("last_connection"),
        F.max("is_malicious").alias("is_malicious"),
    )
    return pools.select(
        *keys, "connection_count",
        F.round(F.col("sent") / GB, 2).alias("gb_sent"),
        F.round(F.col("received") / MB, 2).alias("mb_received"),
        F.round(F.col("duration") / 60, 1).alias("avg_duration_min"),
        "first_connection", "last_connection",
        F.round(span_hours(F.col("first_connection"), F.col("last_connection")), 1).alias("connection_span_hours"),
        F.lit(10).alias("confidence_score"),
        "is_malicious",
        F.lit("CRITICAL: Mining pool connection detected").alias("alert_message"),
    )


def service_account_abuse(audit: DataFrame, min_score: int = 5) -> DataFrame:
    """Service accounts acting from outside, creating pods or pulling external images.

    A namespace is part of the group, so the namespace count is 1 (0 for a NULL one) and
    its score term, reserved for three or more, never adds a point.
    """
    keys = ["service_account", "namespace", "source_ip"]
    activity = audit.where(F.col("service_account").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.sum(flag(F.col("event_type") == "pod_create")).alias("total_pod_creations"),
        F.sum(flag(F.col("registry_type") == "external")).alias("external_pulls"),
        F.sum(flag(F.col("response_code") >= 400)).alias("total_failures"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.max("is_malicious").alias("is_malicious"),
    )
    described = activity.withColumn("ip_classification", address_class(F.col("source_ip"))).withColumn(
        "namespace_count", F.col("namespace").isNotNull().cast("bigint")
    )
    score = (
        points_if(F.col("ip_classification") == "external", 4)
        + tier(F.col("total_pod_creations"), [(10, 3), (5, 2), (1, 1)])
        + tier(F.col("external_pulls"), [(5, 2), (1, 1)])
        + tier(F.col("namespace_count"), [(3, 1)])
    )
    scored = described.withColumn("abuse_score", score).where(F.col("abuse_score") >= min_score)
    return scored.select(
        *keys, "ip_classification", "total_events", "namespace_count", "total_pod_creations", "external_pulls",
        "total_failures", "first_seen", "last_seen", "abuse_score", "is_malicious",
    )


def correlated_signals(audit: DataFrame, metrics: DataFrame, flows: DataFrame, min_gpu: float = 80) -> DataFrame:
    """Pods showing all three signals: external image, high GPU use and pool traffic.

    Metrics and flows are one row per pod before they meet the creations.  Columns that
    start with an underscore carry the unrounded ranking values.
    """
    created = (
        _created(audit).where(F.col("registry_type") == "external")
        .select(
            "pod_id", "namespace", "pod_name", "service_account", "container_image", "registry_type",
            F.col("timestamp").alias("created_at"), "is_malicious", "attack_chain_id",
        )
        .distinct()
    )
    busy = (
        metrics.groupBy("pod_id")
        .agg(F.avg("gpu_utilization_pct").alias("_gpu"), F.avg("cpu_cores_used").alias("_cpu"))
        .where(F.col("_gpu") >= min_gpu)
    )
    pools = spread_profile(
        flows.where(F.col("is_mining_pool")), ["pod_id"], {"unique_mining_hosts": "dst_host"}, rows="_flows",
        sums={"_sent": F.col("bytes_sent")},
    ).withColumn("_gb", F.col("_sent") / GB)
    return created.join(busy, "pod_id").join(pools, "pod_id").select(
        "namespace", "pod_id", "pod_name", "service_account", "container_image", "created_at",
        F.round("_gpu", 1).alias("avg_gpu_utilization"),
        F.round("_cpu", 1).alias("avg_cpu_cores"),
        "unique_mining_hosts",
        F.round("_gb", 2).alias("gb_sent_to_pools"),
        "attack_chain_id", "is_malicious",
        F.lit(10).alias("confidence_score"),
        F.lit("HIGH CONFIDENCE: External registry + High GPU + Mining traffic").alias("verdict"),
        "_gb", "_gpu",
    )


def attack_chain_rollup(
    audit: DataFrame, metrics: DataFrame, flows: DataFrame, only_labelled: bool = True
) -> DataFrame:
    """Each chain fragment (service account and namespace) with its chain's metric and flow totals."""
    in_chain = F.col("attack_chain_id").isNotNull()
    pods = spread_profile(
        audit.where((F.col("event_type") == "pod_create") & in_chain),
        ["attack_chain_id", "service_account", "namespace"],
        {"total_pods": "pod_id", "unique_images": "container_image"}, rows="_events",
        sums={
            "total_cpu_requested": F.col("resource_requests_cpu"),
            "total_gpu_requested": F.col("resource_requests_gpu"),
        },
        mins={"attack_start": F.col("timestamp")},
        maxs={"attack_end": F.col("timestamp"), "is_malicious": F.col("is_malicious")},
    )
    if only_labelled:
        pods = pods.where(F.col("is_malicious"))
    usage = metrics.where(in_chain).groupBy("attack_chain_id").agg(
        F.avg("gpu_utilization_pct").alias("gpu"),
        F.max("gpu_utilization_pct").alias("max_gpu_util"),
        F.sum("cpu_cores_used").alias("cpu_hours"),
    )
    traffic = spread_profile(
        flows.where(in_chain & F.col("is_mining_pool")), ["attack_chain_id"],
        {"mining_hosts_contacted": "dst_host"}, rows="mining_connections",
        sums={"sent": F.col("bytes_sent"), "seconds": F.col("connection_duration_sec")},
    ).withColumn("gb", F.col("sent") / GB)

    def severity() -> Column:
        return (
            tier(F.col("total_pods"), [(10, 3), (5, 2)], 1)
            + tier(F.col("gpu"), [(85, 3), (75, 2)], 1)
            + tier(F.col("gb"), [(10, 3), (5, 2)], 1)
        )

    return pods.join(usage, "attack_chain_id", "left").join(traffic, "attack_chain_id", "left").select(
        "attack_chain_id", F.col("service_account").alias("compromised_account"), "namespace", "total_pods",
        "attack_start", "attack_end",
        F.round(span_hours(F.col("attack_start"), F.col("attack_end")), 1).alias("attack_duration_hours"),
        "total_cpu_requested", "total_gpu_requested", "unique_images",
        F.round("gpu", 1).alias("avg_gpu_utilization"), "max_gpu_util",
        F.round("cpu_hours", 0).alias("total_cpu_hours_consumed"),
        "mining_hosts_contacted",
        F.round("gb", 2).alias("gb_egressed_to_pools"),
        "mining_connections",
        F.round(F.col("seconds") / 3600, 1).alias("hours_connected_to_pools"),
        "is_malicious", severity().alias("severity_score"),
    )
