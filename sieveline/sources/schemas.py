"""Declared schemas of the telemetry tables.  Timestamps are UTC; every column is nullable."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(), "boolean": BooleanType(), "int": IntegerType(), "bigint": LongType(),
    "double": DoubleType(), "timestamp": TimestampType(),
}


def _schema(columns: str) -> StructType:
    """``"name type, ..."`` as a schema; unlike a DDL parse it needs no session."""
    fields = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


SCHEMAS: dict[str, StructType] = {
    name: _schema(columns)
    for name, columns in {
        "orgs": "org_id string, org_size_tier string",
        "accounts": "account_id string, org_id string, is_paid boolean, created_at timestamp",
        "devices": "device_fingerprint string, is_headless boolean, browser_family string, os_family string, "
        "has_webdriver boolean, low_entropy_ua boolean, is_suspicious_device boolean",
        "enrichment_ip": "asn bigint, ip string, asn_type string, provider_category string, "
        "provider_brand_bucket string",
        "sessions": "session_id string, account_id string, org_id string, start_ts timestamp, auth_strength string, "
        "ip string, asn bigint, device_fingerprint string",
        "llm_requests": "request_id string, ts timestamp, org_id string, account_id string, "
        "device_fingerprint string, ip string, asn bigint, endpoint string, model string, prompt_tokens int, "
        "output_tokens int, language string, ui_language string, topic_bucket string, template_hash string, "
        "content_cluster_id string, is_automation_suspected boolean",
        "moderation_events": "request_id string, ts timestamp, policy_action string, policy_tag string, "
        "policy_score string",
        "rate_limit_events": "ts timestamp, asn bigint, account_id string, enforcement_action string, "
        "window_seconds int, threshold int, observed int",
        "osint_observations": "content_cluster_id string, platform_bucket string, ts timestamp, observed_volume int, "
        "confidence_bucket string, notes string",
        "identity_events": "ts timestamp, org_id string, account_id string, ip string, asn bigint, "
        "device_fingerprint string, user_agent string, event_type string, outcome string, campaign_id string, "
        "is_attack boolean",
        "dns_events": "ts timestamp, org_id string, account_id string, device_fingerprint string, host_raw string, "
        "base_domain string, tld string, parent_domain string, suspicious_tld boolean, keyword_hit boolean, "
        "high_entropy boolean, rare_domain boolean, score bigint, is_malicious boolean",
        "k8s_audit_logs": "timestamp timestamp, event_type string, namespace string, pod_name string, pod_id string, "
        "user_agent string, source_ip string, service_account string, container_image string, registry_type string, "
        "resource_requests_cpu double, resource_requests_memory_gb double, resource_requests_gpu double, "
        "privileged boolean, host_network boolean, response_code bigint, is_malicious boolean, attack_chain_id string",
        "resource_metrics": "timestamp timestamp, namespace string, pod_id string, pod_name string, "
        "cpu_cores_used bigint, memory_gb_used bigint, gpu_utilization_pct bigint, network_rx_bytes bigint, "
        "network_tx_bytes bigint, is_malicious boolean, attack_chain_id string",
        "network_flows": "timestamp timestamp, namespace string, pod_id string, pod_name string, src_ip string, "
        "dst_ip string, dst_host string, dst_port bigint, protocol string, bytes_sent bigint, bytes_received bigint, "
        "connection_duration_sec bigint, is_mining_pool boolean, is_malicious boolean, attack_chain_id string",
        "agent_sessions": "session_id string, user_email string, started_at timestamp, source string",
        "audit_events": "event_time timestamp, event_type string, actor string, target string, target_email string, "
        "details_json string",
        "auth_events": "event_time timestamp, user string, action string, source_ip string, result string",
    }.items()
}
