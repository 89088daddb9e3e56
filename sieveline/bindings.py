"""Binds the benchmark tables to the telemetry roles the detections read.

Each function derives a telemetry table from ``<dir>/<table>.parquet`` with plain
column expressions, so a detection over it grows with those files.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.plans.features import DomainHeuristics, with_dns_features, with_transition_edges

# Heuristic settings that separate the hosts of the benchmark pages.
HEURISTICS = DomainHeuristics(
    tlds=("net",), keywords=("blog", "pill", "cheap"), entropy_threshold=3.4, rare_threshold=60
)

# Detection parameters that give non-trivial results on sparse benchmark events.
PARAMS: dict[str, dict] = {
    "q05_burst_zscore": {"width": "1 day"},
    "q06_sync_org_spikes": {"width": "1 day", "min_orgs": 10},
    "q12_failed_login_bursts": {"width": "1 day", "min_failures": 3},
    "q13_new_asn_after_failures": {"width": "1 day", "min_failures": 2, "within": "1 day"},
    "q17_oauth_consent_grants": {"lookback": "4 hours"},
    "q18_ato_chain_candidates": {"width": "1 day", "min_failures": 2, "within": "1 day"},
    "q25_unusual_pod_creation": {"unit": "month"},
}


# Declared column types spare every read a pass over file footers.
COLUMNS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
}

# Telemetry table -> attribute of ``Telemetry`` that derives it.
ROLES = {
    "llm_requests": "requests",
    "enrichment_ip": "enrichment",
    "devices": "devices",
    "moderation_events": "moderation",
    "rate_limit_events": "rate_limits",
    "identity_events": "identity",
    "dns_events": "dns",
    "k8s_audit_logs": "audit",
    "resource_metrics": "metrics",
    "network_flows": "flows",
}
# DNS detections that do not read ``parent_domain`` skip the edge build.
WITHOUT_EDGES = ("q20_top_suspicious_domains", "q22_exposed_accounts", "q23_heuristic_breakdown", "q24_dns_rollup")


class Telemetry:
    """Telemetry views of one benchmark directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in COLUMNS:
            reader = reader.schema(COLUMNS[name])
        return reader.parquet(f"{self.directory}/{name}.parquet")

    @cached_property
    def requests(self) -> DataFrame:
        """``llm_requests``: events, with the customer's nation as the organisation."""
        nation = self.table("customer").selectExpr("c_custkey AS user_id", "CAST(c_nationkey AS BIGINT) AS org_id")
        return self.table("events").join(nation, "user_id").selectExpr(
            "event_id AS request_id",
            "ts",
            "org_id",
            "user_id AS account_id",
            "CAST(get_json_object(props, '$.k') AS BIGINT) AS asn",
            "event_id % 40 AS device_fingerprint",
            "event_id % 200 AS template_hash",
            "event_type AS content_cluster_id",
            "value > 100 AS is_automation_suspected",
            "event_type",
            "value",
        )

    @cached_property
    def coarse_requests(self) -> DataFrame:
        """``requests`` with few devices and templates, so that five-part keys repeat."""
        kept = [c for c in self.requests.columns if c not in ("device_fingerprint", "template_hash")]
        return self.requests.selectExpr(
            *kept, "request_id % 2 AS device_fingerprint", "request_id % 4 AS template_hash"
        )

    @cached_property
    def enrichment(self) -> DataFrame:
        """``enrichment_ip``: one row per distinct network number of the events."""
        networks = self.table("events").selectExpr("CAST(get_json_object(props, '$.k') AS BIGINT) AS asn").distinct()
        return networks.selectExpr(
            "asn",
            "CAST(asn AS STRING) AS ip",
            "CASE asn % 4 WHEN 0 THEN 'hosting' WHEN 1 THEN 'vpn' WHEN 2 THEN 'residential' ELSE 'corporate' END AS asn_type",
            "CASE asn % 3 WHEN 0 THEN 'cloud' WHEN 1 THEN 'edge' ELSE 'isp' END AS provider_category",
            "concat('p', asn % 16) AS provider_brand_bucket",
        )

    @cached_property
    def devices(self) -> DataFrame:
        """``devices``: every second fingerprint is known."""
        known = self.table("events").selectExpr("event_id % 40 AS device_fingerprint").distinct()
        return known.where("device_fingerprint % 2 = 0").selectExpr(
            "device_fingerprint",
            "device_fingerprint % 3 = 0 AS is_headless",
            "element_at(array('chrome', 'firefox', 'safari'), int(device_fingerprint % 3 + 1)) AS browser_family",
            "element_at(array('linux', 'mac', 'windows', 'android', 'ios'), int(device_fingerprint % 5 + 1)) AS os_family",
        )

    @cached_property
    def moderation(self) -> DataFrame:
        """``moderation_events``: one outcome per request, by event value."""
        return self.requests.selectExpr(
            "request_id",
            "ts",
            "CASE WHEN value > 200 THEN 'block' WHEN value > 100 THEN 'warn' ELSE 'allow' END AS policy_action",
        )

    @cached_property
    def rate_limits(self) -> DataFrame:
        """``rate_limit_events``: high-value requests; low network numbers are limited as a whole."""
        return self.requests.where("value > 150").selectExpr(
            "ts",
            "asn",
            "CASE WHEN asn < 35 THEN '' ELSE CAST(account_id AS STRING) END AS account_id",
            "CASE WHEN event_type = 'error' THEN 'temporary_block' ELSE 'throttle' END AS enforcement_action",
        )

    @cached_property
    def identity(self) -> DataFrame:
        """``identity_events``: event kinds stand for sign-ins and persistence steps."""
        return self.requests.selectExpr(
            "ts",
            "org_id",
            "account_id",
            "CAST(asn AS STRING) AS ip",
            "asn",
            "device_fingerprint",
            "concat('agent/', request_id % 5) AS user_agent",
            "CASE WHEN event_type IN ('error', 'click', 'view') THEN 'auth.signin' WHEN event_type = 'signup' THEN "
            "'auth.mfa.add' WHEN asn % 2 = 0 THEN 'mailbox.rule.create' ELSE 'oauth.consent.grant' END AS event_type",
            "CASE WHEN event_type = 'error' THEN 'failure' WHEN event_type IN ('click', 'view') THEN 'success' "
            "ELSE '' END AS outcome",
            "CASE WHEN value > 100 THEN concat('c', request_id % 7) ELSE '' END AS campaign_id",
            "value > 100 AS is_attack",
        )

    @cached_property
    def sessions(self) -> DataFrame:
        """``sessions``: clicks and views; sessions of every 11th account lack an address."""
        return self.requests.where("event_type IN ('click', 'view')").selectExpr(
            "request_id AS session_id",
            "account_id",
            "org_id",
            "ts AS start_ts",
            "CASE WHEN account_id % 11 != 0 THEN CAST(asn AS STRING) END AS ip",
            "asn",
            "device_fingerprint",
        )

    @cached_property
    def hosts(self) -> DataFrame:
        """Raw DNS queries: each request visits one page, pages taken in turn."""
        pages = self.table("pages")
        n_pages = pages.select(F.count(F.lit(1))).scalar()
        visited = pages.selectExpr("page_id", "split_part(url, '/', 3) AS host_raw")
        requests = self.requests.withColumn("page_id", F.col("request_id") % n_pages)
        return requests.join(visited, "page_id").selectExpr(
            "ts",
            "request_id",
            "org_id",
            "account_id",
            "device_fingerprint",
            "host_raw",
            "host_raw AS base_domain",
            "substring_index(host_raw, '.', -1) AS tld",
            "event_type = 'error' AS is_malicious",
        )

    @cached_property
    def dns(self) -> DataFrame:
        """``dns_events``: queries with heuristics and the account's previous host as parent."""
        edged = with_transition_edges(self.hosts, ["account_id"], ["ts", "request_id"])
        return with_dns_features(edged, HEURISTICS, counted=self.hosts)

    @cached_property
    def dns_flagged(self) -> DataFrame:
        """``dns`` without edges, for detections that do not read them."""
        return with_dns_features(self.hosts, HEURISTICS)

    @cached_property
    def audit(self) -> DataFrame:
        """``k8s_audit_logs``: orders as pod events; finished ones use external images."""
        external = "o_orderstatus = 'F'"
        labelled = "o_totalprice > 200000"
        return self.table("orders").selectExpr(
            "o_orderdate + make_dt_interval(0, int(o_orderkey % 24)) AS timestamp",
            "CASE WHEN o_orderstatus = 'P' THEN 'pod_delete' ELSE 'pod_create' END AS event_type",
            "o_orderpriority AS namespace",
            "concat('pod-', o_orderkey) AS pod_name",
            "o_orderkey AS pod_id",
            "concat(CASE WHEN o_custkey % 3 = 2 THEN '185' ELSE '10' END, '.0.0.', o_custkey % 5) AS source_ip",
            "concat('sa-', o_custkey % 20) AS service_account",
            f"concat(CASE WHEN NOT {external} THEN 'registry.internal' WHEN o_orderkey % 3 = 0 THEN 'docker.io' "
            "WHEN o_orderkey % 3 = 1 THEN 'ghcr.io' ELSE 'quay.io' END, '/img', o_orderkey % 4) AS container_image",
            f"CASE WHEN {external} THEN 'external' ELSE 'internal' END AS registry_type",
            "CAST(o_orderkey % 8 + 1 AS DOUBLE) AS resource_requests_cpu",
            f"CASE WHEN {external} THEN CAST(o_orderkey % 4 AS DOUBLE) END AS resource_requests_gpu",
            "CASE WHEN o_orderkey % 17 = 0 THEN 403L ELSE 201L END AS response_code",
            f"{labelled} AS is_malicious",
            f"CASE WHEN {labelled} THEN concat('chain-', o_orderkey % 50) END AS attack_chain_id",
        )

    def _lines(self, *columns: str) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_shipdate + make_dt_interval(0, l_linenumber * 5) AS timestamp",
            "concat('ns-', l_orderkey % 5) AS namespace",
            "l_orderkey AS pod_id",
            "concat('pod-', l_orderkey) AS pod_name",
            "l_returnflag = 'R' AS is_malicious",
            "CASE WHEN l_returnflag = 'R' THEN concat('chain-', l_orderkey % 50) END AS attack_chain_id",
            *columns,
        )

    @cached_property
    def metrics(self) -> DataFrame:
        """``resource_metrics``: order lines as samples."""
        return self._lines(
            "CAST(l_quantity AS BIGINT) AS cpu_cores_used",
            "CAST(round(l_tax * 100) AS BIGINT) AS memory_gb_used",
            "CAST(round(l_discount * 1000) AS BIGINT) AS gpu_utilization_pct",
        )

    @cached_property
    def flows(self) -> DataFrame:
        """``network_flows``: order lines as connections, returned lines as pool traffic."""
        return self._lines(
            "concat('host-', l_suppkey) AS dst_host",
            "l_suppkey % 4 + 3333 AS dst_port",
            "CAST(round(l_extendedprice * 100000) AS BIGINT) AS bytes_sent",
            "CAST(round(l_extendedprice * 100) AS BIGINT) AS bytes_received",
            "CAST(l_quantity * 60 AS BIGINT) AS connection_duration_sec",
            "l_returnflag = 'R' AS is_mining_pool",
        )

    @cached_property
    def agent_sessions(self) -> DataFrame:
        """``agent_sessions``: clicks."""
        return self.table("events").where("event_type = 'click'").selectExpr(
            "event_id AS session_id",
            "user_id AS user_email",
            "ts AS started_at",
            "element_at(array('virtual_agent', 'now_assist', 'portal'), int(event_id % 3 + 1)) AS source",
        )

    @cached_property
    def audit_events(self) -> DataFrame:
        """``audit_events``: sign-ups create users, purchases grant roles, errors reset passwords."""
        return self.table("events").where("event_type IN ('signup', 'purchase', 'error')").selectExpr(
            "ts AS event_time",
            "CASE event_type WHEN 'signup' THEN 'user_create' WHEN 'purchase' THEN 'role_grant' "
            "ELSE 'password_reset' END AS event_type",
            "concat('actor', event_id % 10) AS actor",
            "user_id AS target",
            "user_id AS target_email",
            "props AS details_json",
        )

    def lazy_sources(self, detection: str = "") -> Mapping[str, DataFrame]:
        """Telemetry tables under the names the packs read, built on first use."""
        roles = dict(ROLES)
        if detection == "q10_cluster_keys":
            roles["llm_requests"] = "coarse_requests"
        if detection in WITHOUT_EDGES:
            roles["dns_events"] = "dns_flagged"
        return _Lazy(self, roles)


class LiveTelemetry(Telemetry):
    """The same views with the events as a stream, whose dimensions stay tables; watermarks ask for zoned times."""

    def table(self, name: str) -> DataFrame:
        if name != "events":
            return super().table(name)
        # A pattern, as a stream's plain path has to be a folder and a table may be one file.
        events = self.spark.readStream.schema(COLUMNS[name]).parquet(f"{self.directory}/{{{name}}}.parquet")
        return events.withColumn("ts", F.col("ts").cast("timestamp"))


class _Lazy(Mapping):
    def __init__(self, telemetry: Telemetry, roles: Mapping[str, str]):
        self._telemetry, self._roles = telemetry, roles

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self._telemetry, self._roles[name])

    def __iter__(self):
        return iter(self._roles)

    def __len__(self) -> int:
        return len(self._roles)
