"""The four packs: detections by name, with the tables they read and how they are reported."""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.ranking import ranked
from sieveline.plans import cluster, coordinated, dns, signals, takeover
from sieveline.sources import artifacts, tables


@dataclass(frozen=True)
class Detection:
    """A detection function, its input tables, and the order and limit of its report.

    The function itself returns every row in no order; ``report`` sorts, cuts to the
    limit and drops helper columns that start with an underscore.  ``shares`` names the
    parameter that takes another detection's whole result, and that detection; both must
    run with equal values of all parameters they have in common.
    """

    name: str
    run: Callable[..., DataFrame]
    reads: tuple[str, ...]
    order: tuple[str, ...] = ()
    limit: int | None = None
    defaults: Mapping[str, Any] = field(default_factory=dict)
    shares: tuple[str, str] | None = None

    def settings(self, **params: Any) -> dict[str, Any]:
        """Every parameter of the function beside its tables, with the value it will run with."""
        own = list(inspect.signature(self.run).parameters.values())[len(self.reads) :]
        return {p.name: p.default for p in own} | dict(self.defaults) | params

    def result(self, sources: Mapping[str, DataFrame], **params: Any) -> DataFrame:
        return self.run(*[sources[t] for t in self.reads], **{**self.defaults, **params})

    def report(self, result: DataFrame) -> DataFrame:
        out = ranked(result, self.order, self.limit) if self.order else result
        return out.select(*[c for c in result.columns if not c.startswith("_")])


_REQ, _ENRICH, _IDENTITY, _DNS = "llm_requests", "enrichment_ip", "identity_events", "dns_events"
_AUDIT, _METRICS, _FLOWS = "k8s_audit_logs", "resource_metrics", "network_flows"

PACKS: dict[str, tuple[Detection, ...]] = {
    "coordinated": (
        Detection("q01_first_seen_hosting_asn", coordinated.first_seen_infra, (_REQ, _ENRICH),
                  ("-distinct_orgs", "-distinct_accounts", "-requests", "first_seen_ts", "asn"), 200),
        Detection("q02_pct_flagged_infra", coordinated.flagged_infra_share, (_REQ, _ENRICH),
                  ("-pct_hosting_vpn", "-hosting_vpn_reqs", "-total_reqs", "account_id", "org_id"), 500),
        Detection("q03_tenant_diversity", coordinated.tenant_diversity, (_REQ, _ENRICH),
                  ("-distinct_orgs", "-distinct_accounts", "-requests", "asn"), 300),
        Detection("q04_device_reuse", coordinated.device_reuse, (_REQ, "devices"),
                  ("-distinct_orgs", "-distinct_accounts", "-requests", "device_fingerprint"), 300),
        Detection("q05_burst_zscore", coordinated.burst_zscore, (_REQ, _ENRICH),
                  ("-zscore", "-reqs", "asn", "bucket_ts"), 400),
        Detection("q06_sync_org_spikes", coordinated.synchronized_org_spikes, (_REQ, _ENRICH),
                  ("-orgs", "-accounts", "-reqs", "bucket_ts", "provider_brand_bucket", "asn_type"), 300),
        Detection("q07_template_reuse", coordinated.template_reuse, (_REQ,),
                  ("-orgs", "-accounts", "-reqs", "template_hash"), 300),
        Detection("q08_content_cluster_spread", coordinated.content_cluster_spread, (_REQ,),
                  ("-orgs", "-accounts", "-reqs", "content_cluster_id"), 200),
        Detection("q09_policy_funnel", coordinated.policy_funnel, (_REQ, _ENRICH, "moderation_events"),
                  ("-events", "-orgs", "-accounts", "asn_type", "provider_brand_bucket", "policy_action"), 300),
        Detection("q10_cluster_keys", coordinated.cluster_keys, (_REQ, _ENRICH),
                  ("-orgs", "-accounts", "-reqs", "-automation_flags", "asn_type", "provider_brand_bucket",
                   "device_fingerprint", "content_cluster_id", "template_hash"), 300),
        Detection("q11_rate_limit_summary", coordinated.rate_limit_summary, ("rate_limit_events",),
                  ("-events", "scope", "enforcement_action")),
    ),
    "takeover": (
        Detection("q12_failed_login_bursts", takeover.failed_login_bursts, (_IDENTITY, _ENRICH),
                  ("-failures_in_10m", "-last_ts", "org_id", "account_id")),
        Detection("q13_new_asn_after_failures", takeover.new_origin_successes, (_IDENTITY,),
                  ("-failures_in_10m", "success_ts", "org_id", "account_id", "bucket_start")),
        Detection("q14_mfa_device_added", takeover.mfa_devices_added, (_IDENTITY,), ("-ts", "org_id", "account_id")),
        Detection("q15_success_after_mfa", takeover.success_after_mfa, (_IDENTITY,),
                  ("minutes_after_mfa", "-success_ts", "org_id", "account_id")),
        Detection("q16_mailbox_rule_creation", takeover.mailbox_rules_created, (_IDENTITY,),
                  ("-ts", "org_id", "account_id")),
        Detection("q17_oauth_consent_grants", takeover.oauth_grants_with_context, (_IDENTITY,),
                  ("-grant_ts", "org_id", "account_id", "success_ts")),
        Detection("q18_ato_chain_candidates", takeover.takeover_chains, (_IDENTITY,),
                  ("-risk_score", "-failures_in_10m", "new_asn_success_ts", "org_id", "account_id"),
                  shares=("pairs", "q13_new_asn_after_failures")),
        Detection("q19_ato_rollup", takeover.takeover_rollup, (_IDENTITY,), ("-risk_score", "org_id", "account_id")),
    ),
    "dns": (
        Detection("q20_top_suspicious_domains", dns.top_suspicious_domains, (_DNS,),
                  ("-max_score", "-query_count", "base_domain", "tld"), 500),
        Detection("q21_domain_chain_clusters", dns.domain_chain_clusters, (_DNS,),
                  ("-avg_child_score", "-chain_occurrences", "parent_domain", "child_domain"), 300),
        Detection("q22_exposed_accounts", dns.exposed_accounts, (_DNS,),
                  ("-total_risk_score", "-distinct_suspicious_domains", "account_id", "org_id",
                   "device_fingerprint"), 500),
        Detection("q23_heuristic_breakdown", dns.heuristic_breakdown, (_DNS,), ("heuristic",)),
        Detection("q24_dns_rollup", dns.dns_rollup, (_DNS,)),
    ),
    "cluster": (
        Detection("q25_unusual_pod_creation", cluster.unusual_pod_creation, (_AUDIT,),
                  ("-anomaly_score", "-pod_creation_count", "hour", "namespace", "service_account"), 100),
        Detection("q26_non_standard_registries", cluster.non_standard_registries, (_AUDIT,),
                  ("-avg_risk_score", "-total_pods", "namespace", "service_account", "registry_domain"), 100),
        Detection("q27_resource_anomalies", cluster.resource_anomalies, (_METRICS,),
                  ("-resource_anomaly_score", "-avg_gpu_utilization", "pod_id", "namespace", "pod_name"), 100),
        Detection("q28_mining_pool_egress", cluster.mining_pool_egress, (_FLOWS,),
                  ("-gb_sent", "-connection_count", "namespace", "pod_id", "pod_name", "dst_host", "dst_port"), 100),
        Detection("q29_service_account_abuse", cluster.service_account_abuse, (_AUDIT,),
                  ("-abuse_score", "-total_pod_creations", "service_account", "namespace", "source_ip"), 100),
        Detection("q30_correlated_signals", cluster.correlated_signals, (_AUDIT, _METRICS, _FLOWS),
                  ("-_gb", "-_gpu", "pod_id", "created_at"), 100),
        Detection("q31_attack_chain_rollup", cluster.attack_chain_rollup, (_AUDIT, _METRICS, _FLOWS),
                  ("-severity_score", "-total_pods", "attack_chain_id", "compromised_account", "namespace"), 50),
    ),
}

DETECTIONS: dict[str, Detection] = {d.name: d for pack in PACKS.values() for d in pack}

MANIFEST_SCHEMA = "name string, artifact string, row_count bigint, columns array<string>, error string"
RECORD_SCHEMA = f"{MANIFEST_SCHEMA}, results string"


def pack_results(
    pack: str, sources: Mapping[str, DataFrame], params: Mapping[str, Mapping[str, Any]] | None = None
) -> dict[str, DataFrame]:
    """Whole, unordered results of a pack's detections; nothing runs yet."""
    params = params or {}
    return {d.name: d.result(sources, **params.get(d.name, {})) for d in PACKS[pack]}


def manifest(results: Mapping[str, DataFrame]) -> DataFrame:
    """Lazy manifest: row count and columns of each report (limits applied)."""
    rows = []
    for name, df in sorted(results.items()):
        limit = DETECTIONS[name].limit
        n = F.count(F.lit(1)) if limit is None else F.least(F.count(F.lit(1)), F.lit(limit))
        columns = [F.lit(c) for c in df.columns if not c.startswith("_")]
        rows.append(df.agg(n.alias("row_count")).select(F.lit(name).alias("name"), "row_count", F.array(*columns).alias("columns")))
    return reduce(DataFrame.unionByName, rows)


def _first_values(report: DataFrame, values: int = 6) -> str | None:
    """The first columns of a report's first row as readable text."""
    row = report.first()
    return None if row is None else ", ".join(f"{k}={v}" for k, v in list(row.asDict().items())[:values])


def result_digest(detection: Detection, settings: Mapping[str, Any], states: Mapping[str, str]) -> str:
    """What a stored result stands for: the detection, its parameters, and the files of the tables it reads."""
    told = [detection.name, sorted((k, repr(v)) for k, v in settings.items()), [(t, states.get(t)) for t in detection.reads]]
    return hashlib.sha256(json.dumps(told).encode()).hexdigest()[:16]


def _shared_result(detection: Detection, settings: Mapping[str, Any], finished: Mapping[str, tuple[dict, DataFrame]]) -> dict[str, DataFrame]:
    """The parameter that hands over another detection's finished result, where the two agree on what they have in common."""
    if detection.shares is None or detection.shares[1] not in finished:
        return {}
    parameter, source = detection.shares
    theirs, written = finished[source]
    agree = all(settings[k] == v for k, v in theirs.items() if k in settings)
    return {parameter: written} if agree else {}


def run_pack(
    spark: SparkSession,
    pack: str,
    data_dir: str,
    out_dir: str,
    strict: bool = False,
    params: Mapping[str, Mapping[str, Any]] | None = None,
    case_id: str | None = None,
    resume: bool = False,
) -> DataFrame:
    """Runs a pack over a directory of tables and writes its evidence below ``out_dir``.

    Each detection runs once: its whole result is written as a table, from which the CSV
    report and the signal are then read.  A failing detection becomes a manifest row and
    the run goes on.  Also writes as JSON: the manifest (case id, generation time, data directory,
    table counts, findings), the findings and table counts alone, the ranked signals, the overall
    risk, and the evidence of each signal with its report's first row and path.

    Results stand under a digest of their parameters and input files.  With ``resume`` a detection whose
    result and report were finished before, by this run or one that was stopped, is read and not run again; changed
    parameters or files give another digest.  Changed code does not: run without ``resume`` after it.
    """
    params = params or {}
    paths = tables.discover(spark, data_dir)
    loaded = tables.load(spark, data_dir)
    if strict:
        tables.require(loaded, pack)
    sources = tables.with_optional(spark, loaded)
    states = tables.file_states(spark, {t: paths[t] for d in PACKS[pack] for t in d.reads if t in paths})
    scorers, entries, scored, tops = signals.catalog(), [], [], []
    finished: dict[str, tuple[dict, DataFrame]] = {}
    for detection in sorted(PACKS[pack], key=lambda d: d.name):
        own = params.get(detection.name, {})
        settings = detection.settings(**own)
        digest = result_digest(detection, settings, states)
        record = f"{out_dir}/finished/{detection.name}-{digest}"
        done = artifacts.read_record(spark, record, RECORD_SCHEMA) if resume else None
        try:
            if done is None:
                attempt = f"{detection.name}-{digest}-{uuid.uuid4().hex[:8]}"  # a stopped attempt is never taken for a result
                results, path = f"{out_dir}/results/{attempt}", f"{out_dir}/artifacts/{attempt}"
                shared = _shared_result(detection, settings, finished)
                artifacts.write_parquet(detection.result(sources, **{**own, **shared}), results)
                written = spark.read.parquet(results)
                seen = Observation(detection.name)
                report = detection.report(written).observe(seen, F.count(F.lit(1)).alias("n"))
                artifacts.write_csv(report, path)
                done = Row(detection.name, path, seen.get["n"], report.columns, None, results)
                artifacts.write_record(spark, record, RECORD_SCHEMA, done)
            written = spark.read.parquet(done[-1])
        except Exception as error:  # a broken detection must not hide the others
            entries.append((detection.name, None, None, None, repr(error)))
            continue
        entries.append(tuple(done)[:-1])
        finished[detection.name] = (settings, written)
        if detection.name in scorers:
            scored.append(scorers[detection.name].of(written))
            tops.append((scorers[detection.name].id, done[1], _first_values(detection.report(written))))
    listing = spark.createDataFrame(entries, MANIFEST_SCHEMA)
    rows = reduce(DataFrame.unionByName, scored) if scored else signals.no_signals(spark)
    artifacts.write_json(signals.ranked_signals(rows), f"{out_dir}/signals")
    artifacts.write_json(signals.overall_risk(rows), f"{out_dir}/scoring")
    found = spark.createDataFrame(tops, "id string, artifact string, top_row string")
    artifacts.write_json(signals.evidence_table(rows).join(found, "id", "left"), f"{out_dir}/evidence")
    counts = tables.row_counts(loaded)
    artifacts.write_json(counts, f"{out_dir}/table_counts")
    artifacts.write_json(listing, f"{out_dir}/findings")
    # One row a table and a finding: both lists are as long as the pack's catalogue.
    document = spark.createDataFrame(
        [(case_id or pack, data_dir, [tuple(r) for r in counts.collect()], entries)],
        f"case_id string, data_dir string, table_counts array<{counts.schema.simpleString()}>,"
        f" findings array<struct<{MANIFEST_SCHEMA.replace(' ', ':').replace(',:', ',')}>>",
    )
    artifacts.write_json(document.withColumn("generated_at", F.current_timestamp()), f"{out_dir}/manifest")
    return listing
