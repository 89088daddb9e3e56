from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from sieveline.plans import cluster, coordinated, dns, features, hunts, takeover
from sieveline.plans.packs import DETECTIONS
from tests.tables import FAIL, OK, at, identity, planted_chain, table

ENRICH = [
    {"asn": 1, "ip": "10.0.0.1", "asn_type": "hosting", "provider_category": "cloud", "provider_brand_bucket": "p1"},
    {"asn": 2, "ip": "10.0.0.2", "asn_type": "residential", "provider_category": "isp", "provider_brand_bucket": "p2"},
    {"asn": 3, "ip": "10.0.0.2", "asn_type": "vpn", "provider_category": "edge", "provider_brand_bucket": "p1"},
]


def request(i, minutes=0.0, asn=1, org="o1", account="a1", **extra):
    return {
        "request_id": f"r{i}", "ts": at(minutes), "asn": asn, "org_id": org, "account_id": account,
        "device_fingerprint": "d1", "template_hash": "t1", "content_cluster_id": "c1",
        "is_automation_suspected": i % 2 == 0, **extra,
    }


@pytest.fixture(scope="module")
def enrichment(spark):
    return table(spark, "enrichment_ip", ENRICH)


def dicts(df):
    return [r.asDict() for r in df.collect()]


def test_first_seen_infra_keeps_flagged_types_only(spark, enrichment):
    requests = table(spark, "llm_requests", [request(0, 5), request(1, 1, account="a2"), request(2, 0, asn=2), request(3, asn=None)])
    (row,) = dicts(coordinated.first_seen_infra(requests, enrichment))
    assert (row["asn"], row["requests"], row["distinct_accounts"], row["first_seen_ts"]) == (1, 2, 2, at(1))


def test_flagged_infra_share(spark, enrichment):
    requests = table(spark, "llm_requests", [request(i, asn=a) for i, a in enumerate([1, 2, 2, 99])])
    (row,) = dicts(coordinated.flagged_infra_share(requests, enrichment))
    assert (row["total_reqs"], row["hosting_vpn_reqs"], row["pct_hosting_vpn"]) == (3, 1, 33.33)


def test_device_reuse_threshold_and_unknown_device(spark):
    requests = table(
        spark, "llm_requests",
        [request(i, account=f"a{i}") for i in range(5)] + [request(9 + i, account=f"a{i}", device_fingerprint="d2") for i in range(4)],
    )
    (row,) = dicts(coordinated.device_reuse(requests, table(spark, "devices", [{"device_fingerprint": "other"}])))
    assert (row["device_fingerprint"], row["distinct_accounts"], row["is_headless"]) == ("d1", 5, None)


def test_burst_zscore_uses_non_empty_buckets_and_drops_constant_networks(spark, enrichment):
    rows = [request(0, 0), request(1, 300), request(2, 301), request(3, 302)]
    rows += [request(10 + i, 60 * i, asn=2) for i in range(3)]
    got = sorted(dicts(coordinated.burst_zscore(table(spark, "llm_requests", rows), enrichment)), key=lambda r: r["bucket_ts"])
    assert [(r["asn"], r["reqs"], r["zscore"]) for r in got] == [(1, 1, -1.0), (1, 3, 1.0)]
    assert sum(r["reqs"] for r in got) == 4


def test_synchronized_spikes_merge_networks_of_one_bucket(spark, enrichment):
    rows = [request(i, i, asn=1 if i % 2 else 3, org=f"o{i}", account="shared") for i in range(12)]
    got = dicts(coordinated.synchronized_org_spikes(table(spark, "llm_requests", rows), enrichment, min_orgs=6))
    assert sorted((r["asn_type"], r["orgs"], r["accounts"], r["reqs"]) for r in got) == [("hosting", 6, 1, 6), ("vpn", 6, 1, 6)]


def test_template_reuse_threshold(spark):
    rows = [request(i, i, account=f"a{i}") for i in range(8)] + [request(20 + i, account=f"a{i}", template_hash="t2") for i in range(7)]
    (row,) = dicts(coordinated.template_reuse(table(spark, "llm_requests", rows)))
    assert (row["template_hash"], row["accounts"], row["first_seen_ts"], row["last_seen_ts"]) == ("t1", 8, at(0), at(7))


def test_policy_funnel_and_cluster_keys(spark, enrichment):
    requests = table(spark, "llm_requests", [request(i, org=f"o{i % 5}", account=f"a{i}") for i in range(8)])
    moderation = table(spark, "moderation_events", [{"request_id": f"r{i}", "policy_action": "warn"} for i in range(3)])
    (row,) = dicts(coordinated.policy_funnel(requests, enrichment, moderation))
    assert (row["policy_action"], row["events"], row["accounts"], row["orgs"]) == ("warn", 3, 3, 3)
    (keys,) = dicts(coordinated.cluster_keys(requests, enrichment))
    assert (keys["orgs"], keys["accounts"], keys["automation_flags"]) == (5, 8, 4)


def test_rate_limit_scope(spark):
    limits = [("", 1, "throttle"), ("", 2, "throttle"), ("a", 1, "throttle"), (None, 1, "throttle")]
    df = table(spark, "rate_limit_events", [{"account_id": a, "asn": n, "enforcement_action": e} for a, n, e in limits])
    got = {r["scope"]: (r["events"], r["asns"], r["accounts"]) for r in dicts(coordinated.rate_limit_summary(df))}
    assert got == {"infra": (2, 2, 1), "account": (2, 1, 1)}


def test_failed_login_bursts_hit_miss_and_split(spark, enrichment):
    rows = [(at(i), "hit", *FAIL, 1) for i in range(6)] + [(at(i), "miss", *FAIL, 1) for i in range(5)]
    rows += [(at(5 + 1.9 * i), "split", *FAIL, 1) for i in range(6)]
    (row,) = dicts(takeover.failed_login_bursts(identity(spark, rows), enrichment))
    assert (row["account_id"], row["failures_in_10m"], row["sample_ip"], row["asn_type"]) == ("hit", 6, "10.0.0.1", "hosting")


def test_failed_login_bursts_fan_out_on_repeated_address(spark, enrichment):
    rows = [(at(i), "a", *FAIL, 2) for i in range(6)] + [(at(i), "b", *FAIL, 55) for i in range(6)]
    got = dicts(takeover.failed_login_bursts(identity(spark, rows), enrichment))
    assert sorted((r["account_id"], r["asn_type"]) for r in got if r["asn_type"]) == [("a", "residential"), ("a", "vpn")]
    assert [r["asn_type"] for r in got if r["account_id"] == "b"] == [None]


def test_new_origin_success_window_is_inclusive(spark):
    fails = [(at(i), name, *FAIL, 1) for name in ("edge", "late", "null") for i in range(6)]
    last = at(5)
    rows = fails + [
        (last + timedelta(minutes=60), "edge", *OK, 9),
        (last + timedelta(minutes=60, microseconds=1), "late", *OK, 9),
        (last + timedelta(minutes=1), "null", *OK, None, {"ip": "x"}),
    ]
    (row,) = dicts(takeover.new_origin_successes(identity(spark, rows)))
    assert (row["account_id"], row["success_asn"], row["sample_fail_asn"]) == ("edge", 9, 1)


def test_new_origin_needs_first_success_and_keeps_ties(spark):
    fails = [(at(i), name, *FAIL, 1) for name in ("known", "tied") for i in range(6)]
    rows = fails + [(at(-100), "known", *OK, 9), (at(7), "known", *OK, 9)]
    rows += [(at(8), "tied", *OK, 9), (at(8), "tied", *OK, 9, {"ip": "other"}), (at(9), "tied", *OK, 9)]
    got = dicts(takeover.new_origin_successes(identity(spark, rows)))
    assert sorted((r["account_id"], r["success_ip"]) for r in got) == [("tied", "10.0.0.9"), ("tied", "other")]


def test_success_after_mfa_edges_and_ties(spark):
    four = timedelta(hours=4)
    rows = [(at(0), n, "auth.mfa.add", "", 1) for n in ("now", "edge", "late", "twice", "twice")]
    rows += [
        (at(0), "now", *OK, 2), (at(1), "now", *OK, 3),
        (at(0) + four, "edge", *OK, 2),
        (at(0) + four + timedelta(microseconds=1), "late", *OK, 2),
        (at(3), "twice", *OK, 2),
    ]
    got = {r["account_id"]: (r["minutes_after_mfa"], r["success_asn"]) for r in dicts(takeover.success_after_mfa(identity(spark, rows)))}
    assert got == {"now": (0, 2), "edge": (240, 2), "twice": (3, 2)}


def test_oauth_grants_keep_unmatched_and_all_matches(spark):
    rows = [(at(0), n, "oauth.consent.grant", "", 1) for n in ("none", "two")]
    rows += [(at(-30), "two", *OK, 1), (at(0), "two", *OK, 1), (at(-31), "two", *OK, 1), (at(1), "two", *OK, 1)]
    got = dicts(takeover.oauth_grants_with_context(identity(spark, rows)))
    assert sorted((r["account_id"], r["success_ts"]) for r in got if r["success_ts"]) == [("two", at(-30)), ("two", at(0))]
    assert [r["account_id"] for r in got if r["success_ts"] is None] == ["none"]


def test_planted_chain_scores_115(spark):
    events = identity(spark, planted_chain())
    (row,) = dicts(takeover.takeover_chains(events))
    assert (row["risk_score"], row["failures_in_10m"], row["is_attack"], row["campaign_id"]) == (115, 9, True, "c")
    assert (row["has_mfa_add"], row["has_mailbox_rule"], row["has_oauth_grant"]) == (1, 1, 1)
    (roll,) = dicts(takeover.takeover_rollup(events))
    assert roll["risk_score"] == 90


def test_chain_order_is_optional(spark):
    rows = planted_chain()[:10] + [(at(-500), "victim", "auth.mfa.add", "", 1)]
    events = identity(spark, rows)
    assert [r["risk_score"] for r in dicts(takeover.takeover_chains(events))] == [60]
    assert [r["risk_score"] for r in dicts(takeover.takeover_chains(events, ordered=True))] == [30]


def test_mfa_and_mailbox_filters(spark):
    events = identity(spark, planted_chain())
    assert [r["ts"] for r in dicts(takeover.mfa_devices_added(events))] == [at(2)]
    assert [r["ts"] for r in dicts(takeover.mailbox_rules_created(events))] == [at(18)]


@pytest.fixture(scope="module")
def dns_events(spark):
    """Six queries to a known host, five to a rare one, one keyless row."""
    raw = [("common.example.com", m, "a1") for m in range(6)] + [("login.evil.xyz", 10 + m, "a2") for m in range(5)]
    df = spark.createDataFrame(
        [(at(m), "o1", a, "d1", h, h.endswith("xyz")) for h, m, a in raw] + [(at(99), "o1", "a3", "d1", "localhost", False)],
        "ts timestamp, org_id string, account_id string, device_fingerprint string, host_raw string, is_malicious boolean",
    )
    return features.build_dns_events(df).cache()


def test_feature_build_flags_and_scores(dns_events):
    by_domain = {r["base_domain"]: r for r in dicts(dns_events)}
    assert set(by_domain) == {"example.com", "evil.xyz"}
    common, evil = by_domain["example.com"], by_domain["evil.xyz"]
    assert (common["rare_domain"], common["suspicious_tld"], common["score"]) == (False, False, 0)
    assert (evil["rare_domain"], evil["suspicious_tld"], evil["keyword_hit"], evil["score"]) == (True, True, False, 3)
    (summary,) = dicts(features.dns_summary(dns_events))
    assert (summary["row_count"], summary["malicious_events"], summary["rare_domains"], summary["chains"]) == (11, 5, 5, 9)


def test_dns_pack_over_features(dns_events):
    (top,) = dicts(dns.top_suspicious_domains(dns_events))
    assert (top["base_domain"], top["query_count"], top["max_score"], top["sample_host"]) == ("evil.xyz", 5, 3, "login.evil.xyz")
    chains = {(r["parent_domain"], r["child_domain"]): r["chain_risk_category"] for r in dicts(dns.domain_chain_clusters(dns_events))}
    assert chains == {("example.com", "example.com"): "low_risk_chain", ("evil.xyz", "evil.xyz"): "medium_risk_chain"}
    assert dicts(dns.exposed_accounts(dns_events)) == []
    fired = {r["heuristic"]: r["trigger_count"] for r in dicts(dns.heuristic_breakdown(dns_events))}
    assert fired == {"suspicious_tld": 5, "keyword_hit": 0, "high_entropy": 0, "rare_domain": 5, "SCORE_DIST_0": 6, "SCORE_DIST_3": 5}
    (roll,) = dicts(dns.dns_rollup(dns_events))
    assert (roll["true_positives"], roll["precision"], roll["recall"], roll["distinct_domains"]) == (5, 1.0, 1.0, 2)


def test_dns_rollup_without_flags_has_null_precision(dns_events):
    (roll,) = dicts(dns.dns_rollup(dns_events.where("score = 0")))
    assert (roll["precision"], roll["recall"], roll["flagged_events"]) == (None, None, 0)


def test_transition_edges_respect_gap(spark):
    df = spark.createDataFrame([("a", "d", at(0), "x"), ("a", "d", at(5), "y"), ("a", "d", at(50), "z")],
                               "account_id string, device_fingerprint string, ts timestamp, base_domain string")
    got = {r["base_domain"]: r["parent_domain"] for r in dicts(features.with_transition_edges(df, max_gap="10 minutes"))}
    assert got == {"x": "", "y": "x", "z": ""}


def test_sessions_become_signins(spark):
    sessions = table(spark, "sessions", [
        {"session_id": "s1", "account_id": "a", "org_id": "o", "start_ts": at(0), "ip": "i", "asn": 1, "device_fingerprint": "d"},
        {"session_id": "s2", "account_id": "a", "org_id": "o", "start_ts": None, "ip": "i", "asn": 1, "device_fingerprint": "d"},
    ])
    unified = features.unified_identity_events(sessions, identity(spark, planted_chain()))
    assert unified.count() == 15
    assert unified.where("account_id = 'a'").first().outcome == "success"


def pod(i, minutes, **extra):
    return {
        "timestamp": at(minutes), "event_type": "pod_create", "namespace": "n", "service_account": "sa", "pod_id": f"p{i}",
        "pod_name": f"p{i}", "container_image": "docker.io/x", "registry_type": "external", "source_ip": "8.8.8.8",
        "resource_requests_cpu": 1.0, "resource_requests_gpu": 1.0, "response_code": 201, "is_malicious": True,
        "attack_chain_id": "c1", **extra,
    }


@pytest.fixture(scope="module")
def audit(spark):
    rows = [pod(i, 400 + i) for i in range(10)]  # Friday 18:40 on, off hours
    rows.append(pod(99, 0, response_code=403, container_image=None))
    rows.append(pod(98, 0, service_account="quiet", source_ip="10.0.0.1", registry_type="internal", attack_chain_id=None))
    return table(spark, "k8s_audit_logs", rows).cache()


def test_unusual_pod_creation_scores_volume_hours_and_gpu(audit):
    (row,) = dicts(cluster.unusual_pod_creation(audit))
    assert (row["pod_creation_count"], row["off_hours_pct"], row["anomaly_score"], row["unique_images"]) == (10, 100.0, 7, 1)


def test_registries_and_service_accounts(audit):
    (row,) = dicts(cluster.non_standard_registries(audit))
    assert (row["registry_domain"], row["total_pods"], row["avg_risk_score"]) == ("docker.io", 10, 8.0)
    (abuse,) = dicts(cluster.service_account_abuse(audit))
    assert (abuse["abuse_score"], abuse["total_failures"], abuse["namespace_count"], abuse["ip_classification"]) == (9, 1, 1, "external")


@pytest.fixture(scope="module")
def usage(spark):
    metrics = [
        {"timestamp": at(60 * h), "namespace": "n", "pod_id": p, "pod_name": p, "cpu_cores_used": 15, "memory_gb_used": 4,
         "gpu_utilization_pct": g, "is_malicious": True, "attack_chain_id": "c1"}
        for p, g in (("p0", 90), ("p1", 50), ("p2", 0)) for h in (0, 24, 48)
    ]
    flows = [
        {"timestamp": at(60 * h), "namespace": "n", "pod_id": "p0", "pod_name": "p0", "dst_host": f"h{h}", "dst_port": 3333,
         "bytes_sent": 3_000_000_000, "bytes_received": 1_500_000, "connection_duration_sec": 90, "is_mining_pool": h < 2,
         "is_malicious": True, "attack_chain_id": "c1"}
        for h in (0, 1, 2)
    ]
    return table(spark, "resource_metrics", metrics).cache(), table(spark, "network_flows", flows).cache()


def test_resource_anomalies(usage):
    got = {r["pod_id"]: (r["resource_anomaly_score"], r["lifetime_hours"]) for r in dicts(cluster.resource_anomalies(usage[0]))}
    assert got == {"p0": (8, 48.0), "p1": (5, 48.0)}


def test_egress_correlation_and_rollup(audit, usage):
    metrics, flows = usage
    egress = dicts(cluster.mining_pool_egress(flows))
    assert sorted((r["dst_host"], r["gb_sent"], r["mb_received"], r["avg_duration_min"]) for r in egress) == [
        ("h0", 3.0, 1.5, 1.5), ("h1", 3.0, 1.5, 1.5)]
    result = cluster.correlated_signals(audit, metrics, flows)
    (row,) = dicts(DETECTIONS["q30_correlated_signals"].report(result))
    assert (row["pod_id"], row["unique_mining_hosts"], row["gb_sent_to_pools"], row["confidence_score"]) == ("p0", 2, 6.0, 10)
    assert not [c for c in row if c.startswith("_")]
    (chain,) = dicts(cluster.attack_chain_rollup(audit, metrics, flows))
    assert (chain["total_pods"], chain["mining_connections"], chain["severity_score"]) == (11, 2, 6)


def test_rollup_label_filter_and_missing_totals(spark, audit, usage):
    unlabelled = table(spark, "k8s_audit_logs", [pod(1, 0, is_malicious=False)])
    metrics, flows = (df.where("false") for df in usage)
    assert dicts(cluster.attack_chain_rollup(unlabelled, metrics, flows)) == []
    (row,) = dicts(cluster.attack_chain_rollup(unlabelled, metrics, flows, only_labelled=False))
    assert (row["severity_score"], row["mining_connections"]) == (3, None)


def test_hunts(spark):
    sessions = table(spark, "agent_sessions", [
        {"session_id": "s", "user_email": "u@x", "started_at": at(0), "source": "virtual_agent"},
        {"session_id": "p", "user_email": "u@x", "started_at": at(0), "source": "portal"}])
    def event(minutes, kind, target="new", details="", email="u@x"):
        return {"event_time": at(minutes), "event_type": kind, "actor": "svc", "target": target,
                "target_email": email, "details_json": details}
    audit = table(spark, "audit_events", [
        event(30, "user_create"), event(31, "user_create", "late"), event(40, "role_grant", details='{"role": "ADMIN"}'),
        event(45, "role_grant", details="reader"), event(150, "password_reset"), event(151, "password_reset")])
    near = dicts(hunts.users_created_near_sessions(sessions, audit))
    assert sorted((r["session_id"], r["new_user"]) for r in near) == [("p", "new"), ("s", "new")]
    grants = dicts(hunts.role_grants_near_sessions(sessions, audit))
    assert [(r["new_user"], r["role_grant_time"]) for r in grants] == [("new", at(40))] * 2
    assert [r["reset_time"] for r in dicts(hunts.resets_after_creation(audit))] == [at(150)]
    assert [r["t_role"] for r in dicts(hunts.new_privileged_users(audit))] == [at(40)]
    (changes,) = dicts(hunts.identity_changes_after_sessions(sessions, audit, sources=["virtual_agent"]))
    assert (changes["events"], changes["targets"], changes["actors"]) == (["user_create"], ["new"], ["svc"])


def test_exposure_hunt_window(spark):
    dns_rows = table(spark, "dns_events", [
        {"ts": at(0), "account_id": a, "score": s} for a, s in (("in", 4), ("out", 5), ("low", 3))])
    events = identity(spark, [(at(60 * 48), "in", *FAIL, 1), (at(60 * 48 + 1), "out", *FAIL, 1), (at(1), "low", *FAIL, 1)])
    (row,) = dicts(hunts.exposure_then_failed_login(dns_rows, events))
    assert (row["account_id"], row["time_delta_hours"]) == ("in", 48.0)


def test_results_do_not_depend_on_partitioning(spark):
    rows = [r for k in range(6) for r in planted_chain(f"v{k}", 30.0 * k)]
    events = identity(spark, rows)
    one, many = (sorted(map(repr, takeover.takeover_chains(events.repartition(n)).collect())) for n in (1, 7))
    assert one == many and len(one) == 6
