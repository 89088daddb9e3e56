import pytest
from pyspark.sql import functions as F

from sieveline.plans import quality, signals


def result(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def score_of(spark, detection, rows, schema):
    got = signals.catalog()[detection].of(result(spark, rows, schema)).collect()
    return got[0] if got else None


@pytest.mark.parametrize(
    "detection, rows, schema, score",
    [
        ("q03_tenant_diversity", [(10, 3, 9), (30, 1, 1)], "distinct_orgs long, distinct_accounts long, requests long", 100.0),
        ("q03_tenant_diversity", [(4, 3, 9)], "distinct_orgs long, distinct_accounts long, requests long", 0.0),
        ("q02_pct_flagged_infra", [(80.0, 80, 100), (10.0, 50, 500)], "pct_hosting_vpn double, hosting_vpn_reqs long, total_reqs long", 40.0),
        ("q06_sync_org_spikes", [(125, 12), (3, 40)], "reqs long, orgs long", 25.0),
        ("q07_template_reuse", [(4,), (5,)], "orgs long", 50.0),
        ("q08_content_cluster_spread", [(3,)], "orgs long", 25.0),
        ("q11_rate_limit_summary", [("throttle", 1), ("temporary_block", 3)], "enforcement_action string, events long", 30.0),
        ("q12_failed_login_bursts", [(6,), (18,)], "failures_in_10m long", 50.0),
        ("q13_new_asn_after_failures", [("a",), ("a",), ("b",), ("",), (None,)], "account_id string", 13.3),
        ("q14_mfa_device_added", [(str(i),) for i in range(20)], "account_id string", 100.0),
        ("q16_mailbox_rule_creation", [("a",)], "account_id string", 10.0),
        ("q17_oauth_consent_grants", [("a",)], "account_id string", 12.5),
        ("q18_ato_chain_candidates", [(115,), (80,), (79,), (50,), (30,)], "risk_score int", 10.0),
        ("q24_dns_rollup", [(0.5, 1.0, 10, 100)], "precision double, recall double, flagged_events long, total_dns_events long", 66.7),
        ("q24_dns_rollup", [(None, 1.0, 10, 100)], "precision double, recall double, flagged_events long, total_dns_events long", 20.0),
        ("q24_dns_rollup", [(0.0, 0.0, 10, 100)], "precision double, recall double, flagged_events long, total_dns_events long", 0.0),
        ("q25_unusual_pod_creation", [(4,), (3,), (7,)], "anomaly_score int", 13.3),
        ("q26_non_standard_registries", [(4.0,), (3.9,)], "avg_risk_score double", 6.7),
        ("q27_resource_anomalies", [(5,)] * 3, "resource_anomaly_score int", 15.0),
        ("q28_mining_pool_egress", [("p",), ("p",), ("q",)], "pod_id string", 20.0),
        ("q29_service_account_abuse", [(9,)] * 3, "abuse_score int", 20.0),
        ("q30_correlated_signals", [("p", 10), ("q", 9)], "pod_id string, confidence_score int", 10.0),
    ],
)
def test_signal_scores(spark, detection, rows, schema, score):
    assert score_of(spark, detection, rows, schema)["score"] == score
    assert score_of(spark, detection, [], schema) is None


def test_policy_funnel_reads_the_busiest_group(spark):
    rows = [("vpn", "p1", "allow", 50), ("vpn", "p1", "warn", 25), ("vpn", "p1", "block", 25), ("hosting", "p2", "block", 60)]
    row = score_of(spark, "q09_policy_funnel", rows, "asn_type string, provider_brand_bucket string, policy_action string, events long")
    assert row["score"] == 50.0
    assert row["evidence"]["warn_rate"] == "0.25"


def test_null_share_gives_no_signal(spark):
    schema = "pct_hosting_vpn double, hosting_vpn_reqs long, total_reqs long"
    assert score_of(spark, "q02_pct_flagged_infra", [(None, 1, 2)], schema) is None


def scored(spark, *rows):
    full = [(f"s{i}", "t", w, s, round(100 * s, 1), "r", {"k": "v"}) for i, (w, s) in enumerate(rows)]
    return spark.createDataFrame(full, signals.no_signals(spark).schema)


@pytest.mark.parametrize(
    "rows, score, severity",
    [([(1.0, 0.7)], 70, "high"), ([(1.0, 0.695)], 70, "high"), ([(1.0, 0.405)], 40, "medium"),
     ([(3.0, 0.0), (1.0, 1.0)], 25, "low"), ([(1.0, 0.125)], 12, "low")],
)
def test_overall_is_a_half_even_weighted_mean(spark, rows, score, severity):
    row = signals.overall_risk(scored(spark, *rows)).first()
    assert (row.overall_risk_score, row.severity, row.signal_count) == (score, severity, len(rows))


def test_no_signals_is_zero_and_low(spark):
    row = signals.overall_risk(signals.no_signals(spark)).first()
    assert (row.overall_risk_score, row.severity, row.signal_count) == (0, "low", 0)


def test_ranking_severity_and_evidence(spark):
    df = scored(spark, (1.0, 0.5), (2.0, 0.4), (0.5, 0.9))
    ranked = signals.ranked_signals(df).collect()
    assert [(r.id, r.severity) for r in ranked] == [("s1", "medium"), ("s0", "medium"), ("s2", "high")]
    assert signals.evidence_table(df).first().evidence_text == "k=v"


def test_registry_skips_results_without_a_scorer(spark):
    orgs = result(spark, [(5,)], "orgs long")
    got = signals.score_results({"q07_template_reuse": orgs, "q10_cluster_keys": orgs}).collect()
    assert [r.id for r in got] == ["template_reuse"]
    with pytest.raises(ValueError):
        signals.score_results({"q10_cluster_keys": orgs})


@pytest.mark.parametrize("n, level", [(0, "LOW"), (4, "MEDIUM"), (7, "HIGH"), (10, "CRITICAL"), (500, "CRITICAL")])
def test_additive_score(spark, n, level):
    rows = spark.range(n)
    scored_rows = signals.additive_signals({"q28_mining_pool_egress": rows})
    assert scored_rows.first().row_count == n
    risk = signals.additive_risk(scored_rows).first()
    assert risk.risk_level == level and risk.recommendation == signals.ADDITIVE_ADVICE[level]


def test_bands(spark):
    df = spark.createDataFrame([(i,) for i in range(12)], "s int")
    bands = [r.b for r in df.select(quality.dns_score_band(F.col("s")).alias("b")).collect()]
    assert bands[:8] == ["benign", "low", "low", "medium", "medium", "high", "high", "high"]
    alerts = [r.b for r in df.select(quality.alert_priority(F.col("s")).alias("b")).collect()]
    assert (alerts[4], alerts[5], alerts[8], alerts[10]) == ("none", "investigate", "high_priority", "critical")


def test_chain_completeness(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 0, 0), (1, 1, 0)], "has_mfa_add int, has_mailbox_rule int, has_oauth_grant int")
    assert [(r.stages, r.completeness) for r in quality.chain_completeness(df).collect()] == [(2, "low"), (3, "medium"), (4, "high")]


def test_signal_alignment_counts_each_signal_once(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "asn string")
    b = spark.createDataFrame([("x",)], "asn string")
    got = {r.asn: (r.aligned_signals, r.confidence) for r in quality.signal_alignment([("a", a), ("b", b)], "asn").collect()}
    assert got == {"x": (2, "medium"), "y": (1, "low")}
