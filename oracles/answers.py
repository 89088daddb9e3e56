"""SQL answers of the registered queries, by inventory id."""

from __future__ import annotations

from oracles.bindings import compose
from oracles.detections import DETECTIONS, Q, REPORT, report_sql


def _clamp(value: str) -> str:
    return f"least(greatest({value}, 0.0), 1.0)"


def _top(rows: str, order: str) -> str:
    return f"(SELECT * FROM {rows} ORDER BY {order} LIMIT 1)"


def _accounts(rows: str, full: int, column: str = "account_id", where: str = "true") -> str:
    return f"SELECT count(DISTINCT {column}) FILTER (WHERE {where}) AS n, {_clamp(f'n / {full}.0::DOUBLE')} AS s FROM {rows}"


def _reaching(rows: str, column: str, at: int, full: int) -> str:
    return f"SELECT count(*) FILTER (WHERE {column} >= {at}) AS n, {_clamp(f'n / {full}.0::DOUBLE')} AS s FROM {rows}"


# key -> (detection, id, title, weight, SQL yielding the unrounded score ``s``)
# Ids, titles, weights, spans and advice texts.
SIGNALS: dict[str, tuple[str, str, str, float, str]] = {
    "sg01_cross_tenant_diversity": (
        "q03_tenant_diversity", "cross_tenant_diversity_asn", "Cross-tenant diversity on shared infrastructure", 1.2,
        f"SELECT {_clamp('(max(distinct_orgs) - 5) / 25::DOUBLE')} AS s FROM q03_tenant_diversity"),
    "sg02_hosting_vpn_concentration": (
        "q02_pct_flagged_infra", "hosting_vpn_concentration", "Hosting/VPN concentration", 0.9,
        f"SELECT {_clamp('pct_hosting_vpn / 100')} * {_clamp('total_reqs / 200::DOUBLE')} AS s FROM "
        + _top("q02_pct_flagged_infra", "pct_hosting_vpn DESC, hosting_vpn_reqs DESC, total_reqs DESC")),
    "sg03_synchronized_spikes": (
        "q06_sync_org_spikes", "synchronized_spikes", "Synchronized spikes across tenants", 1.0,
        f"SELECT {_clamp('max(reqs) / 500::DOUBLE')} AS s FROM q06_sync_org_spikes"),
    "sg04_template_reuse": (
        "q07_template_reuse", "template_reuse", "Template reuse across orgs", 0.8,
        f"SELECT {_clamp('max(orgs) / 10::DOUBLE')} AS s FROM q07_template_reuse"),
    "sg05_content_cluster_spread": (
        "q08_content_cluster_spread", "content_cluster_spread", "Content cluster spread", 0.7,
        f"SELECT {_clamp('max(orgs) / 12::DOUBLE')} AS s FROM q08_content_cluster_spread"),
    "sg06_policy_funnel": (
        "q09_policy_funnel", "policy_funnel", "Policy funnel concentration", 0.6,
        "SELECT " + _clamp("0.8::DOUBLE * (w::DOUBLE / t) + 1.2::DOUBLE * (b::DOUBLE / t)") + """ AS s
        FROM (SELECT sum(events) AS t, coalesce(sum(events) FILTER (WHERE policy_action = 'warn'), 0) AS w,
                     coalesce(sum(events) FILTER (WHERE policy_action = 'block'), 0) AS b
              FROM q09_policy_funnel GROUP BY asn_type, provider_brand_bucket
              ORDER BY t DESC, asn_type DESC, provider_brand_bucket DESC LIMIT 1)"""),
    "sg07_rate_limit_pressure": (
        "q11_rate_limit_summary", "rate_limit_pressure", "Rate limit / throttling pressure", 0.5,
        "SELECT " + _clamp("1.2::DOUBLE * (sum(events) FILTER (WHERE enforcement_action = 'throttle')::DOUBLE / sum(events))")
        + " AS s FROM q11_rate_limit_summary"),
    "sg08_failed_login_bursts": (
        "q12_failed_login_bursts", "failed_login_bursts", "Failed Login Bursts", 1.0,
        f"SELECT max(failures_in_10m) AS n, {_clamp('(n - 6) / 24::DOUBLE')} AS s FROM q12_failed_login_bursts"),
    "sg09_new_asn_after_failures": (
        "q13_new_asn_after_failures", "new_asn_after_failures", "New ASN Success After Failures", 1.5,
        _accounts("q13_new_asn_after_failures", 15)),
    "sg10_mfa_manipulation": (
        "q14_mfa_device_added", "mfa_manipulation", "MFA Device Manipulation", 1.3, _accounts("q14_mfa_device_added", 10)),
    "sg11_mailbox_rule_abuse": (
        "q16_mailbox_rule_creation", "mailbox_rule_abuse", "Mailbox Rule Abuse", 1.2,
        _accounts("q16_mailbox_rule_creation", 10)),
    "sg12_oauth_consent_abuse": (
        "q17_oauth_consent_grants", "oauth_consent_abuse", "OAuth Consent Abuse", 1.1,
        _accounts("q17_oauth_consent_grants", 8)),
    "sg13_ato_chain_detection": (
        "q18_ato_chain_candidates", "ato_chain_detection", "Account Takeover Chain Detection", 2.0,
        _reaching("q18_ato_chain_candidates", "risk_score", 80, 20)),
    "sg14_dns_triage_detection": (
        "q24_dns_rollup", "dns_triage_detection", "DNS Triage Detection Quality", 1.5,
        "SELECT " + _clamp("CASE WHEN precision IS NULL OR recall IS NULL THEN 2.0 * flagged_events / total_dns_events "
                           "WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END")
        + " AS s FROM q24_dns_rollup"),
    "sg15_unusual_pod_creation": (
        "q25_unusual_pod_creation", "unusual_pod_creation", "Unusual Pod Creation Patterns", 0.8,
        _reaching("q25_unusual_pod_creation", "anomaly_score", 4, 15)),
    "sg16_non_standard_registries": (
        "q26_non_standard_registries", "non_standard_registries", "Non-Standard Container Registries", 1.0,
        _reaching("q26_non_standard_registries", "avg_risk_score", 4, 15)),
    "sg17_resource_anomalies": (
        "q27_resource_anomalies", "resource_anomalies", "K8s Resource Anomalies", 1.2,
        _reaching("q27_resource_anomalies", "resource_anomaly_score", 5, 20)),
    "sg18_mining_pool_egress": (
        "q28_mining_pool_egress", "mining_pool_egress", "Mining Pool Connections (DEFINITIVE)", 2.0,
        _accounts("q28_mining_pool_egress", 10, "pod_id")),
    "sg19_service_account_abuse": (
        "q29_service_account_abuse", "service_account_abuse", "Service Account Abuse", 1.1,
        _reaching("q29_service_account_abuse", "abuse_score", 5, 15)),
    "sg20_correlated_k8s_signals": (
        "q30_correlated_signals", "correlated_k8s_signals", "Correlated K8s Attack Signals", 2.5,
        _accounts("q30_correlated_signals", 10, "pod_id", "confidence_score = 10")),
}
PACK_SIGNALS = {
    "coordinated": list(SIGNALS)[:7],
    "takeover": list(SIGNALS)[7:13],
    "dns": list(SIGNALS)[13:14],
    "cluster": list(SIGNALS)[14:],
}
PACK_DETECTIONS = {
    "coordinated": DETECTIONS[:11],
    "takeover": DETECTIONS[11:19],
    "dns": DETECTIONS[19:24],
    "cluster": DETECTIONS[24:],
}


def _signal(key: str) -> str:
    detection, ident, title, weight, sql = SIGNALS[key]
    return (
        f"SELECT '{ident}' AS id, '{title}' AS title, {weight}::DOUBLE AS weight, s, "
        f"round_even(s * 100, 1)::DOUBLE AS score FROM ({sql}) WHERE (SELECT count(*) FROM {detection}) > 0"
    )


# Saturation of the scaled signals: the point where the score starts and the length over which it rises.
_SCALED = {
    "sg04_template_reuse": ("max(orgs)", 0, 40),
    "sg05_content_cluster_spread": ("max(orgs)", 0, 30),
    "sg08_failed_login_bursts": ("max(failures_in_10m)", 2, 8),
    "sg09_new_asn_after_failures": ("count(DISTINCT account_id)", 0, 400),
    "sg10_mfa_manipulation": ("count(DISTINCT account_id)", 0, 200),
    "sg11_mailbox_rule_abuse": ("count(DISTINCT account_id)", 0, 160),
    "sg12_oauth_consent_abuse": ("count(DISTINCT account_id)", 0, 600),
    "sg13_ato_chain_detection": ("count(*) FILTER (WHERE risk_score >= 80)", 0, 250),
    "sg15_unusual_pod_creation": ("count(*) FILTER (WHERE anomaly_score >= 4)", 0, 500),
    "sg16_non_standard_registries": ("count(*) FILTER (WHERE avg_risk_score >= 4)", 0, 350),
    "sg17_resource_anomalies": ("count(*) FILTER (WHERE resource_anomaly_score >= 5)", 0, 30000),
    "sg18_mining_pool_egress": ("count(DISTINCT pod_id)", 0, 20000),
    "sg19_service_account_abuse": ("count(*) FILTER (WHERE abuse_score >= 5)", 0, 240),
    "sg20_correlated_k8s_signals": ("count(DISTINCT pod_id) FILTER (WHERE confidence_score = 10)", 0, 1000),
}


def _scaled(pack: str) -> tuple[str, list[str]]:
    rows = []
    for key in PACK_SIGNALS[pack]:
        detection, ident, title, weight, sql = SIGNALS[key]
        if key in _SCALED:
            metric, start, length = _SCALED[key]
            sql = f"SELECT {_clamp(f'({metric} - {start}) / {length}.0::DOUBLE')} AS s FROM {detection}"
        rows.append(
            f"SELECT '{ident}' AS id, '{title}' AS title, {weight}::DOUBLE AS weight, s, round_even(s * 100, 1)::DOUBLE AS score "
            f"FROM ({sql}) WHERE (SELECT count(*) FROM {detection}) > 0"
        )
    return "(" + " UNION ALL ".join(rows) + ")", [SIGNALS[k][0] for k in PACK_SIGNALS[pack]]


def _signals(keys: list[str]) -> tuple[str, list[str]]:
    return "(" + " UNION ALL ".join(_signal(k) for k in keys) + ")", [SIGNALS[k][0] for k in keys]


def _severity(score: str, high: int, medium: int) -> str:
    return f"CASE WHEN {score} >= {high} THEN 'high' WHEN {score} >= {medium} THEN 'medium' ELSE 'low' END"


def _overall(pack: str, scaled: bool = False) -> str:
    rows, needs = _scaled(pack) if scaled else _signals(PACK_SIGNALS[pack])
    return compose(
        f"""SELECT overall_risk_score, signal_count, {_severity('overall_risk_score', 70, 40)} AS severity
        FROM (SELECT coalesce(round_even(100 * (sum(weight * s) / sum(weight)), 0), 0)::INT AS overall_risk_score,
                     count(*) AS signal_count FROM {rows})""",
        *needs, extra=Q)


def _manifest(pack: str) -> str:
    parts = []
    for name in PACK_DETECTIONS[pack]:
        limit = REPORT[name].rpartition("LIMIT ")[2] if "LIMIT" in REPORT[name] else "9000000000000"
        ident = COLUMNS[name]
        parts.append(
            f"SELECT '{name}' AS name, least(count(*), {limit})::BIGINT AS row_count, '{ident}' AS columns FROM {name}"
        )
    return compose(" UNION ALL ".join(parts), *PACK_DETECTIONS[pack], extra=Q)


_WHO = "distinct_orgs,distinct_accounts"
_EVENT = "ts,org_id,account_id,ip,asn,device_fingerprint,user_agent,campaign_id,is_attack"
_REUSE = "reqs,accounts,orgs,first_seen_ts,last_seen_ts"
COLUMNS = {
    "q01_first_seen_hosting_asn":
        "asn,asn_type,provider_category,provider_brand_bucket,first_seen_ts,requests," + _WHO,
    "q02_pct_flagged_infra": "account_id,org_id,total_reqs,hosting_vpn_reqs,pct_hosting_vpn",
    "q03_tenant_diversity": f"asn,asn_type,provider_brand_bucket,{_WHO},requests,reqs_per_account",
    "q04_device_reuse": "device_fingerprint,is_headless,browser_family,os_family,distinct_accounts,distinct_orgs,requests",
    "q05_burst_zscore": "asn,asn_type,provider_brand_bucket,bucket_ts,reqs,accounts,orgs,zscore",
    "q06_sync_org_spikes": "bucket_ts,provider_brand_bucket,asn_type,reqs,orgs,accounts",
    "q07_template_reuse": "template_hash," + _REUSE,
    "q08_content_cluster_spread": "content_cluster_id," + _REUSE,
    "q09_policy_funnel": "asn_type,provider_brand_bucket,policy_action,events,accounts,orgs",
    "q10_cluster_keys": "asn_type,provider_brand_bucket,device_fingerprint,content_cluster_id,template_hash,"
                        "reqs,orgs,accounts,automation_flags,first_seen_ts,last_seen_ts",
    "q11_rate_limit_summary": "scope,enforcement_action,events,asns,accounts",
    "q12_failed_login_bursts": "org_id,account_id,bucket_start,failures_in_10m,first_ts,last_ts,sample_ip,sample_asn,"
                               "asn_type,provider_category,provider_brand_bucket",
    "q13_new_asn_after_failures": "org_id,account_id,bucket_start,failures_in_10m,first_fail_ts,last_fail_ts,"
                                  "sample_fail_ip,sample_fail_asn,success_ts,success_ip,success_asn,"
                                  "device_fingerprint,user_agent,campaign_id,is_attack",
    "q14_mfa_device_added": _EVENT,
    "q15_success_after_mfa": "org_id,account_id,mfa_ts,success_ts,minutes_after_mfa,mfa_ip,mfa_asn,mfa_device,"
                             "success_ip,success_asn,success_device,campaign_id,is_attack",
    "q16_mailbox_rule_creation": _EVENT,
    "q17_oauth_consent_grants": "org_id,account_id,grant_ts,grant_ip,grant_asn,device_fingerprint,user_agent,"
                                "success_ts,success_ip,success_asn,campaign_id,is_attack",
    "q18_ato_chain_candidates": "org_id,account_id,failures_in_10m,first_fail_ts,last_fail_ts,new_asn_success_ts,"
                                "new_asn_success_ip,new_asn_success_asn,device_fingerprint,user_agent,is_attack,"
                                "campaign_id,mfa_add_ts,mailbox_rule_ts,oauth_grant_ts,has_mfa_add,has_mailbox_rule,"
                                "has_oauth_grant,risk_score",
    "q19_ato_rollup": "org_id,account_id,has_failures,has_success,has_mfa_add,has_mailbox_rule,has_oauth_grant,risk_score",
    "q20_top_suspicious_domains": "base_domain,tld,query_count,affected_accounts,affected_orgs,avg_score,max_score,"
                                  "suspicious_tld_count,keyword_hit_count,high_entropy_count,rare_domain_count,sample_host",
    "q21_domain_chain_clusters": "parent_domain,child_domain,chain_occurrences,affected_accounts,avg_child_score,"
                                 "chain_risk_category",
    "q22_exposed_accounts": "account_id,org_id,device_fingerprint,distinct_suspicious_domains,total_risk_score,"
                            "avg_risk_score,max_risk_score,suspicious_tld_queries,keyword_hit_queries,"
                            "high_entropy_queries,first_suspicious_query,last_suspicious_query",
    "q23_heuristic_breakdown": "heuristic,trigger_count",
    "q24_dns_rollup": "total_dns_events,distinct_domains,distinct_accounts,flagged_events,malicious_events,"
                      "true_positives,false_positives,false_negatives,precision,recall",
    "q25_unusual_pod_creation": "hour,namespace,service_account,pod_creation_count,off_hours_count,off_hours_pct,"
                                "unique_images,total_cpu_requested,total_gpu_requested,anomaly_score,is_malicious",
    "q26_non_standard_registries": "namespace,service_account,registry_domain,unique_images,total_pods,first_seen,"
                                   "last_seen,total_cpu_requested,total_gpu_requested,avg_risk_score,is_malicious",
    "q27_resource_anomalies": "namespace,pod_id,pod_name,avg_cpu_cores,max_cpu_cores,avg_memory_gb,"
                              "avg_gpu_utilization,max_gpu_utilization,sample_count,lifetime_hours,"
                              "resource_anomaly_score,is_malicious",
    "q28_mining_pool_egress": "namespace,pod_id,pod_name,dst_host,dst_port,connection_count,gb_sent,mb_received,"
                              "avg_duration_min,first_connection,last_connection,connection_span_hours,"
                              "confidence_score,is_malicious,alert_message",
    "q29_service_account_abuse": "service_account,namespace,source_ip,ip_classification,total_events,namespace_count,"
                                 "total_pod_creations,external_pulls,total_failures,first_seen,last_seen,abuse_score,"
                                 "is_malicious",
    "q30_correlated_signals": "namespace,pod_id,pod_name,service_account,container_image,created_at,"
                              "avg_gpu_utilization,avg_cpu_cores,unique_mining_hosts,gb_sent_to_pools,"
                              "attack_chain_id,is_malicious,confidence_score,verdict",
    "q31_attack_chain_rollup": "attack_chain_id,compromised_account,namespace,total_pods,attack_start,attack_end,"
                               "attack_duration_hours,total_cpu_requested,total_gpu_requested,unique_images,"
                               "avg_gpu_utilization,max_gpu_util,total_cpu_hours_consumed,mining_hosts_contacted,"
                               "gb_egressed_to_pools,mining_connections,hours_connected_to_pools,is_malicious,"
                               "severity_score",
}

ADDITIVE = {
    "q25_unusual_pod_creation": 0.15, "q26_non_standard_registries": 0.20, "q27_resource_anomalies": 0.25,
    "q28_mining_pool_egress": 0.40, "q29_service_account_abuse": 0.22, "q30_correlated_signals": 0.50,
}
_ADDITIVE_ROWS = "(" + " UNION ALL ".join(
    f"SELECT '{name}' AS signal, count(*) AS row_count, {w}::DOUBLE AS weight, least(1.0::DOUBLE, count(*) / 10) AS share FROM {name}"
    for name, w in ADDITIVE.items()) + ")"

_TAKEOVER_ROWS = {
    "sg08_failed_login_bursts": "'rows=' || (SELECT count(*) FROM q12_failed_login_bursts) || ', max_burst=' || n",
    "sg09_new_asn_after_failures": "'rows=' || (SELECT count(*) FROM q13_new_asn_after_failures) || ', account_count=' || n",
    "sg10_mfa_manipulation": "'rows=' || (SELECT count(*) FROM q14_mfa_device_added) || ', account_count=' || n",
    "sg11_mailbox_rule_abuse": "'rows=' || (SELECT count(*) FROM q16_mailbox_rule_creation) || ', account_count=' || n",
    "sg12_oauth_consent_abuse": "'rows=' || (SELECT count(*) FROM q17_oauth_consent_grants) || ', account_count=' || n",
    "sg13_ato_chain_detection":
        "'rows=' || (SELECT count(*) FROM q18_ato_chain_candidates) || ', high_risk_count=' || n || ', medium_risk_count=' || "
        "(SELECT count(*) FROM q18_ato_chain_candidates WHERE risk_score >= 50 AND risk_score < 80)",
}


def _evidence() -> str:
    rows = []
    for key, text in _TAKEOVER_ROWS.items():
        _, ident, title, weight, sql = SIGNALS[key]
        rows.append(
            f"SELECT '{ident}' AS id, '{title}' AS title, round_even(s * 100, 1)::DOUBLE AS score, "
            f"{weight}::DOUBLE AS weight, {text} AS evidence_text FROM ({sql})"
        )
    return compose(
        f"SELECT {_severity('score', 80, 40)} AS severity, * FROM ({' UNION ALL '.join(rows)})",
        *[SIGNALS[k][0] for k in _TAKEOVER_ROWS], extra=Q)


# Default lists of the domain heuristics.
_TLDS = (
    "xyz top icu club link click tk cf ml ga gq pw win loan date party racing stream bid trade accountant faith science download webcam"
)
_KEYWORDS = (
    "login secure verification verify update account support auth office microsoft apple paypal bank wallet crypto giftcard helpdesk"
)

_NEAR = "c.event_time >= a.started_at AND c.event_time <= a.started_at + INTERVAL "


def oracle_sql() -> dict[str, str]:
    answers = {}
    for name in DETECTIONS:
        sql, needs = report_sql(name)
        answers[name] = compose(sql, *needs, extra=Q)
    for key, (detection, *_rest) in SIGNALS.items():
        answers[key] = compose(f"SELECT id, title, weight, score FROM ({_signal(key)})", detection, extra=Q)
    for pack in PACK_SIGNALS:
        answers[f"sg22_overall_{pack}"] = _overall(pack)
        answers[f"mf02_manifest_{pack}"] = _manifest(pack)
    rows, needs = _signals(PACK_SIGNALS["takeover"])
    answers["sg23_ranked_signals"] = compose(
        f"SELECT id, title, weight, score, {_severity('score', 80, 40)} AS severity FROM {rows}", *needs, extra=Q)
    rows, needs = _signals(PACK_SIGNALS["cluster"])
    answers["sg25_signal_severity"] = compose(
        f"SELECT id, {_severity('score', 80, 40)} AS severity FROM {rows}", *needs, extra=Q)
    answers["sg24_additive_signals"] = compose(
        f"SELECT signal, row_count, weight, round(share, 3) AS normalized_score, round(share * weight, 3) AS weighted_score "
        f"FROM {_ADDITIVE_ROWS}", *ADDITIVE, extra=Q)
    answers["sg24_additive_risk"] = compose(
        f"""SELECT round(total, 3) AS total_score, risk_level,
            CASE risk_level
              WHEN 'CRITICAL' THEN 'Immediate investigation required - high confidence cryptomining detected'
              WHEN 'HIGH' THEN 'Priority investigation - multiple abuse indicators present'
              WHEN 'MEDIUM' THEN 'Review flagged pods and service accounts for anomalous behavior'
              ELSE 'Continue monitoring - isolated signals detected' END AS recommendation
        FROM (SELECT round(sum(share * weight), 9) AS total,
                     CASE WHEN total >= 0.4 THEN 'CRITICAL' WHEN total >= 0.25 THEN 'HIGH'
                          WHEN total >= 0.15 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM {_ADDITIVE_ROWS})""",
        *ADDITIVE, extra=Q)
    for pack in ("coordinated", "takeover", "cluster"):
        rows, needs = _scaled(pack)
        answers[f"sg21_scaled_signals_{pack}"] = compose(
            f"SELECT id, title, weight, score, {_severity('score', 80, 40)} AS severity FROM {rows}", *needs, extra=Q)
        answers[f"sg22_scaled_overall_{pack}"] = _overall(pack, scaled=True)
    counts = " UNION ALL ".join(f"SELECT count(*) AS n, {w}::DOUBLE AS w FROM {name}" for name, w in ADDITIVE.items())
    answers["sg24_additive_levels"] = compose(
        f"""SELECT full_rows::BIGINT AS full_rows, round(total, 3) AS total_score, risk_level,
            CASE risk_level
              WHEN 'CRITICAL' THEN 'Immediate investigation required - high confidence cryptomining detected'
              WHEN 'HIGH' THEN 'Priority investigation - multiple abuse indicators present'
              WHEN 'MEDIUM' THEN 'Review flagged pods and service accounts for anomalous behavior'
              ELSE 'Continue monitoring - isolated signals detected' END AS recommendation
        FROM (SELECT full_rows, round(sum(least(1.0::DOUBLE, n / full_rows::DOUBLE) * w), 9) AS total,
                     CASE WHEN total >= 0.4 THEN 'CRITICAL' WHEN total >= 0.25 THEN 'HIGH'
                          WHEN total >= 0.15 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
              FROM ({counts}), (VALUES (1000), (30000), (60000), (100000)) v(full_rows) GROUP BY full_rows)""",
        *ADDITIVE, extra=Q)
    answers["q05_default_width"] = compose(
        """SELECT asn, asn_type, provider_brand_bucket, bucket_ts, reqs, accounts, orgs, round((reqs - m) / s, 2) AS zscore
        FROM (SELECT *, avg(reqs) OVER (PARTITION BY asn) AS m, stddev_pop(reqs) OVER (PARTITION BY asn) AS s
              FROM (SELECT asn, time_bucket(INTERVAL '15 minutes', ts) AS bucket_ts, count(*) AS reqs,
                           count(DISTINCT account_id) AS accounts, count(DISTINCT org_id) AS orgs
                    FROM requests GROUP BY ALL))
        JOIN networks USING (asn) WHERE s > 0 ORDER BY zscore DESC, reqs DESC, asn, bucket_ts LIMIT 400""", "requests", "networks")
    answers["q06_default_width"] = compose(
        """SELECT time_bucket(INTERVAL '15 minutes', ts) AS bucket_ts, provider_brand_bucket, asn_type, count(*) AS reqs,
               count(DISTINCT org_id) AS orgs, count(DISTINCT account_id) AS accounts
        FROM requests JOIN networks USING (asn) WHERE asn_type IN ('vpn', 'hosting') GROUP BY ALL HAVING orgs >= 2
        ORDER BY orgs DESC, accounts DESC, reqs DESC, bucket_ts, provider_brand_bucket, asn_type LIMIT 300""",
        "requests", "networks")
    answers["q25_default_width"] = compose(
        Q["q25_unusual_pod_creation"][1].replace("date_trunc('month'", "date_trunc('hour'") + " " + REPORT["q25_unusual_pod_creation"],
        "created")
    answers["ev05_ordered_completeness"] = compose(
        """SELECT org_id, account_id, 2 + mfa + rule + consent AS stages,
               CASE WHEN stages >= 4 THEN 'high' WHEN stages = 3 THEN 'medium' ELSE 'low' END AS completeness
        FROM (SELECT c.org_id, c.account_id, coalesce(bool_or(i.event_type = 'auth.mfa.add'), false)::INT AS mfa,
                     coalesce(bool_or(i.event_type = 'mailbox.rule.create'), false)::INT AS rule,
                     coalesce(bool_or(i.event_type = 'oauth.consent.grant'), false)::INT AS consent
              FROM q18_ato_chain_candidates c
              LEFT JOIN identity i ON i.org_id = c.org_id AND i.account_id = c.account_id AND i.ts >= c.new_asn_success_ts
              GROUP BY ALL)""", "q18_ato_chain_candidates", "identity", extra=Q)
    answers["h01_users_near_sessions"] = compose(
        f"""SELECT a.session_id, a.user_email AS session_user, c.event_time, c.actor, c.target AS new_user, c.target AS target_email
        FROM agents a JOIN changes c ON {_NEAR} '30 minutes' WHERE c.kind = 'user_create'""", "agents", "changes")
    answers["h02_role_grants_near_sessions"] = compose(
        f"""SELECT a.session_id, c.target AS new_user, g.details AS role_grant_details, g.actor AS role_grant_actor,
               g.event_time AS role_grant_time
        FROM agents a JOIN changes c ON c.kind = 'user_create' AND {_NEAR} '2 hours'
        JOIN changes g ON g.kind = 'role_grant' AND g.target = c.target
         AND g.event_time >= c.event_time AND g.event_time <= c.event_time + INTERVAL '2 hours'
        WHERE contains(lower(g.details), '"k": 7')""", "agents", "changes")
    answers["h03_resets_after_creation"] = compose(
        """SELECT c.target AS user_created, r.event_time AS reset_time, r.actor AS reset_actor, r.details AS details_json
        FROM changes c JOIN changes r ON r.target = c.target AND r.event_time >= c.event_time
         AND r.event_time <= c.event_time + INTERVAL '2 hours'
        WHERE c.kind = 'user_create' AND r.kind = 'password_reset'""", "changes")
    answers["h04_new_privileged_users"] = compose(
        """SELECT c.event_time AS t_create, c.target AS user, c.actor, g.event_time AS t_role, g.details
        FROM changes c JOIN changes g ON g.target = c.target AND g.event_time >= c.event_time
         AND g.event_time <= c.event_time + INTERVAL '6 hours'
        WHERE c.kind = 'user_create' AND g.kind = 'role_grant' AND contains(lower(g.details), '"k": 7')""", "changes")
    answers["h05_changes_after_sessions"] = compose(
        f"""SELECT a.user_email AS session_user, a.session_id, string_agg(DISTINCT c.kind, ',' ORDER BY c.kind) AS events,
               string_agg(DISTINCT c.target::VARCHAR, ',' ORDER BY c.target::VARCHAR) AS targets,
               string_agg(DISTINCT c.actor, ',' ORDER BY c.actor) AS actors
        FROM agents a JOIN changes c ON c.target = a.user_email AND {_NEAR} '1 day'
        WHERE a.source <> 'portal' GROUP BY a.user_email, a.session_id""", "agents", "changes")
    answers["h06_exposure_then_failure"] = compose(
        """SELECT account_id, last_suspicious_dns, first_failed_login,
               round(epoch(first_failed_login - last_suspicious_dns) / 3600, 4) AS time_delta_hours
        FROM (SELECT account_id, max(ts) AS last_suspicious_dns FROM dns WHERE score >= 7 GROUP BY account_id)
        JOIN (SELECT account_id, min(ts) AS first_failed_login FROM failed GROUP BY account_id) USING (account_id)
        WHERE first_failed_login >= last_suspicious_dns AND first_failed_login <= last_suspicious_dns + INTERVAL '60 days'""",
        "dns", "failed")
    answers["ft01_suspicious_tld"] = compose("SELECT request_id, tld = 'net' AS suspicious_tld FROM hosts", "hosts")
    answers["ft02_keyword_hit"] = compose(
        "SELECT request_id, regexp_matches(host_raw, 'blog|pill|cheap') AS keyword_hit FROM hosts", "hosts")
    answers["ft03_domain_entropy"] = compose(
        """SELECT base_domain, domain_count, suspicious_tld, keyword_hit, round(entropy, 6) AS entropy, high_entropy,
               rare_domain, score FROM domains""", "domains")
    answers["ft03_text_entropy"] = (
        "SELECT page_id, round(list_aggregate(regexp_extract_all(url, '.'), 'entropy'), 6) AS entropy FROM pages")
    answers["ft04_rare_domain"] = compose(
        "SELECT request_id, base_domain, count(*) OVER (PARTITION BY base_domain) <= 60 AS rare_domain FROM hosts", "hosts")
    answers["ft05_composite_score"] = compose(
        "SELECT request_id, suspicious_tld, keyword_hit, high_entropy, rare_domain, score FROM dns", "dns")
    answers["ft06_transition_edges"] = compose(
        """SELECT request_id, base_domain, coalesce(lag(base_domain) OVER (
               PARTITION BY account_id, device_fingerprint ORDER BY ts, request_id), '') AS parent_domain FROM hosts""", "hosts")
    answers["ft07_base_domain"] = """
        SELECT page_id, '.' || upper(split_part(url, '/', 3)) || '. ' AS host_raw,
               regexp_extract(split_part(url, '/', 3), '[^.]+[.][^.]+$') AS base_domain,
               regexp_extract(split_part(url, '/', 3), '[^.]+$') AS tld FROM pages"""
    answers["ft08_unified_identity"] = compose(
        """SELECT start_ts AS ts, org_id, account_id, ip, asn, device_fingerprint, 'agent/0' AS user_agent,
               'auth.signin' AS event_type, 'success' AS outcome, '' AS campaign_id, false AS is_attack
        FROM sessions WHERE ip IS NOT NULL
        UNION ALL SELECT ts, org_id, account_id, ip, asn, device_fingerprint, user_agent, event_type, outcome,
               campaign_id, is_attack FROM identity WHERE event_type <> 'auth.signin'""", "sessions", "identity")
    answers["ft09_business_hours"] = compose(
        """SELECT namespace, hour(timestamp) >= 9 AND hour(timestamp) <= 17 AND dayofweek(timestamp) NOT IN (0, 6)
               AS business_hours, count(*) AS events FROM audit GROUP BY ALL""", "audit")
    answers["ft10_dns_summary"] = compose(
        """SELECT count(*) AS row_count, count(*) FILTER (WHERE is_malicious) AS malicious_events,
               count(*) FILTER (WHERE NOT is_malicious) AS benign_events, count(*) FILTER (WHERE rare_domain) AS rare_domains,
               count(*) FILTER (WHERE parent_domain <> '') AS chains FROM dns""", "dns")
    answers["ft11_distinct_accounts"] = compose("SELECT org_id, account_id FROM requests GROUP BY ALL", "requests")
    answers["ev01_quality"] = compose(
        """SELECT total_events, flagged_events, malicious_events, true_positives, false_positives, false_negatives,
               precision, recall, round(2 * precision * recall / (precision + recall), 6) AS f1,
               round(flagged_events / total_events::DOUBLE, 6) AS flagged_rate
        FROM (SELECT count(*) AS total_events, count(*) FILTER (WHERE score > 3) AS flagged_events,
                     count(*) FILTER (WHERE is_malicious) AS malicious_events,
                     count(*) FILTER (WHERE score > 3 AND is_malicious) AS true_positives,
                     count(*) FILTER (WHERE score > 3 AND NOT is_malicious) AS false_positives,
                     count(*) FILTER (WHERE score <= 3 AND is_malicious) AS false_negatives,
                     round(true_positives::DOUBLE / flagged_events, 3) AS precision,
                     round(true_positives::DOUBLE / malicious_events, 3) AS recall
              FROM dns)""", "dns")
    answers["ev04_dns_bands"] = compose(
        """SELECT CASE WHEN score = 0 THEN 'benign' WHEN score <= 2 THEN 'low' WHEN score <= 4 THEN 'medium' ELSE 'high' END
               AS band, count(*) AS queries FROM dns GROUP BY ALL""", "dns")
    answers["ev05_chain_completeness"] = compose(
        """SELECT org_id, account_id, 2 + has_mfa_add + has_mailbox_rule + has_oauth_grant AS stages,
               CASE WHEN stages >= 4 THEN 'high' WHEN stages = 3 THEN 'medium' ELSE 'low' END AS completeness
        FROM q18_ato_chain_candidates""", "q18_ato_chain_candidates", extra=Q)
    answers["ev06_alert_priority"] = compose(
        """SELECT CASE WHEN score >= 10 THEN 'critical' WHEN score >= 8 THEN 'high_priority' WHEN score >= 5 THEN 'investigate'
               ELSE 'none' END AS priority, count(*) AS alerts
        FROM (SELECT resource_anomaly_score AS score FROM q27_resource_anomalies
              UNION ALL SELECT abuse_score FROM q29_service_account_abuse
              UNION ALL SELECT confidence_score FROM q28_mining_pool_egress) GROUP BY ALL""",
        "q27_resource_anomalies", "q28_mining_pool_egress", "q29_service_account_abuse", extra=Q)
    answers["ev07_signal_alignment"] = compose(
        """SELECT asn, (has_diverse + has_flagged + has_bursty + has_dense)::BIGINT AS aligned_signals,
               has_diverse, has_flagged, has_bursty, has_dense,
               CASE WHEN aligned_signals >= 4 THEN 'high' WHEN aligned_signals >= 2 THEN 'medium' ELSE 'low' END AS confidence
        FROM (SELECT asn, (distinct_orgs >= 22)::INT AS has_diverse, (asn_type IN ('hosting', 'vpn'))::INT AS has_flagged,
                     (asn IN (SELECT asn FROM q05_burst_zscore WHERE zscore >= 2.5))::INT AS has_bursty,
                     (reqs_per_account >= 1.4)::INT AS has_dense
              FROM q03_tenant_diversity)
        WHERE aligned_signals > 0""", "q03_tenant_diversity", "q05_burst_zscore", extra=Q)
    answers["io05_table_counts"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
                  "labels conversations").split())
    answers["io04_loaded_tables"] = answers["io05_table_counts"] + "".join(
        f" UNION ALL SELECT '{t}', 0" for t in ("sessions", "rate_limit_events", "osint_observations"))
    answers["io02_named_table"] = "SELECT event_type, count(*) AS n_events, 0::BIGINT AS n_sessions FROM events GROUP BY event_type"
    answers["io03_required_tables"] = compose(
        """SELECT 'k8s_audit_logs' AS table_name, count(*) AS row_count FROM audit
        UNION ALL SELECT 'resource_metrics', count(*) FROM lines UNION ALL SELECT 'network_flows', count(*) FROM lines""",
        "audit", "lines")
    answers["io06_csv_round_trip"] = compose("SELECT * FROM requests", "requests")
    answers["io07_parquet_round_trip"] = compose("SELECT * FROM identity", "identity")
    answers["io09_json_round_trip"] = answers["sg22_scaled_overall_cluster"]
    answers["pf16_defaults_and_numbers"] = """
        SELECT event_id, event_type, CASE WHEN event_id % 3 <> 0 THEN regexp_extract(props, '([0-9]+)', 1)::BIGINT END AS number,
               '' AS campaign_id FROM events"""
    dns = PACK_DETECTIONS["dns"]
    answers["mf01_run_of_a_pack"] = f"""SELECT name, CASE WHEN name <> '{dns[2]}' THEN row_count END AS row_count,
               CASE WHEN name <> '{dns[2]}' THEN columns END AS columns, name = '{dns[2]}' AS failed
        FROM ({answers["mf02_manifest_dns"]})"""
    answers["ft05_dns_build"] = compose(
        f"""SELECT ts, request_id, org_id, account_id, device_fingerprint, host_raw, base_domain, split_part(base_domain, '.', -1) AS tld,
               coalesce(lag(base_domain) OVER (PARTITION BY account_id, device_fingerprint ORDER BY ts, request_id), '') AS parent_domain,
               suspicious_tld, keyword_hit, high_entropy, rare_domain,
               (2 * suspicious_tld::INT + 3 * keyword_hit::INT + high_entropy::INT + rare_domain::INT)::BIGINT AS score
        FROM (SELECT *, regexp_extract(host_raw, '[^.]+[.][^.]+$') AS base_domain FROM hosts_raw)
        JOIN (SELECT base_domain, count(*) <= 5 AS rare_domain,
                     split_part(base_domain, '.', -1) IN ({", ".join(f"'{x}'" for x in _TLDS.split())}) AS suspicious_tld,
                     regexp_matches(base_domain, '{"|".join(_KEYWORDS.split())}') AS keyword_hit,
                     list_aggregate(regexp_extract_all(replace(base_domain, '.', ''), '.'), 'entropy') > 3.5 AS high_entropy
              FROM (SELECT regexp_extract(host_raw, '[^.]+[.][^.]+$') AS base_domain FROM hosts_raw) GROUP BY base_domain)
        USING (base_domain)""", "hosts_raw", extra={
            "hosts_raw": (("hosts",), "SELECT ts, request_id, org_id, account_id, device_fingerprint, host_raw FROM hosts")})
    answers["jn07_keyed_interval"] = """
        SELECT e.user_id, e.ts AS error_ts, p.ts AS purchase_ts FROM events e JOIN events p
          ON p.user_id = e.user_id AND p.ts >= e.ts AND p.ts <= e.ts + INTERVAL '6 hours'
        WHERE e.event_type = 'error' AND p.event_type = 'purchase'"""
    answers["wn02_previous_event"] = """
        SELECT event_id, user_id, ts, event_type,
               CASE WHEN lag(ts) OVER w >= ts - INTERVAL '2 days' THEN lag(event_type) OVER w END AS previous_type
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""
    answers["sc12_clock_functions"] = """
        SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS bucket, date_trunc('hour', ts) AS hour_start,
               hour(ts)::INT AS hour_of_day, dayofweek(ts)::INT AS weekday,
               round(epoch(ts - TIMESTAMP '2024-01-01'), 6) AS seconds_since,
               datediff('minute', ts, ts + INTERVAL '95 seconds') AS minutes_crossed FROM events"""
    answers["sc11_address_classes"] = compose(
        """SELECT CASE WHEN source_ip LIKE '10.%' THEN 'internal' ELSE 'external' END AS ip_classification,
               split_part(container_image, '/', 1) AS registry_domain, count(*) AS events FROM audit GROUP BY ALL""", "audit")
    answers["sc28_lenient_numbers"] = """
        SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN regexp_extract(props, '([0-9]+)', 1)::DOUBLE END AS number FROM events"""
    answers["pf18_parsed_times"] = "SELECT event_id, ts FROM events WHERE event_id % 7 <> 0"
    answers["mf03_evidence"] = _evidence()
    answers |= _stored_and_streamed(answers)
    return answers


def _stored_and_streamed(answers: dict[str, str]) -> dict[str, str]:
    """Answers of the forms that read stored days, bucketed tables, earlier runs or a stream: the same as of the plain ones."""
    close = "true AS distinct_orgs_close, true AS distinct_accounts_close"
    days = "WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'"
    found = {
        "ag02_stored_first_seen": compose(
            f"SELECT *, true AS stored_alike, {close} FROM ({Q['q01_first_seen_hosting_asn'][1].replace('FROM requests', f'FROM (SELECT * FROM requests {days})')})",
            "requests", "networks"),
        "ag03_stored_diversity": compose(f"SELECT *, {close} FROM ({Q['q03_tenant_diversity'][1]})", "requests", "networks"),
        "ag03_stored_spikes": compose(
            f"SELECT *, true AS orgs_close, true AS accounts_close FROM ({Q['q06_sync_org_spikes'][1].replace('HAVING orgs >= 10', '')})",
            "requests", "networks"),
        "ag21_session_change_values": compose(
            f"""SELECT DISTINCT session_user, session_id, kind, value FROM (
                UNPIVOT (SELECT a.user_email AS session_user, a.session_id, c.kind AS events, c.target::VARCHAR AS targets, c.actor AS actors
                         FROM agents a JOIN changes c ON c.target = a.user_email AND {_NEAR} '1 day' WHERE a.source <> 'portal')
                ON events, targets, actors INTO NAME kind VALUE value)""", "agents", "changes"),
        "ag22_rarity_by_day": compose(
            """SELECT request_id, base_domain, n <= 60 AS rare_domain
            FROM (SELECT *, count(*) OVER (PARTITION BY base_domain ORDER BY part) AS n
                  FROM (SELECT *, least((day(ts) - 1) // 10, 2) AS part FROM hosts WHERE ts < TIMESTAMP '2024-01-31'))""", "hosts"),
        "jn02_bucketed_funnel": answers["q09_policy_funnel"],
        "jn07_streamed_resets": answers["h03_resets_after_creation"],
        "jn07_streamed_grants": answers["h04_new_privileged_users"],
        "wn04_streamed_scores": compose(
            """SELECT asn, bucket_ts, reqs, round((reqs - m) / s, 2) AS zscore
            FROM (SELECT *, avg(reqs) OVER upto AS m, stddev_pop(reqs) OVER upto AS s
                  FROM (SELECT asn, time_bucket(INTERVAL '1 day', ts) AS bucket_ts, count(*) AS reqs FROM requests GROUP BY ALL)
                  WHERE bucket_ts + INTERVAL '1 day' <= (SELECT max(ts) FROM requests) - INTERVAL '10 minutes'
                  WINDOW upto AS (PARTITION BY asn ORDER BY bucket_ts))
            WHERE s > 0""", "requests"),
        "mf01_resumed_run": f"SELECT name, row_count, columns, false AS failed FROM ({answers['mf02_manifest_dns']})",
        "io08_texts_of_a_table": compose(
            """SELECT request_id::VARCHAR AS request_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, org_id::VARCHAR AS org_id, event_type,
                   is_automation_suspected::VARCHAR AS is_automation_suspected FROM requests""", "requests"),
        "h06_exposure_of_two_periods": compose(
            """SELECT account_id, last_suspicious_dns, first_failed_login,
                   round(epoch(first_failed_login - last_suspicious_dns) / 3600, 4) AS time_delta_hours
            FROM (SELECT account_id, max(ts) AS last_suspicious_dns FROM dns WHERE score >= 4 AND ts < TIMESTAMP '2024-01-16' GROUP BY account_id)
            JOIN (SELECT account_id, min(ts) AS first_failed_login FROM failed WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-31' GROUP BY account_id)
            USING (account_id)
            WHERE first_failed_login >= last_suspicious_dns AND first_failed_login <= last_suspicious_dns + INTERVAL '10 days'""",
            "dns", "failed"),
    }
    return found
