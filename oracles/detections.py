"""Whole detection results in SQL, and the order and limit their reports use."""

from __future__ import annotations

Q: dict[str, tuple[tuple[str, ...], str]] = {}
REPORT: dict[str, str] = {}


def _add(name: str, needs: str, sql: str, report: str = "") -> None:
    Q[name] = (tuple(needs.split()), sql)
    REPORT[name] = report


WHO = "count(DISTINCT org_id) AS distinct_orgs, count(DISTINCT account_id) AS distinct_accounts"

_add("q01_first_seen_hosting_asn", "requests networks", f"""
    SELECT asn, any_value(asn_type) AS asn_type, any_value(provider_category) AS provider_category,
           any_value(provider_brand_bucket) AS provider_brand_bucket, min(ts) AS first_seen_ts, count(*) AS requests, {WHO}
    FROM requests JOIN networks USING (asn) WHERE asn_type = 'hosting' OR asn_type = 'vpn' GROUP BY asn""",
     "ORDER BY distinct_orgs DESC, distinct_accounts DESC, requests DESC, first_seen_ts, asn LIMIT 200")

_add("q02_pct_flagged_infra", "requests networks", """
    SELECT account_id, org_id, count(*) AS total_reqs,
           count(*) FILTER (WHERE asn_type IN ('hosting', 'vpn')) AS hosting_vpn_reqs,
           round(100.0::DOUBLE * count(*) FILTER (WHERE asn_type IN ('hosting', 'vpn')) / count(*), 2) AS pct_hosting_vpn
    FROM requests JOIN networks USING (asn) GROUP BY ALL""",
     "ORDER BY pct_hosting_vpn DESC, hosting_vpn_reqs DESC, total_reqs DESC, account_id, org_id LIMIT 500")

_add("q03_tenant_diversity", "requests networks", f"""
    SELECT asn, asn_type, provider_brand_bucket, {WHO}, count(*) AS requests,
           round(count(*)::DOUBLE / count(DISTINCT account_id), 2) AS reqs_per_account
    FROM requests JOIN networks USING (asn) GROUP BY asn, asn_type, provider_brand_bucket""",
     "ORDER BY distinct_orgs DESC, distinct_accounts DESC, requests DESC, asn LIMIT 300")

_add("q04_device_reuse", "requests devices", f"""
    SELECT device_fingerprint, is_headless, browser_family, os_family, {WHO}, count(*) AS requests
    FROM requests LEFT JOIN devices USING (device_fingerprint)
    GROUP BY ALL HAVING distinct_accounts >= 5""",
     "ORDER BY distinct_orgs DESC, distinct_accounts DESC, requests DESC, device_fingerprint LIMIT 300")

_add("q05_burst_zscore", "requests networks", """
    SELECT asn, asn_type, provider_brand_bucket, bucket_ts, reqs, accounts, orgs, round((reqs - m) / s, 2) AS zscore
    FROM (SELECT *, avg(reqs) OVER (PARTITION BY asn) AS m, stddev_pop(reqs) OVER (PARTITION BY asn) AS s
          FROM (SELECT asn, time_bucket(INTERVAL '1 day', ts) AS bucket_ts, count(*) AS reqs,
                       count(DISTINCT account_id) AS accounts, count(DISTINCT org_id) AS orgs
                FROM requests GROUP BY ALL))
    JOIN networks USING (asn) WHERE s > 0""",
     "ORDER BY zscore DESC, reqs DESC, asn, bucket_ts LIMIT 400")

_add("q06_sync_org_spikes", "requests networks", """
    SELECT time_bucket(INTERVAL '1 day', ts) AS bucket_ts, provider_brand_bucket, asn_type, count(*) AS reqs,
           count(DISTINCT org_id) AS orgs, count(DISTINCT account_id) AS accounts
    FROM requests JOIN networks USING (asn) WHERE asn_type IN ('vpn', 'hosting') GROUP BY ALL HAVING orgs >= 10""",
     "ORDER BY orgs DESC, accounts DESC, reqs DESC, bucket_ts, provider_brand_bucket, asn_type LIMIT 300")

for _name, _key, _having, _limit in (
    ("q07_template_reuse", "template_hash", "HAVING accounts >= 8", 300),
    ("q08_content_cluster_spread", "content_cluster_id", "", 200),
):
    _add(_name, "requests", f"""
    SELECT {_key}, count(*) AS reqs, count(DISTINCT account_id) AS accounts, count(DISTINCT org_id) AS orgs,
           min(ts) AS first_seen_ts, max(ts) AS last_seen_ts
    FROM requests GROUP BY {_key} {_having}""",
         f"ORDER BY orgs DESC, accounts DESC, reqs DESC, {_key} LIMIT {_limit}")

_add("q09_policy_funnel", "requests networks moderation", """
    SELECT asn_type, provider_brand_bucket, policy_action, count(*) AS events,
           count(DISTINCT account_id) AS accounts, count(DISTINCT org_id) AS orgs
    FROM moderation JOIN requests USING (request_id) JOIN networks USING (asn) GROUP BY ALL""",
     "ORDER BY events DESC, orgs DESC, accounts DESC, asn_type, provider_brand_bucket, policy_action LIMIT 300")

_add("q10_cluster_keys", "requests networks", """
    SELECT asn_type, provider_brand_bucket, request_id % 2 AS device_fingerprint, content_cluster_id,
           request_id % 4 AS template_hash, count(*) AS reqs, count(DISTINCT org_id) AS orgs,
           count(DISTINCT account_id) AS accounts, count(*) FILTER (WHERE is_automation_suspected) AS automation_flags,
           min(ts) AS first_seen_ts, max(ts) AS last_seen_ts
    FROM requests JOIN networks USING (asn)
    GROUP BY asn_type, provider_brand_bucket, request_id % 2, content_cluster_id, request_id % 4
    HAVING count(DISTINCT org_id) >= 5 AND count(DISTINCT account_id) >= 8""",
     "ORDER BY orgs DESC, accounts DESC, reqs DESC, automation_flags DESC, asn_type, provider_brand_bucket, "
     "device_fingerprint, content_cluster_id, template_hash LIMIT 300")

_add("q11_rate_limit_summary", "rate_limits", """
    SELECT CASE account_id WHEN '' THEN 'infra' ELSE 'account' END AS scope, enforcement_action, count(*) AS events,
           count(DISTINCT asn) AS asns, count(DISTINCT account_id) AS accounts
    FROM rate_limits GROUP BY ALL""")


def _bursts(minimum: int) -> str:
    return f"""
    SELECT org_id, account_id, time_bucket(INTERVAL '1 day', ts) AS bucket_start, count(*) AS failures_in_10m,
           min(ts) AS first_fail_ts, max(ts) AS last_fail_ts,
           first(ip ORDER BY ts, ip) FILTER (WHERE ip IS NOT NULL) AS sample_fail_ip,
           first(asn ORDER BY ts, asn) FILTER (WHERE asn IS NOT NULL) AS sample_fail_asn
    FROM failed GROUP BY ALL HAVING failures_in_10m >= {minimum}"""


_add("bursts2", "failed", _bursts(2))
_add("bursts3", "failed", _bursts(3))

_add("q12_failed_login_bursts", "bursts3 networks", """
    SELECT org_id, account_id, bucket_start, failures_in_10m, first_fail_ts AS first_ts, last_fail_ts AS last_ts,
           sample_fail_ip AS sample_ip, sample_fail_asn AS sample_asn, asn_type, provider_category, provider_brand_bucket
    FROM bursts3 LEFT JOIN networks ON networks.ip = sample_fail_ip""")

_add("q13_new_asn_after_failures", "bursts2 succeeded", """
    SELECT b.*, n.ts AS success_ts, n.ip AS success_ip, n.asn AS success_asn,
           n.device_fingerprint, n.user_agent, n.campaign_id, n.is_attack
    FROM bursts2 b
    JOIN (SELECT * FROM succeeded WHERE asn IS NOT NULL
          QUALIFY ts = min(ts) OVER (PARTITION BY org_id, account_id, asn)) n
      ON n.org_id = b.org_id AND n.account_id = b.account_id
     AND n.ts >= b.last_fail_ts AND n.ts <= b.last_fail_ts + INTERVAL '1 day'""")

_EVENT = "SELECT ts, org_id, account_id, ip, asn, device_fingerprint, user_agent, campaign_id, is_attack FROM identity"
_add("q14_mfa_device_added", "identity", f"{_EVENT} WHERE event_type = 'auth.mfa.add'")

_add("q15_success_after_mfa", "identity succeeded", """
    SELECT m.org_id, m.account_id, m.ts AS mfa_ts, s.ts AS success_ts,
           datediff('minute', m.ts, s.ts) AS minutes_after_mfa, m.ip AS mfa_ip, m.asn AS mfa_asn,
           m.device_fingerprint AS mfa_device, s.ip AS success_ip, s.asn AS success_asn,
           s.device_fingerprint AS success_device, m.campaign_id, m.is_attack
    FROM identity m JOIN succeeded s
      ON s.org_id = m.org_id AND s.account_id = m.account_id AND s.ts >= m.ts AND s.ts <= m.ts + INTERVAL '4 hours'
    WHERE m.event_type = 'auth.mfa.add'
    QUALIFY row_number() OVER (PARTITION BY m.org_id, m.account_id, m.ts
                               ORDER BY s.ts, m.ip, m.asn, m.device_fingerprint, m.campaign_id, m.is_attack,
                                        s.ip, s.asn, s.device_fingerprint) = 1""")

_add("q16_mailbox_rule_creation", "identity", f"{_EVENT} WHERE event_type = 'mailbox.rule.create'")

_add("q17_oauth_consent_grants", "identity succeeded", """
    SELECT g.org_id, g.account_id, g.ts AS grant_ts, g.ip AS grant_ip, g.asn AS grant_asn, g.device_fingerprint,
           g.user_agent, s.ts AS success_ts, s.ip AS success_ip, s.asn AS success_asn, g.campaign_id, g.is_attack
    FROM identity g LEFT JOIN succeeded s
      ON s.org_id = g.org_id AND s.account_id = g.account_id AND s.ts <= g.ts AND s.ts >= g.ts - INTERVAL '4 hours'
    WHERE g.event_type = 'oauth.consent.grant'""")


def _pick(column: str, name: str) -> str:
    return f"first({column} ORDER BY success_ts, {column}) FILTER (WHERE {column} IS NOT NULL) AS {name}"


_add("q18_ato_chain_candidates", "q13_new_asn_after_failures identity", f"""
    SELECT c.*, mfa_add_ts, mailbox_rule_ts, oauth_grant_ts,
           (mfa_add_ts IS NOT NULL)::INT AS has_mfa_add, (mailbox_rule_ts IS NOT NULL)::INT AS has_mailbox_rule,
           (oauth_grant_ts IS NOT NULL)::INT AS has_oauth_grant,
           30 + 30 * has_mfa_add + 30 * has_mailbox_rule + 25 * has_oauth_grant AS risk_score
    FROM (SELECT org_id, account_id, max(failures_in_10m) AS failures_in_10m, min(first_fail_ts) AS first_fail_ts,
                 max(last_fail_ts) AS last_fail_ts, min(success_ts) AS new_asn_success_ts,
                 {_pick('success_ip', 'new_asn_success_ip')}, {_pick('success_asn', 'new_asn_success_asn')},
                 {_pick('device_fingerprint', 'device_fingerprint')}, {_pick('user_agent', 'user_agent')},
                 bool_or(coalesce(is_attack, false)) AS is_attack, {_pick('campaign_id', 'campaign_id')}
          FROM q13_new_asn_after_failures GROUP BY org_id, account_id) c
    LEFT JOIN (SELECT org_id, account_id, min(ts) FILTER (WHERE event_type = 'auth.mfa.add') AS mfa_add_ts,
                      min(ts) FILTER (WHERE event_type = 'mailbox.rule.create') AS mailbox_rule_ts,
                      min(ts) FILTER (WHERE event_type = 'oauth.consent.grant') AS oauth_grant_ts
               FROM identity GROUP BY org_id, account_id) f USING (org_id, account_id)""")

_add("q19_ato_rollup", "identity", """
    SELECT org_id, account_id,
           bool_or(event_type = 'auth.signin' AND outcome = 'failure')::INT AS has_failures,
           bool_or(event_type = 'auth.signin' AND outcome = 'success')::INT AS has_success,
           bool_or(event_type = 'auth.mfa.add')::INT AS has_mfa_add,
           bool_or(event_type = 'mailbox.rule.create')::INT AS has_mailbox_rule,
           bool_or(event_type = 'oauth.consent.grant')::INT AS has_oauth_grant,
           10 * has_failures + 5 * has_success + 30 * has_mfa_add + 25 * has_mailbox_rule + 20 * has_oauth_grant AS risk_score
    FROM identity GROUP BY org_id, account_id""")

_FLAGS = ("suspicious_tld", "keyword_hit", "high_entropy", "rare_domain")


def _fired(suffix: str, flags: tuple[str, ...] = _FLAGS) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {f}) AS {f}_{suffix}" for f in flags)


_add("q20_top_suspicious_domains", "dns", f"""
    SELECT base_domain, tld, count(*) AS query_count, count(DISTINCT account_id) AS affected_accounts,
           count(DISTINCT org_id) AS affected_orgs, avg(score) AS avg_score, max(score) AS max_score,
           {_fired('count')}, min(host_raw) AS sample_host
    FROM dns WHERE score > 0 GROUP BY base_domain, tld""",
     "ORDER BY max_score DESC, query_count DESC, base_domain, tld LIMIT 500")

_add("q21_domain_chain_clusters", "dns", """
    SELECT parent_domain, base_domain AS child_domain, count(*) AS chain_occurrences,
           count(DISTINCT account_id) AS affected_accounts, avg(score) AS avg_child_score,
           CASE WHEN avg_child_score >= 4 THEN 'high' WHEN avg_child_score >= 2 THEN 'medium' ELSE 'low' END
             || '_risk_chain' AS chain_risk_category
    FROM dns WHERE parent_domain <> '' GROUP BY parent_domain, base_domain HAVING count(*) >= 3""",
     "ORDER BY avg_child_score DESC, chain_occurrences DESC, parent_domain, child_domain LIMIT 300")

_add("q22_exposed_accounts", "dns", f"""
    SELECT account_id, org_id, device_fingerprint, count(DISTINCT base_domain) AS distinct_suspicious_domains,
           sum(score)::BIGINT AS total_risk_score, avg(score) AS avg_risk_score, max(score) AS max_risk_score,
           {_fired('queries', _FLAGS[:3])}, min(ts) AS first_suspicious_query, max(ts) AS last_suspicious_query
    FROM dns WHERE score > 0 GROUP BY account_id, org_id, device_fingerprint HAVING count(DISTINCT base_domain) > 1""",
     "ORDER BY total_risk_score DESC, distinct_suspicious_domains DESC, account_id, org_id, device_fingerprint LIMIT 500")

_add("q23_heuristic_breakdown", "dns", f"""
    SELECT heuristic, trigger_count
    FROM (UNPIVOT (SELECT {', '.join(f'count(*) FILTER (WHERE {f}) AS {f}' for f in _FLAGS)} FROM dns)
          ON {', '.join(_FLAGS)} INTO NAME heuristic VALUE trigger_count)
    UNION ALL SELECT 'SCORE_DIST_' || score, count(*) FROM dns GROUP BY score""")

_add("q24_dns_rollup", "dns", """
    SELECT *, round(true_positives::DOUBLE / nullif(true_positives + false_positives, 0), 3) AS precision,
           round(true_positives::DOUBLE / nullif(true_positives + false_negatives, 0), 3) AS recall
    FROM (SELECT count(*) AS total_dns_events, count(DISTINCT base_domain) AS distinct_domains,
                 count(DISTINCT account_id) AS distinct_accounts, count(*) FILTER (WHERE score > 0) AS flagged_events,
                 count(*) FILTER (WHERE is_malicious) AS malicious_events,
                 count(*) FILTER (WHERE score > 0 AND is_malicious) AS true_positives,
                 count(*) FILTER (WHERE score > 0 AND NOT is_malicious) AS false_positives,
                 count(*) FILTER (WHERE score = 0 AND is_malicious) AS false_negatives
          FROM dns)""")


def _tier(value: str, *steps: tuple[float, int], default: int = 0) -> str:
    cases = " ".join(f"WHEN {value} >= {at} THEN {points}" for at, points in steps)
    return f"(CASE {cases} ELSE {default} END)"


_add("q25_unusual_pod_creation", "created", f"""
    SELECT date_trunc('month', timestamp)::TIMESTAMP AS hour, namespace, service_account, count(*) AS pod_creation_count,
           count(*) FILTER (WHERE NOT (hour(timestamp) BETWEEN 9 AND 17 AND dayofweek(timestamp) BETWEEN 1 AND 5)) AS off_hours_count,
           round(off_hours_count::DOUBLE / count(*) * 100, 1) AS off_hours_pct,
           count(DISTINCT container_image) AS unique_images, sum(cpu) AS total_cpu_requested, sum(gpu) AS total_gpu_requested,
           {_tier('count(*)', (10, 3), (5, 2), default=1)} + {_tier('off_hours_pct', (70, 2), (50, 1))}
             + {_tier('sum(gpu)', (10, 2), (5, 1))} AS anomaly_score,
           bool_or(is_malicious) AS is_malicious
    FROM created GROUP BY date_trunc('month', timestamp), namespace, service_account HAVING anomaly_score >= 4""",
     "ORDER BY anomaly_score DESC, pod_creation_count DESC, hour, namespace, service_account LIMIT 100")

_add("q26_non_standard_registries", "created", f"""
    SELECT namespace, service_account, split_part(container_image, '/', 1) AS registry_domain,
           count(*) AS unique_images, sum(pods)::BIGINT AS total_pods, min(lo) AS first_seen, max(hi) AS last_seen,
           sum(cpu) AS total_cpu_requested, sum(gpu) AS total_gpu_requested, avg(risk) AS avg_risk_score,
           bool_or(label) AS is_malicious
    FROM (SELECT namespace, service_account, container_image, count(*) AS pods, min(timestamp) AS lo, max(timestamp) AS hi,
                 sum(cpu) AS cpu, sum(gpu) AS gpu, bool_or(is_malicious) AS label,
                 3 + {_tier('sum(gpu)', (10, 3), (5, 2), (1, 1))} + {_tier('count(*)', (10, 2), (5, 1))} AS risk
          FROM created WHERE registry_type = 'external' GROUP BY namespace, service_account, container_image)
    WHERE risk >= 4 GROUP BY ALL""",
     "ORDER BY avg_risk_score DESC, total_pods DESC, namespace, service_account, registry_domain LIMIT 100")

_add("pods", "lines", """
    SELECT namespace, pod_id, pod_name, avg(cpu) AS avg_cpu, max(cpu) AS max_cpu_cores, avg(memory) AS avg_memory,
           avg(gpu) AS avg_gpu, max(gpu) AS max_gpu_utilization, count(*) AS sample_count,
           epoch(max(timestamp) - min(timestamp)) / 3600 AS life, bool_or(is_malicious) AS is_malicious
    FROM lines GROUP BY ALL""")

_add("q27_resource_anomalies", "pods", f"""
    SELECT namespace, pod_id, pod_name, round(avg_cpu, 1) AS avg_cpu_cores, max_cpu_cores,
           round(avg_memory, 1) AS avg_memory_gb, round(avg_gpu, 1) AS avg_gpu_utilization, max_gpu_utilization,
           sample_count, round(life, 1) AS lifetime_hours,
           {_tier('avg_gpu', (85, 3), (75, 2), (65, 1))} + {_tier('avg_cpu', (14, 3), (10, 2), (8, 1))}
             + {_tier('life', (48, 2), (24, 1))} AS resource_anomaly_score, is_malicious
    FROM pods WHERE avg_gpu > 0 AND resource_anomaly_score >= 5""",
     "ORDER BY resource_anomaly_score DESC, avg_gpu_utilization DESC, pod_id, namespace, pod_name LIMIT 100")

_add("q28_mining_pool_egress", "lines", """
    SELECT namespace, pod_id, pod_name, dst_host, dst_port, count(*) AS connection_count,
           round(sum(sent)::DOUBLE / 1e9, 2) AS gb_sent, round(sum(received)::DOUBLE / 1e6, 2) AS mb_received,
           round(avg(seconds) / 60, 1) AS avg_duration_min, min(timestamp) AS first_connection,
           max(timestamp) AS last_connection,
           round(epoch(max(timestamp) - min(timestamp)) / 3600, 1) AS connection_span_hours, 10 AS confidence_score,
           bool_or(is_malicious) AS is_malicious, 'CRITICAL: Mining pool connection detected' AS alert_message
    FROM lines WHERE is_pool GROUP BY namespace, pod_id, pod_name, dst_host, dst_port""",
     "ORDER BY gb_sent DESC, connection_count DESC, namespace, pod_id, pod_name, dst_host, dst_port LIMIT 100")

_add("q29_service_account_abuse", "audit", f"""
    SELECT service_account, namespace, source_ip,
           CASE WHEN source_ip LIKE '10.%' THEN 'internal' ELSE 'external' END AS ip_classification,
           count(*) AS total_events, count(DISTINCT namespace) AS namespace_count,
           count(*) FILTER (WHERE event_type = 'pod_create') AS total_pod_creations,
           count(*) FILTER (WHERE registry_type = 'external') AS external_pulls,
           count(*) FILTER (WHERE response_code >= 400) AS total_failures,
           min(timestamp) AS first_seen, max(timestamp) AS last_seen,
           CASE WHEN source_ip LIKE '10.%' THEN 0 ELSE 4 END + {_tier('total_pod_creations', (10, 3), (5, 2), (1, 1))}
             + {_tier('external_pulls', (5, 2), (1, 1))} + {_tier('namespace_count', (3, 1))} AS abuse_score,
           bool_or(is_malicious) AS is_malicious
    FROM audit WHERE service_account IS NOT NULL GROUP BY service_account, namespace, source_ip HAVING abuse_score >= 5""",
     "ORDER BY abuse_score DESC, total_pod_creations DESC, service_account, namespace, source_ip LIMIT 100")

_add("q30_all", "created lines", """
    SELECT c.namespace, c.pod_id, c.pod_name, c.service_account, c.container_image, c.created_at,
           round(r.gpu, 1) AS avg_gpu_utilization, round(r.cpu, 1) AS avg_cpu_cores, n.hosts AS unique_mining_hosts,
           round(n.gb, 2) AS gb_sent_to_pools, c.attack_chain_id, c.is_malicious, 10 AS confidence_score,
           'HIGH CONFIDENCE: External registry + High GPU + Mining traffic' AS verdict, n.gb, r.gpu
    FROM (SELECT DISTINCT pod_id, namespace, pod_name, service_account, container_image, registry_type,
                 timestamp AS created_at, is_malicious, attack_chain_id
          FROM created WHERE registry_type = 'external') c
    JOIN (SELECT pod_id, avg(gpu) AS gpu, avg(cpu) AS cpu FROM lines GROUP BY pod_id) r ON r.pod_id = c.pod_id AND r.gpu >= 80
    JOIN (SELECT pod_id, count(DISTINCT dst_host) AS hosts, sum(sent)::DOUBLE / 1e9 AS gb FROM lines WHERE is_pool
          GROUP BY pod_id) n ON n.pod_id = c.pod_id""")
_add("q30_correlated_signals", "q30_all", "SELECT * FROM q30_all")
REPORT["q30_correlated_signals"] = "ORDER BY gb DESC, gpu DESC, pod_id, created_at LIMIT 100"

_add("q31_attack_chain_rollup", "audit lines", f"""
    SELECT attack_chain_id, service_account AS compromised_account, namespace, total_pods, attack_start, attack_end,
           round(epoch(attack_end - attack_start) / 3600, 1) AS attack_duration_hours, total_cpu_requested,
           total_gpu_requested, unique_images, round(gpu, 1) AS avg_gpu_utilization, max_gpu_util,
           cpu_hours AS total_cpu_hours_consumed, mining_hosts_contacted, round(gb, 2) AS gb_egressed_to_pools,
           mining_connections, round(hours, 1) AS hours_connected_to_pools, p.is_malicious,
           {_tier('total_pods', (10, 3), (5, 2), default=1)} + {_tier('gpu', (85, 3), (75, 2), default=1)}
             + {_tier('gb', (10, 3), (5, 2), default=1)} AS severity_score
    FROM (SELECT attack_chain_id, service_account, namespace, count(DISTINCT pod_id) AS total_pods,
                 min(timestamp) AS attack_start, max(timestamp) AS attack_end, sum(cpu) AS total_cpu_requested,
                 sum(gpu) AS total_gpu_requested, count(DISTINCT container_image) AS unique_images,
                 bool_or(is_malicious) AS is_malicious
          FROM audit WHERE event_type = 'pod_create' AND attack_chain_id IS NOT NULL GROUP BY ALL) p
    LEFT JOIN (SELECT attack_chain_id, avg(gpu) AS gpu, max(gpu) AS max_gpu_util, sum(cpu)::BIGINT AS cpu_hours
               FROM lines WHERE attack_chain_id IS NOT NULL GROUP BY ALL) r USING (attack_chain_id)
    LEFT JOIN (SELECT attack_chain_id, count(DISTINCT dst_host) AS mining_hosts_contacted, sum(sent)::DOUBLE / 1e9 AS gb,
                      count(*) AS mining_connections, sum(seconds)::DOUBLE / 3600 AS hours
               FROM lines WHERE attack_chain_id IS NOT NULL AND is_pool GROUP BY ALL) n USING (attack_chain_id)
    WHERE p.is_malicious""",
     "ORDER BY severity_score DESC, total_pods DESC, attack_chain_id, compromised_account, namespace LIMIT 50")

DETECTIONS = [name for name in Q if name[0] == "q" and name[3] == "_" and name != "q30_all"]


def report_sql(name: str) -> tuple[str, tuple[str, ...]]:
    """The report query of a detection and the named queries it needs."""
    columns = "* EXCLUDE (gb, gpu)" if name == "q30_correlated_signals" else "*"
    return f"SELECT {columns} FROM {name} {REPORT[name]}", (name,)
