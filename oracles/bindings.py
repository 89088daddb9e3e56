"""The telemetry roles as SQL over the benchmark tables, one named query each.

Names a query uses are listed with it; :func:`compose` prepends what is needed.
"""

from __future__ import annotations

# name -> (names it builds on, SQL)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "requests": ((), """
        SELECT event_id AS request_id, ts, c_nationkey::BIGINT AS org_id, user_id AS account_id,
               regexp_extract(props, '([0-9]+)', 1)::BIGINT AS asn,
               event_id % 40 AS device_fingerprint, event_id % 200 AS template_hash,
               event_type AS content_cluster_id, value > 100 AS is_automation_suspected, event_type, value
        FROM events JOIN customer ON c_custkey = user_id"""),
    "networks": ((), """
        SELECT asn, asn::VARCHAR AS ip,
               CASE asn % 4 WHEN 0 THEN 'hosting' WHEN 1 THEN 'vpn' WHEN 2 THEN 'residential' ELSE 'corporate' END AS asn_type,
               CASE asn % 3 WHEN 0 THEN 'cloud' WHEN 1 THEN 'edge' ELSE 'isp' END AS provider_category,
               'p' || (asn % 16) AS provider_brand_bucket
        FROM (SELECT DISTINCT regexp_extract(props, '([0-9]+)', 1)::BIGINT AS asn FROM events)"""),
    "devices": ((), """
        SELECT device_fingerprint, device_fingerprint % 3 = 0 AS is_headless,
               CASE device_fingerprint % 3 WHEN 0 THEN 'chrome' WHEN 1 THEN 'firefox' ELSE 'safari' END AS browser_family,
               CASE device_fingerprint % 5 WHEN 0 THEN 'linux' WHEN 1 THEN 'mac' WHEN 2 THEN 'windows'
                                           WHEN 3 THEN 'android' ELSE 'ios' END AS os_family
        FROM (SELECT DISTINCT event_id % 40 AS device_fingerprint FROM events) WHERE device_fingerprint % 2 = 0"""),
    "moderation": (("requests",), """
        SELECT request_id, CASE WHEN value > 200 THEN 'block' WHEN value > 100 THEN 'warn' ELSE 'allow' END AS policy_action
        FROM requests"""),
    "rate_limits": (("requests",), """
        SELECT ts, asn, CASE WHEN asn < 35 THEN '' ELSE account_id::VARCHAR END AS account_id,
               CASE WHEN event_type = 'error' THEN 'temporary_block' ELSE 'throttle' END AS enforcement_action
        FROM requests WHERE value > 150"""),
    "identity": (("requests",), """
        SELECT ts, org_id, account_id, asn::VARCHAR AS ip, asn, device_fingerprint,
               'agent/' || (request_id % 5) AS user_agent,
               CASE WHEN event_type IN ('error', 'click', 'view') THEN 'auth.signin'
                    WHEN event_type = 'signup' THEN 'auth.mfa.add'
                    WHEN asn % 2 = 0 THEN 'mailbox.rule.create' ELSE 'oauth.consent.grant' END AS event_type,
               CASE WHEN event_type = 'error' THEN 'failure' WHEN event_type IN ('click', 'view') THEN 'success' ELSE '' END AS outcome,
               CASE WHEN value > 100 THEN 'c' || (request_id % 7) ELSE '' END AS campaign_id,
               value > 100 AS is_attack
        FROM requests"""),
    "failed": (("identity",), "SELECT * FROM identity WHERE event_type = 'auth.signin' AND outcome = 'failure'"),
    "succeeded": (("identity",), "SELECT * FROM identity WHERE event_type = 'auth.signin' AND outcome = 'success'"),
    "sessions": (("requests",), """
        SELECT request_id AS session_id, account_id, org_id, ts AS start_ts,
               CASE WHEN account_id % 11 <> 0 THEN asn::VARCHAR END AS ip, asn, device_fingerprint
        FROM requests WHERE event_type IN ('click', 'view')"""),
    "hosts": (("requests",), """
        SELECT r.ts, r.request_id, r.org_id, r.account_id, r.device_fingerprint,
               split_part(p.url, '/', 3) AS host_raw, split_part(p.url, '/', 3) AS base_domain,
               split_part(split_part(p.url, '/', 3), '.', -1) AS tld, r.event_type = 'error' AS is_malicious
        FROM requests r JOIN pages p ON p.page_id = r.request_id % (SELECT count(*) FROM pages)"""),
    "domains": (("hosts",), """
        SELECT base_domain, count(*) AS domain_count,
               split_part(base_domain, '.', -1) IN ('net') AS suspicious_tld,
               (base_domain LIKE '%blog%' OR base_domain LIKE '%pill%' OR base_domain LIKE '%cheap%') AS keyword_hit,
               list_aggregate(regexp_extract_all(replace(base_domain, '.', ''), '.'), 'entropy') AS entropy,
               entropy > 3.4 AS high_entropy,
               count(*) <= 60 AS rare_domain,
               (2 * suspicious_tld::INT + 3 * keyword_hit::INT + high_entropy::INT + rare_domain::INT)::BIGINT AS score
        FROM hosts GROUP BY base_domain"""),
    "dns": (("hosts", "domains"), """
        SELECT h.*, coalesce(lag(h.base_domain) OVER (PARTITION BY h.account_id ORDER BY h.ts, h.request_id), '') AS parent_domain,
               d.suspicious_tld, d.keyword_hit, d.high_entropy, d.rare_domain, d.score
        FROM hosts h JOIN domains d USING (base_domain)"""),
    "audit": ((), """
        SELECT o_orderdate + to_hours((o_orderkey % 24)::INT) AS timestamp,
               CASE WHEN o_orderstatus = 'P' THEN 'pod_delete' ELSE 'pod_create' END AS event_type,
               o_orderpriority AS namespace, 'pod-' || o_orderkey AS pod_name, o_orderkey AS pod_id,
               CASE WHEN o_custkey % 3 = 2 THEN '185' ELSE '10' END || '.0.0.' || (o_custkey % 5) AS source_ip,
               'sa-' || (o_custkey % 20) AS service_account,
               CASE WHEN o_orderstatus <> 'F' THEN 'registry.internal' WHEN o_orderkey % 3 = 0 THEN 'docker.io'
                    WHEN o_orderkey % 3 = 1 THEN 'ghcr.io' ELSE 'quay.io' END || '/img' || (o_orderkey % 4) AS container_image,
               CASE WHEN o_orderstatus = 'F' THEN 'external' ELSE 'internal' END AS registry_type,
               (o_orderkey % 8 + 1)::DOUBLE AS cpu,
               CASE WHEN o_orderstatus = 'F' THEN (o_orderkey % 4)::DOUBLE END AS gpu,
               CASE WHEN o_orderkey % 17 = 0 THEN 403 ELSE 201 END AS response_code,
               o_totalprice > 200000 AS is_malicious,
               CASE WHEN o_totalprice > 200000 THEN 'chain-' || (o_orderkey % 50) END AS attack_chain_id
        FROM orders"""),
    "created": (("audit",), "SELECT * FROM audit WHERE event_type = 'pod_create' AND response_code >= 200 AND response_code < 300"),
    "lines": ((), """
        SELECT l_shipdate + to_hours(l_linenumber * 5) AS timestamp, 'ns-' || (l_orderkey % 5) AS namespace,
               l_orderkey AS pod_id, 'pod-' || l_orderkey AS pod_name, l_returnflag = 'R' AS is_malicious,
               CASE WHEN l_returnflag = 'R' THEN 'chain-' || (l_orderkey % 50) END AS attack_chain_id,
               l_quantity::BIGINT AS cpu, round(l_tax * 100)::BIGINT AS memory, round(l_discount * 1000)::BIGINT AS gpu,
               'host-' || l_suppkey AS dst_host, l_suppkey % 4 + 3333 AS dst_port,
               round(l_extendedprice * 100000)::BIGINT AS sent, round(l_extendedprice * 100)::BIGINT AS received,
               (l_quantity * 60)::BIGINT AS seconds, l_returnflag = 'R' AS is_pool
        FROM lineitem"""),
    "agents": ((), """
        SELECT event_id AS session_id, user_id AS user_email, ts AS started_at,
               CASE event_id % 3 WHEN 0 THEN 'virtual_agent' WHEN 1 THEN 'now_assist' ELSE 'portal' END AS source
        FROM events WHERE event_type = 'click'"""),
    "changes": ((), """
        SELECT ts AS event_time,
               CASE event_type WHEN 'signup' THEN 'user_create' WHEN 'purchase' THEN 'role_grant' ELSE 'password_reset' END AS kind,
               'actor' || (event_id % 10) AS actor, user_id AS target, props AS details
        FROM events WHERE event_type IN ('signup', 'purchase', 'error')"""),
}


def compose(sql: str, *names: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """``sql`` with a WITH clause for ``names`` and everything they build on."""
    parts = {**PARTS, **(extra or {})}
    ordered: dict[str, str] = {}

    def need(name: str) -> None:
        if name not in ordered:
            builds_on, body = parts[name]
            for other in builds_on:
                need(other)
            ordered[name] = body

    for name in names:
        need(name)
    clause = ",\n".join(f"{name} AS ({body})" for name, body in ordered.items())
    return f"WITH {clause}\n{sql}"
