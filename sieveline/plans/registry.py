"""Every operator and detection bound to the benchmark tables, by inventory id."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.bindings import HEURISTICS, PARAMS, LiveTelemetry, Telemetry
from sieveline.functions import clock, hosts
from sieveline.functions.scores import band, lenient_double
from sieveline.operators.confusion import evaluate
from sieveline.operators.firsts import distinct_entities
from sieveline.operators.intervals import interval_join
from sieveline.operators.neighbours import previous_value
from sieveline.operators.sketches import read_days, standard_error
from sieveline.plans import coordinated, features, hunts, incremental, packs, quality, signals
from sieveline.plans.packs import DETECTIONS, PACKS
from sieveline.plans.takeover import takeover_chains
from sieveline.sources import artifacts, cleaning, tables
from sieveline.streaming import joins, moments

Query = Callable[[SparkSession, str], DataFrame]
Plan = Callable[[Telemetry], DataFrame]

# Privileged-role term that benchmark event details can contain.
TERM = '"k": 7'

SIGNAL_IDS = {
    "sg01_cross_tenant_diversity": "q03_tenant_diversity",
    "sg02_hosting_vpn_concentration": "q02_pct_flagged_infra",
    "sg03_synchronized_spikes": "q06_sync_org_spikes",
    "sg04_template_reuse": "q07_template_reuse",
    "sg05_content_cluster_spread": "q08_content_cluster_spread",
    "sg06_policy_funnel": "q09_policy_funnel",
    "sg07_rate_limit_pressure": "q11_rate_limit_summary",
    "sg08_failed_login_bursts": "q12_failed_login_bursts",
    "sg09_new_asn_after_failures": "q13_new_asn_after_failures",
    "sg10_mfa_manipulation": "q14_mfa_device_added",
    "sg11_mailbox_rule_abuse": "q16_mailbox_rule_creation",
    "sg12_oauth_consent_abuse": "q17_oauth_consent_grants",
    "sg13_ato_chain_detection": "q18_ato_chain_candidates",
    "sg14_dns_triage_detection": "q24_dns_rollup",
    "sg15_unusual_pod_creation": "q25_unusual_pod_creation",
    "sg16_non_standard_registries": "q26_non_standard_registries",
    "sg17_resource_anomalies": "q27_resource_anomalies",
    "sg18_mining_pool_egress": "q28_mining_pool_egress",
    "sg19_service_account_abuse": "q29_service_account_abuse",
    "sg20_correlated_k8s_signals": "q30_correlated_signals",
}
BRIEF = ["id", "title", "weight", "score"]

# Span and start of the scores whose usual ones the benchmark tables exceed, so that a score tells more than its sign.
SATURATION = {
    "q07_template_reuse": (40, 0),
    "q08_content_cluster_spread": (30, 0),
    "q12_failed_login_bursts": (8, 2),
    "q13_new_asn_after_failures": (400, 0),
    "q14_mfa_device_added": (200, 0),
    "q16_mailbox_rule_creation": (160, 0),
    "q17_oauth_consent_grants": (600, 0),
    "q18_ato_chain_candidates": (250, 0),
    "q25_unusual_pod_creation": (500, 0),
    "q26_non_standard_registries": (350, 0),
    "q27_resource_anomalies": (30_000, 0),
    "q28_mining_pool_egress": (20_000, 0),
    "q29_service_account_abuse": (240, 0),
    "q30_correlated_signals": (1_000, 0),
}
# Rows at which an additive signal has its whole weight; each gives another risk level.
ADDITIVE_FULL = (1_000, 30_000, 60_000, 100_000)


def whole(name: str, telemetry: Telemetry) -> DataFrame:
    """Whole, unordered result of a detection on the benchmark tables."""
    return DETECTIONS[name].result(telemetry.lazy_sources(name), **PARAMS.get(name, {}))


def _report(name: str) -> Plan:
    return lambda t: DETECTIONS[name].report(whole(name, t))


def _signal(detection: str) -> Plan:
    return lambda t: signals.catalog()[detection].of(whole(detection, t)).select(*BRIEF)


def _pack_signals(t: Telemetry, pack: str) -> DataFrame:
    return signals.score_results({d.name: whole(d.name, t) for d in PACKS[pack]})


def _overall(pack: str) -> Plan:
    return lambda t: signals.overall_risk(_pack_signals(t, pack))


def _scaled_signals(t: Telemetry, pack: str) -> DataFrame:
    return signals.score_results({d.name: whole(d.name, t) for d in PACKS[pack]}, SATURATION)


def _scaled(pack: str) -> Plan:
    return lambda t: signals.ranked_signals(_scaled_signals(t, pack)).select(*BRIEF, "severity")


def _scaled_overall(pack: str) -> Plan:
    return lambda t: signals.overall_risk(_scaled_signals(t, pack))


def _additive_levels(t: Telemetry) -> DataFrame:
    counts = signals.additive_counts({name: whole(name, t) for name in signals.ADDITIVE_WEIGHTS})
    scaled = counts.withColumn("full_rows", F.explode(F.array(*[F.lit(n).cast("long") for n in ADDITIVE_FULL])))
    return signals.additive_risk(signals.additive_shares(scaled, F.col("full_rows")), "full_rows")


def _additive(t: Telemetry) -> DataFrame:
    return signals.additive_signals({name: whole(name, t) for name in signals.ADDITIVE_WEIGHTS})


def _manifest(pack: str) -> Plan:
    def plan(t: Telemetry) -> DataFrame:
        listing = packs.manifest({d.name: whole(d.name, t) for d in PACKS[pack]})
        return listing.withColumn("columns", F.array_join("columns", ","))

    return plan


def _changes_after_sessions(t: Telemetry) -> DataFrame:
    found = hunts.identity_changes_after_sessions(
        t.agent_sessions, t.audit_events, "1 day", ("virtual_agent", "now_assist")
    )
    return found.withColumns({c: F.array_join(c, ",") for c in ("events", "targets", "actors")}).drop("n_events", "n_targets", "n_actors")


def _exposure(t: Telemetry) -> DataFrame:
    found = hunts.exposure_then_failed_login(t.dns_flagged, t.identity, min_score=7, within="60 days")
    return found.withColumn("time_delta_hours", F.round("time_delta_hours", 4))


def _domain_table(t: Telemetry) -> DataFrame:
    table = features.domain_features(t.hosts, HEURISTICS)
    return table.withColumn("entropy", F.round("entropy", 6))


def _page_hosts(t: Telemetry) -> DataFrame:
    pages = t.table("pages").select("page_id", hosts.url_host(F.col("url")).alias("host_raw"))
    # Upper case and stray dots stand for the untidy hosts of raw logs.
    untidy = F.concat(F.lit("."), F.upper("host_raw"), F.lit(". "))
    return features.with_domain_parts(pages.withColumn("host_raw", untidy))


def _document_entropy(t: Telemetry) -> DataFrame:
    return t.table("pages").select("page_id", F.round(hosts.shannon_entropy(F.col("url")), 6).alias("entropy"))


def _unified_identity(t: Telemetry) -> DataFrame:
    others = t.identity.where(F.col("event_type") != "auth.signin")
    return features.unified_identity_events(t.sessions, others, user_agent="agent/0")


def _business_hours(t: Telemetry) -> DataFrame:
    inside = clock.business_hours(F.col("timestamp"))
    return t.audit.groupBy("namespace", inside.alias("business_hours")).agg(F.count(F.lit(1)).alias("events"))


def _clock(t: Telemetry) -> DataFrame:
    ts, later = F.col("ts"), clock.shift(F.col("ts"), "95 seconds")
    return t.table("events").select(
        "event_id",
        clock.bucket_start("ts", "10 minutes").alias("bucket"),
        clock.calendar_start(t.table("events"), "ts", "hour").alias("hour_start"),
        F.hour(ts).alias("hour_of_day"),
        clock.weekday_sunday0(ts).alias("weekday"),
        F.round(clock.span_seconds(F.lit("2024-01-01").cast("timestamp_ntz"), ts), 6).alias("seconds_since"),
        clock.minute_boundaries(ts, later).alias("minutes_crossed"),
    )


def _address_classes(t: Telemetry) -> DataFrame:
    return t.audit.groupBy(
        hosts.address_class(F.col("source_ip")).alias("ip_classification"),
        hosts.registry_domain(F.col("container_image")).alias("registry_domain"),
    ).agg(F.count(F.lit(1)).alias("events"))


def _lenient_numbers(t: Telemetry) -> DataFrame:
    text = F.regexp_replace("props", r'[{}":k]', "")
    odd = F.when(F.col("event_id") % 3 == 0, F.concat(text, F.lit("x"))).otherwise(text)
    return t.table("events").select("event_id", lenient_double(odd).alias("number"))


def _parsed_times(t: Telemetry) -> DataFrame:
    text = F.when(F.col("event_id") % 7 == 0, "not a time").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    parsed = cleaning.parse_utc(t.table("events").select("event_id", text.alias("ts")), "ts")
    return parsed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _keyed_interval(t: Telemetry) -> DataFrame:
    errors = t.table("events").where(F.col("event_type") == "error").select("user_id", F.col("ts").alias("error_ts"))
    bought = t.table("events").where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("purchase_ts"))
    return interval_join(errors, bought, "error_ts", "purchase_ts", "6 hours", keys=["user_id"], split=True)


def _previous_event(t: Telemetry) -> DataFrame:
    events = t.table("events").select("event_id", "user_id", "ts", "event_type")
    return previous_value(events, ["user_id"], ["ts", "event_id"], "event_type", "previous_type", max_gap="2 days")


def _alignment(t: Telemetry) -> DataFrame:
    reach = whole("q03_tenant_diversity", t)
    return quality.signal_alignment(
        [
            ("diverse", reach.where(F.col("distinct_orgs") >= 22)),
            ("flagged", reach.where(F.col("asn_type").isin("hosting", "vpn"))),
            ("bursty", whole("q05_burst_zscore", t).where(F.col("zscore") >= 2.5)),
            ("dense", reach.where(F.col("reqs_per_account") >= 1.4)),
        ],
        "asn",
    )


def _dns_bands(t: Telemetry) -> DataFrame:
    return t.dns_flagged.groupBy(quality.dns_score_band(F.col("score")).alias("band")).agg(
        F.count(F.lit(1)).alias("queries")
    )


def _completeness(t: Telemetry) -> DataFrame:
    return quality.chain_completeness(whole("q18_ato_chain_candidates", t)).select(
        "org_id", "account_id", "stages", "completeness"
    )


def _ordered_completeness(t: Telemetry) -> DataFrame:
    chains = takeover_chains(t.identity, **PARAMS["q18_ato_chain_candidates"], ordered=True)
    return quality.chain_completeness(chains).select("org_id", "account_id", "stages", "completeness")


def _default_width(name: str, **params: object) -> Plan:
    return lambda t: DETECTIONS[name].report(DETECTIONS[name].result(t.lazy_sources(name), **params))


def _priorities(t: Telemetry) -> DataFrame:
    scores = whole("q27_resource_anomalies", t).select(F.col("resource_anomaly_score").alias("score")).unionByName(
        whole("q29_service_account_abuse", t).select(F.col("abuse_score").alias("score"))
    ).unionByName(whole("q28_mining_pool_egress", t).select(F.col("confidence_score").alias("score")))
    return scores.groupBy(quality.alert_priority(F.col("score")).alias("priority")).agg(F.count(F.lit(1)).alias("alerts"))


def _quality(t: Telemetry) -> DataFrame:
    row = evaluate(t.dns_flagged, "score", "is_malicious", threshold=3)
    return row.withColumns({c: F.round(c, 6) for c in ("f1", "flagged_rate")})


def _table_counts(t: Telemetry) -> DataFrame:
    return tables.row_counts({name: t.table(name) for name in sorted(tables.discover(t.spark, t.directory))})


def _loaded_counts(t: Telemetry) -> DataFrame:
    """Rows of every loaded table and, with none, of the stand-ins for optional ones."""
    return tables.row_counts(tables.with_optional(t.spark, tables.load(t.spark, t.directory)))


def _named_table(t: Telemetry) -> DataFrame:
    """A loaded table by the name it was registered under, in a session of its own views."""
    session = t.spark.newSession()
    tables.with_optional(session, tables.load(session, t.directory, register=True), register=True)
    return session.sql(
        "SELECT event_type, count(*) AS n_events, count(session_id) AS n_sessions FROM events"
        " LEFT JOIN sessions ON sessions.session_id = CAST(event_id AS STRING) GROUP BY event_type"
    )


def _required_counts(t: Telemetry) -> DataFrame:
    """Rows of the tables the cluster pack requires, once none is missing."""
    sources = t.lazy_sources()
    tables.require(sources, "cluster")
    return tables.row_counts({name: sources[name] for name in tables.REQUIRED["cluster"]})


def _csv_round_trip(t: Telemetry) -> DataFrame:
    path, df = artifacts.work_folder(t.spark, "csv"), t.requests
    artifacts.write_csv(df, path)
    return artifacts.read_csv(t.spark, path, df.schema)


def _parquet_round_trip(t: Telemetry) -> DataFrame:
    path, df = artifacts.work_folder(t.spark, "parquet"), t.identity
    artifacts.write_parquet(df, path)
    return t.spark.read.schema(df.schema).parquet(path)


def _json_round_trip(t: Telemetry) -> DataFrame:
    path, df = artifacts.work_folder(t.spark, "json"), signals.overall_risk(_scaled_signals(t, "cluster"))
    artifacts.write_json(df, path)
    return artifacts.read_json(t.spark, path, df.schema)


def _defaults_and_numbers(t: Telemetry) -> DataFrame:
    """Events with a column they lack and a number read from text, of which a third is malformed."""
    text = F.regexp_replace("props", r'[{}":k ]', "")
    odd = F.when(F.col("event_id") % 3 == 0, F.concat(text, F.lit("x"))).otherwise(text)
    slim = t.table("events").select("event_id", "event_type", odd.alias("number"))
    filled = cleaning.fill_absent(slim, {"campaign_id": "", "event_type": "unused"})
    return cleaning.coerce_numbers(filled, {"number": "bigint"})


def _run_of_a_pack(t: Telemetry) -> DataFrame:
    """What a pack run lists over telemetry tables in a folder, one of its detections failing."""
    folder = artifacts.work_folder(t.spark, "pack")
    artifacts.write_parquet(t.dns, f"{folder}/data/dns_events.parquet")
    broken = {"q22_exposed_accounts": {"no_such_parameter": 1}}
    listing = packs.run_pack(t.spark, "dns", f"{folder}/data", f"{folder}/out", strict=True, params=broken)
    return listing.select("name", "row_count", F.array_join("columns", ",").alias("columns"), F.col("error").isNotNull().alias("failed"))


def _dns_build(t: Telemetry) -> DataFrame:
    """The whole feature build from raw hosts, with the default lists and thresholds and the default entity."""
    raw = t.hosts.select("ts", "request_id", "org_id", "account_id", "device_fingerprint", "host_raw")
    return features.build_dns_events(raw, order=("ts", "request_id"))


def _close(estimated: DataFrame, exact: DataFrame, on: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """``exact`` with ``<count>_close``: whether an estimate lies within three standard errors of its sketch."""
    told = estimated.select(*on, *[F.col(c).alias(f"__{c}") for c in counts])
    near = {f"{c}_close": F.abs(F.col(f"__{c}") - F.col(c)) <= F.ceil(3 * standard_error() * F.col(c)) for c in counts}
    return exact.join(told, list(on)).withColumns(near).drop(*[f"__{c}" for c in counts])


# Calendar of the benchmark events, in parts that are stored one after another.
DAYS = (date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 21), date(2024, 1, 31))
WINDOW_DAYS = (date(2024, 1, 8), date(2024, 1, 21))


def _on_days(df: DataFrame, first: date, before: date) -> DataFrame:
    return df.where((F.to_date("ts") >= F.lit(first)) & (F.to_date("ts") < F.lit(before)))


def _reach_store(t: Telemetry, width: str | None = None) -> incremental.ReachStore:
    """A store that got the events in three parts."""
    store = incremental.ReachStore(t.spark, artifacts.work_folder(t.spark, "reach"), width)
    for first, before in zip(DAYS, DAYS[1:]):
        store.add(_on_days(t.requests, first, before))
    return store


def _stored_first_seen(t: Telemetry) -> DataFrame:
    """First appearances over two weeks, from stored days."""
    first, last = WINDOW_DAYS
    inside = t.requests.where(F.to_date("ts").between(F.lit(first), F.lit(last)))
    found = incremental.first_seen_infra(_reach_store(t).united(t.requests, ["asn"], first, last), t.enrichment)
    both = coordinated.first_seen_infra(inside, t.enrichment).join(found.select("asn", F.col("first_seen_ts").alias("__ts"), F.col("requests").alias("__n")), "asn")
    exact = both.withColumn("stored_alike", (F.col("__ts") == F.col("first_seen_ts")) & (F.col("__n") == F.col("requests"))).drop("__ts", "__n")
    return _close(found, exact, ["asn"], ["distinct_orgs", "distinct_accounts"])


def _stored_diversity(t: Telemetry) -> DataFrame:
    """Tenant diversity over all thirty stored days."""
    found = incremental.tenant_diversity(_reach_store(t).united(t.requests, ["asn"]), t.enrichment)
    return _close(found, coordinated.tenant_diversity(t.requests, t.enrichment), ["asn"], ["distinct_orgs", "distinct_accounts"])


def _stored_spikes(t: Telemetry) -> DataFrame:
    """Activity of every flagged provider bucket and day, from stored time buckets."""
    store = _reach_store(t, "1 day")
    days = read_days(t.spark, store.path, store.schema(t.requests))
    found = incremental.synchronized_org_spikes(days, t.enrichment, min_orgs=0)
    exact = coordinated.synchronized_org_spikes(t.requests, t.enrichment, width="1 day", min_orgs=0)
    return _close(found, exact, ["bucket_ts", "provider_brand_bucket", "asn_type"], ["orgs", "accounts"])


def _rarity_by_day(t: Telemetry) -> DataFrame:
    """Rarity of each query's domain as known when its part of the month had come in."""
    store = incremental.DomainCounts(t.spark, artifacts.work_folder(t.spark, "domains"), HEURISTICS.rare_threshold, buckets=8)
    hosts_of = t.hosts.select("ts", "request_id", "base_domain")
    parts = [store.with_rarity(_on_days(hosts_of, a, b), n) for n, (a, b) in enumerate(zip(DAYS, DAYS[1:]))]
    return reduce(DataFrame.unionByName, parts).select("request_id", "base_domain", "rare_domain")


def _bucketed_funnel(t: Telemetry) -> DataFrame:
    """The policy funnel from fact tables stored by request, which join without a shuffle."""
    folder = artifacts.work_folder(t.spark, "facts")
    sources = {"enrichment_ip": t.enrichment}
    for name, df in (("llm_requests", t.requests), ("moderation_events", t.moderation)):
        sources[name] = artifacts.write_bucketed(df, f"{folder}/{name}", ["request_id"], buckets=8)
    funnel = DETECTIONS["q09_policy_funnel"]
    return funnel.report(funnel.result(sources))


def _session_values(t: Telemetry) -> DataFrame:
    return hunts.session_change_values(t.agent_sessions, t.audit_events, "1 day", ("virtual_agent", "now_assist"))


def _resumed_run(t: Telemetry) -> DataFrame:
    """What a second run of a pack lists after one in which a detection failed; it runs that one alone."""
    folder = artifacts.work_folder(t.spark, "resume")
    artifacts.write_parquet(t.dns, f"{folder}/data/dns_events.parquet")
    broken = {"q22_exposed_accounts": {"no_such_parameter": 1}}
    packs.run_pack(t.spark, "dns", f"{folder}/data", f"{folder}/out", params=broken)
    listing = packs.run_pack(t.spark, "dns", f"{folder}/data", f"{folder}/out", resume=True)
    return listing.select("name", "row_count", F.array_join("columns", ",").alias("columns"), F.col("error").isNotNull().alias("failed"))


def _texts_of_a_table(t: Telemetry) -> DataFrame:
    """Requests written as CSV and read back without a schema, every column as text."""
    path = artifacts.work_folder(t.spark, "texts")
    artifacts.write_csv(t.requests.select("request_id", "ts", "org_id", "event_type", "is_automation_suspected"), path)
    return artifacts.read_csv(t.spark, path)


def _zoneless(df: DataFrame) -> DataFrame:
    """Times of a stream as the tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


def _streamed_scores(t: Telemetry) -> DataFrame:
    """Bursts scored as the events come in; the last buckets stay open, as no later event closes them."""
    folder, live = artifacts.work_folder(t.spark, "scores"), LiveTelemetry(t.spark, t.directory)
    moments.start_burst_scores(live.requests, f"{folder}/out", f"{folder}/state", width="1 day", availableNow=True).awaitTermination()
    return _zoneless(moments.burst_scores(t.spark, f"{folder}/out"))


def _streamed(plan: Callable[[DataFrame], DataFrame]) -> Plan:
    """Rows that a plan over the stream of audit events has appended when all events were read."""

    def run(t: Telemetry) -> DataFrame:
        folder = artifacts.work_folder(t.spark, "stream")
        found = plan(LiveTelemetry(t.spark, t.directory).audit_events)
        writer = found.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out")
        writer.option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
        return _zoneless(t.spark.read.schema(found.schema).parquet(f"{folder}/out"))

    return run


def _exposure_of_two_periods(t: Telemetry) -> DataFrame:
    """Exposure in the first half of the month, failed sign-ins from its second third on."""
    found = hunts.exposure_then_failed_login(
        _on_days(t.dns_flagged, DAYS[0], date(2024, 1, 16)), _on_days(t.identity, DAYS[1], DAYS[-1]), min_score=4, within="10 days"
    )
    return found.withColumn("time_delta_hours", F.round("time_delta_hours", 4))


PLANS: dict[str, Plan] = {
    **{name: _report(name) for name in DETECTIONS},
    "q05_default_width": _default_width("q05_burst_zscore"),
    "q06_default_width": _default_width("q06_sync_org_spikes", min_orgs=2),
    "q25_default_width": _default_width("q25_unusual_pod_creation"),
    **{key: _signal(detection) for key, detection in SIGNAL_IDS.items()},
    **{f"sg22_overall_{pack}": _overall(pack) for pack in PACKS},
    "sg23_ranked_signals": lambda t: signals.ranked_signals(_pack_signals(t, "takeover")).select(*BRIEF, "severity"),
    **{f"sg21_scaled_signals_{pack}": _scaled(pack) for pack in ("coordinated", "takeover", "cluster")},
    **{f"sg22_scaled_overall_{pack}": _scaled_overall(pack) for pack in ("coordinated", "takeover", "cluster")},
    "sg24_additive_levels": _additive_levels,
    "sg24_additive_signals": lambda t: _additive(t).drop("contribution"),
    "sg24_additive_risk": lambda t: signals.additive_risk(_additive(t)),
    "sg25_signal_severity": lambda t: _pack_signals(t, "cluster").select(
        "id", band(F.col("score"), signals.SIGNAL_SEVERITY_STEPS, "low").alias("severity")
    ),
    "h01_users_near_sessions": lambda t: hunts.users_created_near_sessions(t.agent_sessions, t.audit_events),
    "h02_role_grants_near_sessions": lambda t: hunts.role_grants_near_sessions(
        t.agent_sessions, t.audit_events, within="2 hours", term=TERM
    ),
    "h03_resets_after_creation": lambda t: hunts.resets_after_creation(t.audit_events),
    "h04_new_privileged_users": lambda t: hunts.new_privileged_users(t.audit_events, "6 hours", TERM),
    "h05_changes_after_sessions": _changes_after_sessions,
    "h06_exposure_then_failure": _exposure,
    "h06_exposure_of_two_periods": _exposure_of_two_periods,
    "ag02_stored_first_seen": _stored_first_seen,
    "ag03_stored_diversity": _stored_diversity,
    "ag03_stored_spikes": _stored_spikes,
    "ag21_session_change_values": _session_values,
    "ag22_rarity_by_day": _rarity_by_day,
    "jn02_bucketed_funnel": _bucketed_funnel,
    "jn07_streamed_resets": _streamed(lambda audit: joins.resets_after_creation(audit)),
    "jn07_streamed_grants": _streamed(lambda audit: joins.new_privileged_users(audit, "6 hours", TERM)),
    "wn04_streamed_scores": _streamed_scores,
    "mf01_resumed_run": _resumed_run,
    "io08_texts_of_a_table": _texts_of_a_table,
    "ft01_suspicious_tld": lambda t: t.hosts.select(
        "request_id", hosts.suspicious_tld(F.col("tld"), HEURISTICS.tlds).alias("suspicious_tld")
    ),
    "ft02_keyword_hit": lambda t: t.hosts.select(
        "request_id", hosts.keyword_hit(F.col("host_raw"), HEURISTICS.keywords).alias("keyword_hit")
    ),
    "ft03_domain_entropy": _domain_table,
    "ft03_text_entropy": _document_entropy,
    "ft04_rare_domain": lambda t: t.dns_flagged.select("request_id", "base_domain", "rare_domain"),
    "ft05_composite_score": lambda t: t.dns_flagged.select(
        "request_id", "suspicious_tld", "keyword_hit", "high_entropy", "rare_domain", "score"
    ),
    "ft06_transition_edges": lambda t: features.with_transition_edges(
        t.hosts, ["account_id", "device_fingerprint"], ["ts", "request_id"]
    ).select("request_id", "base_domain", "parent_domain"),
    "ft07_base_domain": _page_hosts,
    "ft08_unified_identity": _unified_identity,
    "ft09_business_hours": _business_hours,
    "ft10_dns_summary": lambda t: features.dns_summary(t.dns),
    "ft11_distinct_accounts": lambda t: distinct_entities(t.requests, ["org_id", "account_id"]),
    "ev01_quality": _quality,
    "ev04_dns_bands": _dns_bands,
    "ev05_chain_completeness": _completeness,
    "ev05_ordered_completeness": _ordered_completeness,
    "ev06_alert_priority": _priorities,
    "ev07_signal_alignment": _alignment,
    "io02_named_table": _named_table,
    "io03_required_tables": _required_counts,
    "io04_loaded_tables": _loaded_counts,
    "io05_table_counts": _table_counts,
    "io06_csv_round_trip": _csv_round_trip,
    "io07_parquet_round_trip": _parquet_round_trip,
    "io09_json_round_trip": _json_round_trip,
    "pf16_defaults_and_numbers": _defaults_and_numbers,
    "mf01_run_of_a_pack": _run_of_a_pack,
    "ft05_dns_build": _dns_build,
    "jn07_keyed_interval": _keyed_interval,
    "wn02_previous_event": _previous_event,
    "sc12_clock_functions": _clock,
    "sc11_address_classes": _address_classes,
    "sc28_lenient_numbers": _lenient_numbers,
    "pf18_parsed_times": _parsed_times,
    **{f"mf02_manifest_{pack}": _manifest(pack) for pack in PACKS},
    "mf03_evidence": lambda t: signals.evidence_table(_pack_signals(t, "takeover")).drop("rationale"),
}


def _query(plan: Plan) -> Query:
    return lambda spark, directory: plan(Telemetry(spark, directory))


def queries() -> dict[str, Query]:
    return {name: _query(plan) for name, plan in PLANS.items()}
