"""Forms that read stored days, bucketed tables or earlier runs instead of all rows again."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sieveline.operators import sketches
from sieveline.plans import coordinated, hunts, incremental, packs
from sieveline.sources import artifacts
from tests.tables import at, identity, planted_chain, table


@pytest.fixture
def merge_joins(spark):
    """Joins that would broadcast their small test tables shuffle or merge instead."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def under(plan, node):
    """Lines of the last ``node`` of a plan and of all below it."""
    lines = plan.splitlines()
    at = max(i for i, line in enumerate(lines) if node in line)
    depth, end = lines[at].index(node), at + 1
    while end < len(lines) and len(lines[end]) > depth and not lines[end][:depth].strip(" :"):
        end += 1
    return "\n".join(lines[at:end])


# --- sketches


def requests_of(spark, n=20_000):
    return spark.range(n).selectExpr(
        "timestamp_seconds(1704067200 + id * 120) AS ts", "id % 7 AS asn", "id % 13 AS org_id", "concat('a', (id * id) % 9973) AS account_id"
    )


def test_united_days_are_near_the_exact_counts_and_read_no_rows(spark, tmp_path):
    requests = requests_of(spark)
    store = incremental.ReachStore(spark, f"{tmp_path}/reach")
    store.add(requests.where("ts < '2024-01-15'"))
    store.add(requests.where("ts >= '2024-01-15'"))
    for first, last in ((None, None), (date(2024, 1, 3), date(2024, 1, 20)), (date(2024, 1, 5), date(2024, 1, 5))):
        inside = requests
        if first:
            inside = requests.where(F.to_date("ts").between(F.lit(first), F.lit(last)))
        got = store.united(requests, ["asn"], first, last)
        want = {r.asn: r for r in inside.groupBy("asn").agg(
            F.count("*").alias("n"), F.min("ts").alias("t"), F.count_distinct("org_id").alias("o"), F.count_distinct("account_id").alias("a")).collect()}
        found = got.collect()
        assert len(found) == len(want) == 7
        for r in found:
            exact = want[r.asn]
            assert (r.requests, r.first_seen_ts, r.distinct_orgs) == (exact.n, exact.t, exact.o)
            assert abs(r.distinct_accounts - exact.a) <= 3 * sketches.standard_error() * exact.a + 1
        assert "Range" not in plan_of(got) and "reach" in plan_of(got)
    assert "PartitionFilters: [isnotnull(day" in plan_of(got)


def test_a_day_that_comes_again_replaces_itself(spark, tmp_path):
    requests = requests_of(spark, 4000)
    store = incremental.ReachStore(spark, f"{tmp_path}/reach", "6 hours")
    store.add(requests)
    store.add(requests.where("ts >= '2024-01-03' AND ts < '2024-01-04'"))
    got = {r.asn: r.requests for r in store.united(requests, ["asn"]).collect()}
    assert got == {r.asn: r["count"] for r in requests.groupBy("asn").count().collect()}


def test_error_of_a_sketch_is_as_stated(spark):
    df = spark.range(300_000).selectExpr("id % 30 AS g", "id", "timestamp_seconds(0) AS ts")
    for lg_k in (8, 12):
        days = sketches.daily_sketches(df, "ts", ["g"], {"n": "id"}, lg_k=lg_k)
        errors = [r.n / 10_000 - 1 for r in sketches.unite(days, ["g"], ["n"]).collect()]
        spread = (sum(e * e for e in errors) / len(errors)) ** 0.5
        assert spread <= 1.5 * sketches.standard_error(lg_k) and len(errors) == 30


def test_organisations_on_two_networks_of_a_provider_count_once(spark, tmp_path):
    rows = [{"request_id": str(i), "ts": at(i), "org_id": f"o{i % 5}", "account_id": f"a{i % 3}", "asn": i % 2} for i in range(40)]
    requests = table(spark, "llm_requests", rows)
    enrichment = table(spark, "enrichment_ip", [{"asn": n, "asn_type": "vpn", "provider_brand_bucket": "p"} for n in range(2)])
    store = incremental.ReachStore(spark, f"{tmp_path}/reach", "15 minutes")
    store.add(requests)
    days = sketches.read_days(spark, store.path, store.schema(requests))
    got = incremental.synchronized_org_spikes(days, enrichment, min_orgs=5)
    want = coordinated.synchronized_org_spikes(requests, enrichment, min_orgs=5)
    columns = sorted(want.columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect())) and want.count() == 3


# --- rarity by day


def test_rarity_by_day_equals_a_recount(spark, tmp_path):
    draw = random.Random(4)
    days = [[(f"r{d}-{i}", draw.choice(["hot.com"] * 30 + [f"d{draw.randrange(60)}.net", None])) for i in range(300)] for d in range(4)]
    store = incremental.DomainCounts(spark, f"{tmp_path}/domains", rare_threshold=5, buckets=4)
    seen = []
    for version, day in enumerate(days):
        seen += [d for _, d in day]
        df = spark.createDataFrame(day, "request_id string, base_domain string").repartition(3)
        for _ in range(2 if version == 1 else 1):  # a day that is run again changes nothing
            got = store.with_rarity(df, version)
        want = [(r, d, d is not None and seen.count(d) <= 5) for r, d in day]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    kept = {r.base_domain: r.queries for r in store._at(4).collect()}
    assert kept["hot.com"] == 6 and kept == {d: min(seen.count(d), 6) for d in set(seen) if d}


def test_the_history_of_domains_is_not_shuffled(spark, merge_joins, tmp_path):
    store = incremental.DomainCounts(spark, f"{tmp_path}/domains", rare_threshold=5, buckets=4)
    day = spark.range(1000).selectExpr("'d' || id % 400 AS base_domain")
    store.with_rarity(day, 0)
    today = day.limit(10).groupBy("base_domain").agg(F.count("*").alias("today"))
    plan = plan_of(store._merged(store._at(1), today))
    join = plan[plan.index("SortMergeJoin") :].split("\n")
    left = [line for line in join[1:] if line.lstrip(" ").startswith((":-", ":"))]
    assert any("Bucketed: true" in line for line in left) and not any("Exchange" in line for line in left)


# --- bucketed facts


def test_bucketed_facts_join_without_a_shuffle(spark, merge_joins, tmp_path):
    requests = table(spark, "llm_requests", [
        {"request_id": f"r{i}", "ts": at(i), "org_id": f"o{i % 3}", "account_id": f"a{i % 7}", "asn": i % 4} for i in range(200)])
    outcomes = table(spark, "moderation_events", [{"request_id": f"r{i}", "policy_action": "block" if i % 3 else "warn"} for i in range(0, 200, 2)])
    enrichment = table(spark, "enrichment_ip", [{"asn": n, "asn_type": "vpn", "provider_brand_bucket": f"p{n % 2}"} for n in range(4)])
    a = artifacts.write_bucketed(requests, f"{tmp_path}/requests", ["request_id"], 4)
    b = artifacts.write_bucketed(outcomes, f"{tmp_path}/outcomes", ["request_id"], 4)
    funnel = coordinated.policy_funnel(a, enrichment, b)
    join = under(plan_of(funnel), "SortMergeJoin [request_id")
    assert "Exchange" not in join and join.count("Bucketed: true") == 2
    plain = coordinated.policy_funnel(requests, enrichment, outcomes)
    assert sorted(map(tuple, funnel.collect())) == sorted(map(tuple, plain.collect()))
    again = artifacts.read_bucketed(spark.newSession(), f"{tmp_path}/requests", requests.schema, ["request_id"], 4)
    assert again.count() == 200 and "Bucketed: true" in plan_of(again.groupBy("request_id").count())
    artifacts.write_bucketed(requests.limit(5), f"{tmp_path}/requests", ["request_id"], 4)
    assert artifacts.read_bucketed(spark, f"{tmp_path}/requests", requests.schema, ["request_id"], 4).count() == 5


# --- hunts in long form


def test_a_session_with_most_changes_is_told_by_rows(spark):
    start = datetime(2024, 1, 1)
    sessions = spark.createDataFrame(
        [("s1", "u1", start, "portal"), ("s2", "u2", start, "portal"), (None, "u2", start, "portal")],
        "session_id string, user_email string, started_at timestamp, source string")
    rows = [(start + timedelta(seconds=i % 900), "role_grant", f"actor{i}", f"t{i % 500}", "u1") for i in range(3000)]
    rows += [(start, "user_create", "b", None, "u2"), (start, "role_grant", "a", None, "u2"), (start, "login", "c", "t", "u2")]
    audit = spark.createDataFrame(rows, "event_time timestamp, event_type string, actor string, target string, target_email string")
    got = {(r.session_user, r.session_id): r for r in hunts.identity_changes_after_sessions(sessions, audit, most_values=500).collect()}
    assert len(got) == 3
    hot = got["u1", "s1"]
    assert hot.events == ["role_grant"] and hot.targets == sorted(f"t{i}" for i in range(500))
    assert hot.actors is None and (hot.n_events, hot.n_targets, hot.n_actors) == (1, 500, 3000)
    for session in ("s2", None):
        small = got["u2", session]
        assert (small.events, small.targets, small.actors, small.n_targets) == (["role_grant", "user_create"], [], ["a", "b"], 0)
    values = hunts.session_change_values(sessions, audit)
    assert values.where("session_user = 'u1' AND kind = 'actors'").count() == 3000


# --- runs that go on


@pytest.fixture
def case(spark, tmp_path):
    frames = {
        "enrichment_ip": table(spark, "enrichment_ip", [{"asn": n, "ip": f"10.0.0.{n}", "asn_type": "vpn"} for n in range(9)]),
        "identity_events": identity(spark, planted_chain()),
    }
    for name, df in frames.items():
        artifacts.write_parquet(df.coalesce(1), f"{tmp_path}/data/{name}.parquet")
    return f"{tmp_path}/data", f"{tmp_path}/out"


@pytest.fixture
def counted(monkeypatch):
    """Names of the detections that ran, and at which one the run is to be stopped."""
    ran, stop = [], []
    plain = packs.Detection.result

    def result(self, sources, **params):
        if self.name in stop:
            raise KeyboardInterrupt
        ran.append(self.name)
        return plain(self, sources, **params)

    monkeypatch.setattr(packs.Detection, "result", result)
    return ran, stop


def test_a_stopped_run_goes_on_where_it_stopped(spark, case, counted):
    (data, out), (ran, stop) = case, counted
    names = sorted(d.name for d in packs.PACKS["takeover"])
    stop.append(names[3])
    with pytest.raises(KeyboardInterrupt):
        packs.run_pack(spark, "takeover", data, out, resume=True)
    assert ran == names[:3]
    stop.clear()
    listing = packs.run_pack(spark, "takeover", data, out, resume=True).collect()
    assert ran == names  # the first three were not run again
    assert [r.name for r in listing] == names and not any(r.error for r in listing)
    ran.clear()
    whole = packs.run_pack(spark, "takeover", data, f"{out}-whole").collect()
    assert ran == names
    plain = lambda rows: [(r.name, r.row_count, r["columns"], r.error) for r in rows]
    assert plain(listing) == plain(whole)
    risk = lambda folder: [tuple(r) for r in spark.read.json(f"{folder}/scoring").collect()]
    assert risk(out) == risk(f"{out}-whole")


def test_changed_parameters_and_files_run_again(spark, case, counted):
    (data, out), (ran, _) = case, counted
    packs.run_pack(spark, "takeover", data, out, resume=True)
    ran.clear()
    packs.run_pack(spark, "takeover", data, out, resume=True, params={"q12_failed_login_bursts": {"min_failures": 3}})
    assert ran == ["q12_failed_login_bursts"]
    ran.clear()
    identity(spark, planted_chain("other")).coalesce(1).write.mode("append").parquet(f"{data}/identity_events.parquet")
    listing = {r.name: r.row_count for r in packs.run_pack(spark, "takeover", data, out, resume=True).collect()}
    assert len(ran) == 8 and listing["q18_ato_chain_candidates"] == 2
    ran.clear()
    packs.run_pack(spark, "takeover", data, out)
    assert len(ran) == 8  # without resume everything runs


def test_pairs_of_one_detection_feed_another(spark, case, monkeypatch):
    data, out = case
    handed = []
    plain = packs.Detection.result

    def result(self, sources, **params):
        if self.name == "q18_ato_chain_candidates":
            handed.append(params.get("pairs"))
        return plain(self, sources, **params)

    monkeypatch.setattr(packs.Detection, "result", result)
    shared = packs.run_pack(spark, "takeover", data, out).collect()
    assert all("results/q13" in path for path in handed[-1].inputFiles())
    packs.run_pack(spark, "takeover", data, f"{out}-2", params={"q13_new_asn_after_failures": {"min_failures": 2}})
    assert handed[-1] is None  # other parameters, other pairs
    counts = {r.name: r.row_count for r in shared}
    assert counts["q13_new_asn_after_failures"] == 1 and counts["q18_ato_chain_candidates"] == 1
