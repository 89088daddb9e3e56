import time
from datetime import timedelta

from pyspark.sql import functions as F

from sieveline.plans import coordinated, hunts, takeover
from sieveline.streaming import joins, moments, windows
from tests.tables import FAIL, at, identity, table


def replay(spark, df, closing, plan, tmp_path):
    """Streams ``df`` file by file, then ``closing``, whose late times close every window."""
    source = f"{tmp_path}/source"
    df.repartition(3).write.parquet(source)
    time.sleep(1.1)  # files are taken by modification time
    closing.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        plan(stream).writeStream.format("parquet").outputMode("append")
        .option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out")


def same(left, right):
    columns = sorted(left.columns)
    key = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert sorted(right.columns) == columns and key(left) == key(right)


def test_streamed_bursts_equal_batch(spark, tmp_path):
    rows = [(at(m / 4), f"a{m % 3}", *FAIL, 1) for m in range(120)]
    events = identity(spark, rows)
    closing = identity(spark, [(at(0) + timedelta(days=2), "z", *FAIL, 1)])
    got = replay(spark, events, closing,
                 lambda s: windows.failed_login_buckets(s, lateness="1 day"), tmp_path)
    want = takeover.failure_buckets(events, "10 minutes", 6)
    assert want.count() == 9
    same(got, want)


def test_streamed_spikes_equal_batch(spark, tmp_path):
    enrichment = table(spark, "enrichment_ip", [
        {"asn": 1, "asn_type": "vpn", "provider_brand_bucket": "p"}, {"asn": 2, "asn_type": "corporate", "provider_brand_bucket": "p"}])
    def request(i, **extra):
        return {"request_id": str(i), "ts": at(i / 6), "org_id": f"o{i % 12}", "account_id": f"a{i % 7}", "asn": 1 + (i % 5 == 0), **extra}
    requests = table(spark, "llm_requests", [request(i) for i in range(300)])
    closing = table(spark, "llm_requests", [request(0, ts=at(0) + timedelta(days=d), asn=1) for d in (2, 3, 4)])
    got = replay(spark, requests, closing,
                 lambda s: windows.synchronized_org_spikes(s, enrichment, lateness="1 day"), tmp_path)
    want = coordinated.synchronized_org_spikes(requests, enrichment)
    assert want.count() >= 3
    same(got, want.where(F.col("orgs") >= 10))


def wave(i, **extra):
    """Requests of three networks whose buckets hold different numbers of rows."""
    return {"request_id": str(i), "ts": at(i * (1 + i % 7) / 9), "org_id": "o", "account_id": f"a{i % 7}", "asn": i % 3, **extra}


def run_stream(spark, schema, source, plan, out, state):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        plan(stream).writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def test_streamed_zscores_are_those_of_the_prefix_and_survive_a_restart(spark, tmp_path):
    enrichment = table(spark, "enrichment_ip", [{"asn": n, "asn_type": "vpn", "provider_brand_bucket": "p"} for n in range(3)])
    rows = [wave(i) for i in range(400)]
    requests = table(spark, "llm_requests", [r for r in rows if r["ts"] < at(160)])
    closing = [wave(0, ts=at(0) + timedelta(days=d), asn=9) for d in (2, 3)]
    source, out, state = (f"{tmp_path}/{x}" for x in ("source", "out", "state"))
    parts = [[r for r in rows if at(low) <= r["ts"] < at(high)] for low, high in ((0, 60), (60, 100), (100, 160))]
    for part in (*parts, closing[:1], closing[1:]):
        table(spark, "llm_requests", part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(requests.schema).parquet(source)
        # A new query each time, on the same state.
        moments.start_burst_scores(stream, out, state, availableNow=True).awaitTermination()
    got = moments.burst_scores(spark, out).where("asn < 9").collect()
    ends = sorted({r.bucket_ts for r in got})
    assert len(ends) >= 8 and len(got) >= 20
    want = set()
    for end in ends:
        prefix = requests.where(F.col("ts") < F.lit(end + timedelta(minutes=15)))
        want |= {(r.asn, r.bucket_ts, r.reqs, r.zscore) for r in coordinated.burst_zscore(prefix, enrichment).where(F.col("bucket_ts") == F.lit(end)).collect()}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_moments_merge_as_if_all_buckets_were_there(spark):
    rows = [(i % 4, at(15 * i), (i * i) % 17 + 10**9 * (i % 4 == 3)) for i in range(80)]
    buckets = spark.createDataFrame(rows, "asn int, bucket_ts timestamp, reqs bigint")
    whole = moments.with_moments(buckets, None)
    first = moments.with_moments(buckets.where(F.col("bucket_ts") < F.lit(at(15 * 33))), None)
    state = moments.moments_after(first, None)
    rest = moments.with_moments(buckets.where(F.col("bucket_ts") >= F.lit(at(15 * 33))), state)
    key = lambda df: sorted((r.asn, r.bucket_ts, r.n, round(r.mean, 6), None if r.zscore is None else round(r.zscore, 6)) for r in df.collect())
    assert key(first.unionByName(rest)) == key(whole)
    assert moments.moments_after(rest, state).count() == 4


def audit_rows(n):
    kinds = ("user_create", "role_grant", "password_reset", "login")
    return [(at(i * 3), kinds[(i * i + i // 5) % 4], f"actor{i % 5}", f"u{i % 11}", "to ADMIN" if i % 3 else "-") for i in range(n)]


def test_streamed_hunts_equal_batch_in_bounded_state(spark, tmp_path):
    schema = "event_time timestamp, event_type string, actor string, target string, details_json string"
    rows = audit_rows(600)
    audit = spark.createDataFrame(rows, schema)
    source = f"{tmp_path}/source"
    for start in range(0, 600, 60):
        spark.createDataFrame(rows[start : start + 60], schema).coalesce(1).write.mode("append").parquet(source)
        time.sleep(0.05)
    pairs = (
        ("resets", lambda s: joins.resets_after_creation(s, "2 hours"), hunts.resets_after_creation(audit, "2 hours")),
        ("grants", lambda s: joins.new_privileged_users(s, "2 hours"), hunts.new_privileged_users(audit, "2 hours")),
    )
    for name, plan, want in pairs:
        query = run_stream(spark, audit.schema, source, plan, f"{tmp_path}/{name}", f"{tmp_path}/{name}-state")
        assert want.count() > 50
        same(spark.read.parquet(f"{tmp_path}/{name}"), want)
        held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        # 300 and more rows reach each join; a few hours of them are held at any time.
        assert len(held) >= 8 and max(held) <= 120 and held[-1] <= 120
