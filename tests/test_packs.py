import pytest
from pyspark.sql import functions as F

from sieveline.plans.packs import DETECTIONS, PACKS, manifest, pack_results, run_pack
from sieveline.sources import artifacts, cleaning, tables
from sieveline.sources.schemas import SCHEMAS
from tests.tables import at, identity, planted_chain, table


@pytest.fixture(scope="module")
def data_dir(spark, tmp_path_factory):
    """Tables of the takeover and coordinated packs as Parquet directories."""
    root = tmp_path_factory.mktemp("telemetry")
    enrichment = [{"asn": n, "ip": f"10.0.0.{n}", "asn_type": "vpn", "provider_brand_bucket": "p"} for n in range(9)]
    requests = [
        {"request_id": f"r{i}", "ts": at(i), "org_id": f"o{i % 12}", "account_id": f"a{i % 20}", "asn": i % 3,
         "device_fingerprint": "d", "template_hash": "t", "content_cluster_id": "c", "is_automation_suspected": True}
        for i in range(60)
    ]
    frames = {
        "enrichment_ip": table(spark, "enrichment_ip", enrichment),
        "accounts": table(spark, "accounts", []),
        "orgs": table(spark, "orgs", []),
        "devices": table(spark, "devices", [{"device_fingerprint": "d", "is_headless": True}]),
        "identity_events": identity(spark, planted_chain()),
        "llm_requests": table(spark, "llm_requests", requests),
        "moderation_events": table(spark, "moderation_events", [{"request_id": "r1", "policy_action": "block"}]),
    }
    for name, df in frames.items():
        artifacts.write_parquet(df.coalesce(1), f"{root}/{name}.parquet")
    return str(root)


def test_discovery_and_loading(spark, data_dir):
    found = tables.discover(spark, data_dir)
    assert list(found) == sorted(found) and "llm_requests" in found
    loaded = tables.load(spark, data_dir, register=True)
    assert loaded["identity_events"].schema == SCHEMAS["identity_events"]
    assert spark.sql("SELECT count(*) AS n FROM llm_requests").first().n == 60
    counts = {r.table_name: r.row_count for r in tables.row_counts(loaded).collect()}
    assert counts["llm_requests"] == 60 and counts["orgs"] == 0
    with pytest.raises(FileNotFoundError):
        tables.discover(spark, data_dir + "/absent")


def test_conform_fills_absent_and_malformed(spark):
    odd = spark.createDataFrame([("x", "7"), ("bad", None)], "ip string, asn string")
    got = tables.conform(odd.withColumn("asn", F.col("ip")), SCHEMAS["enrichment_ip"])
    assert got.schema == SCHEMAS["enrichment_ip"] and [r.asn for r in got.collect()] == [None, None]


def test_required_tables_differ_per_pack(spark, data_dir):
    loaded = tables.load(spark, data_dir)
    tables.require(loaded, "takeover")
    tables.require(loaded, "coordinated")
    assert tables.missing(loaded, "dns") == ["dns_events"]
    with pytest.raises(tables.MissingTables):
        tables.require(loaded, "cluster")


def test_absent_optional_tables_are_empty_and_typed(spark, data_dir):
    full = tables.with_optional(spark, tables.load(spark, data_dir), register=True)
    assert full["rate_limit_events"].schema == SCHEMAS["rate_limit_events"]
    assert spark.sql("SELECT * FROM osint_observations").count() == 0


def test_takeover_pack_end_to_end(spark, data_dir, tmp_path):
    listing = run_pack(spark, "takeover", data_dir, str(tmp_path), strict=True)
    entries = {r.name: r for r in listing.collect()}
    assert [e.error for e in entries.values()] == [None] * 8
    assert entries["q18_ato_chain_candidates"].row_count == 1
    chains = artifacts.read_csv(spark, entries["q18_ato_chain_candidates"].artifact, "org_id string, account_id string")
    assert chains.count() == 1
    texts = artifacts.read_csv(spark, entries["q14_mfa_device_added"].artifact)
    assert set(dict(texts.dtypes).values()) == {"string"} and texts.columns == entries["q14_mfa_device_added"].columns
    scoring = spark.read.json(f"{tmp_path}/scoring").first()
    ranked = spark.read.json(f"{tmp_path}/signals").collect()
    document = spark.read.json(f"{tmp_path}/manifest").first()
    assert (document.case_id, document.data_dir) == ("takeover", data_dir) and document.generated_at
    assert len(document.findings) == 8 and document.table_counts
    evidence = spark.read.json(f"{tmp_path}/evidence").collect()
    assert len(evidence) == len(ranked) and all(r.artifact.startswith(f"{tmp_path}/artifacts/") and "=" in r.top_row for r in evidence)
    assert scoring.signal_count == len(ranked) == 6
    weights = {r.id: (r.weight, r.score_0_1) for r in ranked}
    want = sum(w * s for w, s in weights.values()) / sum(w for w, _ in weights.values())
    assert scoring.overall_risk_score == round(100 * want)
    assert spark.read.json(f"{tmp_path}/findings").count() == 8


def test_coordinated_pack_and_parameters(spark, data_dir, tmp_path):
    listing = run_pack(spark, "coordinated", data_dir, str(tmp_path), params={"q04_device_reuse": {"min_accounts": 21}})
    rows = {r.name: (r.row_count, r.error) for r in listing.collect()}
    assert rows["q04_device_reuse"] == (0, None)
    assert rows["q11_rate_limit_summary"] == (0, None)
    assert rows["q07_template_reuse"] == (1, None)


def test_one_failure_does_not_stop_a_pack(spark, data_dir, tmp_path):
    listing = {r.name: r for r in run_pack(spark, "dns", data_dir, str(tmp_path)).collect()}
    assert len(listing) == 5 and all("dns_events" in r.error for r in listing.values())
    broken = run_pack(spark, "takeover", data_dir, str(tmp_path), params={"q12_failed_login_bursts": {"nope": 1}})
    assert [r.name for r in broken.collect() if r.error] == ["q12_failed_login_bursts"]


def test_strict_run_needs_tables(spark, data_dir, tmp_path):
    with pytest.raises(tables.MissingTables):
        run_pack(spark, "cluster", data_dir, str(tmp_path), strict=True)


def test_lazy_manifest_counts_reports(spark, data_dir):
    sources = tables.with_optional(spark, tables.load(spark, data_dir))
    got = {r.name: (r.row_count, len(r["columns"])) for r in manifest(pack_results("takeover", sources)).collect()}
    assert got["q12_failed_login_bursts"] == (1, 11) and got["q13_new_asn_after_failures"] == (1, 15)


def test_every_detection_is_in_one_pack():
    names = [d.name for pack in PACKS.values() for d in pack]
    assert len(names) == len(set(names)) == len(DETECTIONS) == 31
    assert [n[:3] for n in names] == [f"q{i:02d}" for i in range(1, 32)]


def test_cleaning(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "5"), ("nonsense", "x"), (None, None)], "ts string, asn string")
    parsed = cleaning.parse_utc(df, "ts")
    assert parsed.count() == 1 and dict(parsed.dtypes)["ts"] == "timestamp"
    numbers = cleaning.coerce_numbers(df, {"asn": "bigint"})
    assert [r.asn for r in numbers.collect()] == [5, None, None]
    filled = cleaning.fill_absent(df, {"asn": 0, "provider_category": ""})
    assert filled.columns == ["ts", "asn", "provider_category"] and filled.first().asn == "5"
    assert cleaning.drop_keyless(df, ["ts"]).count() == 2


def test_parquet_sink_uses_zstd(spark, tmp_path):
    import pyarrow.parquet as pq

    artifacts.write_parquet(spark.range(10).coalesce(1), f"{tmp_path}/t")
    (part,) = tmp_path.glob("t/*.parquet")
    assert pq.ParquetFile(part).metadata.row_group(0).column(0).compression == "ZSTD"


def test_times_are_utc_in_any_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["2024-01-01 00:00:00", "2024-01-01T00:00:00.5", "2024-01-01", "2024-01-01 00:00:00Z", "2024-01-01T02:00:00+02:00", "soon"]
        df = cleaning.parse_utc(spark.createDataFrame([(t,) for t in texts], "ts string"), "ts")
        assert sorted(r[0] for r in df.selectExpr("unix_millis(ts)").collect()) == [1704067200000] * 4 + [1704067200500]
        kept = cleaning.parse_utc(spark.sql("SELECT timestamp_seconds(1704067200) AS ts"), "ts")
        assert [r[0] for r in kept.selectExpr("unix_seconds(ts)").collect()] == [1704067200]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text_sinks_keep_microseconds(spark, tmp_path):
    rows = spark.sql("SELECT 1 AS i, TIMESTAMP_NTZ '2024-01-02 03:04:05.678901' AS t, TIMESTAMP '2024-01-02 03:04:05.678901' AS u")
    artifacts.write_csv(rows, str(tmp_path / "csv"))
    artifacts.write_json(rows, str(tmp_path / "json"))
    assert artifacts.read_csv(spark, str(tmp_path / "csv"), rows.schema).collect() == rows.collect()
    assert artifacts.read_json(spark, str(tmp_path / "json"), rows.schema).collect() == rows.collect()
