import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sieveline.operators.baseline import group_zscore
from sieveline.operators.confusion import evaluate
from sieveline.operators.firsts import distinct_entities, first_seen
from sieveline.operators import intervals
from sieveline.operators.heavy import heavy_cells, join_salts, joined_cells, mark_heavy, salts_of
from sieveline.operators.intervals import first_match_after, first_match_among, interval_join, lookback_join
from sieveline.operators.lookup import attach_by_frequency, frequency
from sieveline.operators.neighbours import previous_value
from sieveline.operators.ranking import ranked
from sieveline.operators.slices import range_slices
from sieveline.operators.spread import first_non_null, spread_profile

T0 = datetime(2024, 1, 1)
MICRO = timedelta(microseconds=1)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def moments(seed, n, span_minutes, hot=0.0):
    """Random (key, time, id) rows; a share ``hot`` of them has one key and one short span."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if rng.random() < hot:
            out.append(("hot", T0 + timedelta(seconds=rng.randrange(600)), i))
        else:
            out.append((rng.choice(["a", "b", None]), T0 + timedelta(seconds=rng.randrange(span_minutes * 60)), i))
    return out


def test_spread_profile_equals_direct_distinct_counts(spark):
    rng = random.Random(1)
    data = [(rng.choice("xy"), rng.choice(["p", "q", None]), rng.randrange(5), rng.randrange(100)) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, a string, b int, v int").repartition(3)
    got = spread_profile(
        df, ["k"], {"as_": "a", "bs": "b"}, rows="n", sums={"s": F.col("v")}, mins={"lo": F.col("v")},
        maxs={"hi": F.col("v")}, sample_min={"sample": "a"},
    )
    want = df.groupBy("k").agg(
        F.count("*").alias("n"), F.count_distinct("a").alias("as_"), F.count_distinct("b").alias("bs"),
        F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.min("a").alias("sample"),
    )
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_spread_profile_without_groups_counts_empty_input(spark):
    empty = spark.createDataFrame([], "a string")
    assert spread_profile(empty, [], {"n_a": "a"}, rows="n").collect()[0].asDict() == {"n": 0, "n_a": 0}


def test_first_non_null_skips_nulls_and_breaks_ties_by_value(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (2, "a"), (3, "0")], "t int, v string")
    assert df.agg(first_non_null("v", ["t"]).alias("v")).first()["v"] == "a"


def test_zscore_is_null_for_constant_groups(spark):
    df = spark.createDataFrame([("c", 5), ("c", 5), ("v", 1), ("v", 3)], "k string, n int")
    assert rows(group_zscore(df, ["k"], "n"), "k", "zscore") == [("c", None), ("c", None), ("v", -1.0), ("v", 1.0)]


def test_ranked_puts_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r.v for r in ranked(df, ["v"]).collect()] == [1, 2, None]
    assert [r.v for r in ranked(df, ["-v"], 2).collect()] == [2, 1]


def test_first_seen_ignores_null_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 0)], "k string, t int")
    assert rows(first_seen(df, ["k"], "t", "first"), "k", "first") == [("a", 1)]
    assert distinct_entities(df, ["k"]).count() == 2


@pytest.mark.parametrize("replicate", ["starts", "points"])
@pytest.mark.parametrize("salts, floor", [(1, 0), (4, 0), (4, 30), (4, 10**6)])
def test_interval_join_equals_plain_join(spark, replicate, salts, floor):
    left, right = moments(2, 80, 300, hot=0.3), moments(3, 120, 300, hot=0.3)
    within = timedelta(minutes=20)
    want = sorted((a[2], b[2]) for a in left for b in right if a[0] is not None and a[0] == b[0] and a[1] <= b[1] <= a[1] + within)
    starts = spark.createDataFrame(left, "k string, s timestamp_ntz, i int")
    points = spark.createDataFrame(right, "k string, p timestamp_ntz, j int").repartition(3)
    got = interval_join(starts, points, "s", "p", "20 minutes", ["k"], salts > 1, replicate, floor)
    assert got.columns == ["k", "s", "i", "p", "j"]
    assert sorted((r.i, r.j) for r in got.collect()) == want


@pytest.mark.parametrize("replicate", ["starts", "points"])
def test_interval_join_on_time_alone(spark, replicate):
    left, right = moments(4, 60, 200, hot=0.3), moments(5, 60, 200, hot=0.3)
    want = sorted((a[2], b[2]) for a in left for b in right if a[1] <= b[1] <= a[1] + timedelta(minutes=30))
    starts = spark.createDataFrame(left, "k string, s timestamp, i int").drop("k")
    points = spark.createDataFrame(right, "k string, p timestamp, j int").drop("k")
    got = interval_join(starts, points, "s", "p", "30 minutes", split=True, replicate=replicate, floor=10)
    assert sorted((r.i, r.j) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("replicate", ["starts", "points"])
def test_a_crowded_join_is_dealt_over_tasks_by_its_pairs(spark, replicate):
    # Few rows, which adaptive execution merges into one task; three quarters of the starts lie within one second.
    starts = spark.range(400).selectExpr("timestamp_millis(CASE WHEN id % 4 = 0 THEN id * 60000 ELSE id END) AS s", "id AS i")
    points = spark.range(400).selectExpr("timestamp_millis(CASE WHEN id % 2 = 0 THEN id * 60000 ELSE 900 + id % 7 END) AS p", "id AS j")
    moment = lambda n, k, near: n * 60000 if n % k == 0 else near
    want = sorted(
        (i, j) for i in range(400) for j in range(400) if 0 <= (moment(j, 2, 900 + j % 7) - (i * 60000 if i % 4 == 0 else i)) <= 1800000
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = interval_join(starts, points, "s", "p", "30 minutes", split=True, replicate=replicate, pairs=2000)
        assert sorted((r.i, r.j) for r in got.collect()) == want
        tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) >= 8 and max(tasks) < 0.3 * len(want)
        # The end of an interval is told once a start, not once a pair.
        (join,) = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
        assert "INTERVAL" not in join and "__bound" in join
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("replicate", ["starts", "points"])
@pytest.mark.parametrize("floor, pairs", [(10**6, 400), (10, 400), (10**6, 6400)])
def test_tiles_give_the_rows_of_the_plain_join(spark, replicate, floor, pairs):
    # Times, keys and whole rows that repeat, are NULL or NaN; keys that are equal but differ in sign keep it.
    key = "CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') WHEN 2 THEN -0.0D WHEN 3 THEN 0.0D ELSE 1.0D END AS k"
    time = "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN timestamp_millis(id % 50) ELSE timestamp_seconds(id * 4) END AS"
    starts = spark.range(300).selectExpr(key, f"{time} s", "id % 90 AS i")
    points = spark.range(400).selectExpr(key, f"{time} p", "nullif(id % 110, 7) AS j", "id % 5 AS v").repartition(3)
    joined = lambda **kw: interval_join(starts, points, "s", "p", "20 minutes", ["k"], replicate=replicate, **kw)
    tiled = joined(split=True, floor=floor, pairs=pairs)
    assert "collect_list" in tiled._jdf.queryExecution().optimizedPlan().toString()
    assert tiled.schema["k"].dataType == starts.schema["k"].dataType and tiled.columns == ["k", "s", "i", "p", "j", "v"]
    assert [*map(repr, rows(tiled, *tiled.columns))] == [*map(repr, rows(joined(), *tiled.columns))]


@pytest.mark.parametrize("replicate", ["starts", "points"])
def test_a_crowded_join_is_small_as_a_file(spark, replicate, tmp_path):
    # Without tiles a pair took 1.6 bytes here; as many times and ids as rows, so no repeats help.
    starts = spark.range(2000).selectExpr("timestamp_millis(id * 7919 % 3600000) AS s", "id AS i", "concat('user', id) AS u")
    points = spark.range(2000).selectExpr("timestamp_millis(id * 6007 % 3600000) AS p", "id AS j", "id * 3 AS v", "concat('name', id) AS w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        interval_join(starts, points, "s", "p", "30 minutes", split=True, replicate=replicate, pairs=2**18).write.parquet(f"{tmp_path}/pairs")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    size = sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet"))
    assert size < spark.read.parquet(f"{tmp_path}/pairs").count()


def test_few_pairs_a_row_are_joined_as_rows(spark):
    starts = spark.range(900).selectExpr("timestamp_seconds(id * 600) AS s", "id AS i")
    points = spark.range(900).selectExpr("timestamp_seconds(id * 600) AS p", "id AS j")
    dealt = interval_join(starts, points, "s", "p", "30 minutes", split=True, pairs=400)
    assert "collect_list" not in dealt._jdf.queryExecution().optimizedPlan().toString()
    assert dealt.count() == 4 * 900 - 6


def test_joined_cells_count_pairs_of_ordinary_cells_too(spark):
    left = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)] * 20 + [(None,)] * 9, "k string")
    right = spark.createDataFrame([("a",)] * 7 + [("b",)] * 2 + [(None,)] * 9, "k string")
    cells, tasks = joined_cells([left, right], ["k"], floor=10, pairs=16)
    assert rows(cells, "k", "__rows0", "__rows1") == [("a", 6, 7), ("c", 20, 0)] and tasks == 3  # 42 and 6 pairs
    salted = cells.select("k", *[s.alias(f"s{n}") for n, s in enumerate(join_salts(10, 16))])
    assert rows(salted, "k", "s0", "s1") == [("a", 2, 2), ("c", 2, 1)]
    assert joined_cells([left, right], ["k"], floor=20, pairs=42) == (None, 2)
    assert joined_cells([left.where("false"), right.where("false")], ["k"]) == (None, 0)


def test_joined_cells_keep_times_whole(spark):
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.sql(f"SELECT CAST('2024-03-31 02:30:00.000001' AS {kind}) AS t FROM range(3)")
        cells, _ = joined_cells([df, df], ["t"], floor=1)
        assert cells.schema["t"].dataType == df.schema["t"].dataType and mark_heavy(df, cells, ["t"]).where("__rows1 = 3").count() == 3


def test_interval_edges_are_inclusive(spark):
    starts = spark.createDataFrame([("k", T0)], "k string, s timestamp_ntz")
    hour = timedelta(hours=1)
    times = [T0 - MICRO, T0, T0 + hour, T0 + hour + MICRO]
    points = spark.createDataFrame([("k", t) for t in times], "k string, p timestamp_ntz")
    assert rows(interval_join(starts, points, "s", "p", "60 minutes", ["k"]), "p") == [(T0,), (T0 + hour,)]


@pytest.mark.parametrize("floor", [0, 30, 10**6])
def test_lookback_join_equals_plain_left_join(spark, floor):
    anchors, points = moments(6, 90, 240, hot=0.4), moments(7, 90, 240, hot=0.4)
    points += points[:20]  # exact copies match separately
    back = timedelta(minutes=30)
    want = []
    for k, t, i in anchors:
        hits = [j for kk, p, j in points if k is not None and kk == k and t - back <= p <= t]
        want += [(i, j) for j in hits] or [(i, None)]
    left = spark.createDataFrame(anchors, "k string, t timestamp_ntz, i int")
    right = spark.createDataFrame(points, "k string, p timestamp_ntz, j int")
    got = lookback_join(left, right, "t", "p", "30 minutes", ["k"], floor)
    assert sorted(((r.i, r.j) for r in got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("floor", [0, 100])
def test_lookback_keeps_identical_anchors(spark, floor):
    left = spark.createDataFrame([("k", T0), ("k", T0)], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("k", T0)], "k string, p timestamp_ntz")
    none = right.where("false")
    assert lookback_join(left, right, "t", "p", "1 hour", ["k"], floor=floor).count() == 2
    assert rows(lookback_join(left, none, "t", "p", "1 hour", ["k"], floor=floor), "p") == [(None,), (None,)]


@pytest.mark.parametrize("floor", [0, 7, 50, 10**6])
def test_first_match_after_equals_brute_force(spark, floor):
    anchors, points = moments(8, 120, 900, hot=0.3), moments(9, 60, 900, hot=0.3)
    reach = timedelta(hours=4)
    want = {}
    for k, t, i in sorted(anchors, key=lambda r: r[2]):
        if k is None or (k, t) in want:
            continue
        hits = sorted((p, j) for kk, p, j in points if kk == k and t <= p <= t + reach)
        want[(k, t)] = (i, *hits[0]) if hits else None
    want = sorted((k, t, *v) for (k, t), v in want.items() if v)
    left = spark.createDataFrame(anchors, "k string, t timestamp_ntz, i int")
    right = spark.createDataFrame(points, "k string, p timestamp_ntz, j int").repartition(3)
    got = first_match_after(left, right, "t", "p", "4 hours", ["k"], floor)
    assert rows(got, "k", "t", "i", "p", "j") == sorted(want, key=repr)


def test_first_match_edges(spark):
    left = spark.createDataFrame([("k", T0, 1), ("k", T0, 2)], "k string, t timestamp_ntz, i int")
    hours = timedelta(hours=4)
    for offset, hit in ((timedelta(0), True), (hours, True), (hours + MICRO, False), (-MICRO, False)):
        right = spark.createDataFrame([("k", T0 + offset, 9)], "k string, p timestamp_ntz, j int")
        got = first_match_after(left, right, "t", "p", "4 hours", ["k"]).collect()
        assert [(r.i, r.j) for r in got] == ([(1, 9)] if hit else [])


@pytest.mark.parametrize("floor", [0, 65, 10**6])
@pytest.mark.parametrize("gap", [None, "15 minutes"])
def test_previous_value_equals_plain_lag(spark, gap, floor):
    data = moments(10, 200, 400, hot=0.3)
    limit = timedelta(minutes=15) if gap else None
    want, last = [], {}
    for k, t, i in sorted(data, key=lambda r: (repr(r[0]), r[1], r[2])):
        before = last.get(k)
        want.append((i, None if before is None or (limit and before[0] < t - limit) else before[1]))
        last[k] = (t, i)
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, i int").repartition(4)
    got = previous_value(df, ["k"], ["t", "i"], "i", "before", gap, floor)
    assert rows(got, "i", "before") == sorted(want, key=repr)


@pytest.fixture
def apart(spark):
    """Small partitions stay apart, so that tests see how rows are spread."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def sizes(df):
    return {r["__slice"]: r["count"] for r in df.groupBy("__slice").count().collect()}


def test_slices_of_a_hot_entity_hold_few_rows(spark):
    # Nine in ten rows lie in one second, every fifth row is there twice.
    timed = "CASE WHEN id % 10 = 0 THEN id * 7200 ELSE 500 END"
    df = spark.range(5000).selectExpr("'hot' AS k", f"timestamp_millis({timed}) AS t", "id").repartition(4)
    df = df.unionAll(spark.sql("SELECT 'hot', CAST(NULL AS TIMESTAMP), 9000L"))
    got = sizes(range_slices(df, ["k"], ["t", "id"], 5001, 200))
    assert sum(got.values()) == 5001 and max(got.values()) <= 400 and len(got) >= 20
    copies = df.unionAll(df.where("id % 5 = 0"))
    got = sizes(range_slices(copies.withColumn("one", F.lit(1)), ["k"], ["one"], 6002, 300))
    assert sum(got.values()) == 6002 and max(got.values()) <= 600  # equal rows are split as well
    found = previous_value(df, ["k"], ["t", "id"], "id", "before", floor=200).orderBy("t", "id").collect()
    assert [r.before for r in found] == [None, *[r.id for r in found[:-1]]]


def test_a_hot_second_is_spread_over_tasks(spark, apart):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'k' || id % 1000 END AS k", "timestamp_millis(7) AS t", "id")
    got = previous_value(df, ["k"], ["t", "id"], "id", "before", floor=100)
    slices = [r["count"] for r in got.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(slices) == 3000 and len(slices) >= 3 and max(slices) < 2000
    last = {}
    for r in sorted(got.collect(), key=lambda r: r.id):
        assert r.before == last.get(r.k)
        last[r.k] = r.id


def test_a_hot_minute_is_spread_and_the_source_read_once(spark, apart, monkeypatch, tmp_path):
    source = spark.range(4000).selectExpr(
        "CASE WHEN id % 2 = 0 OR id < 3000 THEN 'hot' ELSE 'k' || id END AS k", "timestamp_millis(id * 10) AS t", "id",
        "id % 3 = 0 AS a", "id % 40 = 1 AS p",
    )
    source.write.parquet(str(tmp_path / "source"))
    plans, keep = [], intervals.staged

    def watched(df, what):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, what)

    monkeypatch.setattr(intervals, "staged", watched)
    events = spark.read.parquet(str(tmp_path / "source"))
    pair = lambda floor: first_match_among(
        events, "t", F.col("a"), F.col("p"), "t0", "t1", "1 second", ["k"], {"i": F.col("id")}, {"j": F.col("id")}, floor
    )
    got = pair(100)
    assert len(plans) == 1 and plans[0].count("FileScan") == 1
    assert str(tmp_path) not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "k", "t0", "t1", "i", "j") == rows(pair(10**6), "k", "t0", "t1", "i", "j") and got.count() > 500
    tasks = got.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 3


def test_hot_anchors_are_spread_and_missing_keys_pass_by(spark, apart):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        anchors = spark.range(9000).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN 'k' || id END AS k", "timestamp_millis(id % 60000) AS t", "id AS i"
        )
        points = spark.range(40).selectExpr("CASE WHEN id < 5 THEN 'hot' ELSE 'k' || id END AS k", "timestamp_millis(id * 1000) AS p", "id AS j")
        got = lookback_join(anchors, points, "t", "p", "10 minutes", ["k"], floor=100)
        plain = lookback_join(anchors, points, "t", "p", "10 minutes", ["k"])
        assert rows(got, "k", "t", "i", "p", "j") == rows(plain, "k", "t", "i", "p", "j")
        assert got.where("k IS NULL").count() == 3000 and got.where("k IS NULL AND j IS NULL").count() == 3000
        tasks = [r["count"] for r in got.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) >= 3 and max(tasks) < 0.6 * sum(tasks)
        plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
        last = "".join(line for line in plan if not line.startswith((":", "Union")))
        assert "isnull" in last.lower() and "Join" not in last  # rows without a key are a branch of their own
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("heavy_share", [0.2, 1e-5, 1.0])
def test_frequency_lookup_is_exact_for_heavy_and_rare_keys(spark, heavy_share):
    rng = random.Random(11)
    data = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None]), i // 2) for i in range(300)]
    df = spark.createDataFrame(data, "k string, i int").repartition(3)
    table = frequency(df.where("k IS NOT NULL"), "k", "n").withColumn("label", F.concat(F.col("k"), F.lit("!")))
    counts = {k: sum(1 for kk, _ in data if kk == k) for k in {"hot", "a", "b", "c"}}
    want = [(k, i, counts.get(k), None if k is None else k + "!") for k, i in data]
    got = attach_by_frequency(df, table, "k", "n", heavy_share)
    assert rows(got, "k", "i", "n", "label") == sorted(want, key=repr)


def test_frequency_lookup_bounds_its_broadcast(spark):
    df = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError):
        attach_by_frequency(df, frequency(df, "k", "n"), "k", "n", 1e-9)


def test_heavy_cells_of_one_pass(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [(None,)] * 5, "k string")
    other = spark.createDataFrame([("b",)] * 9 + [("c",)], "k string")
    assert rows(heavy_cells([df, other], ["k"], floor=5), "k", "__rows0", "__rows1") == [("a", 6, 0), ("b", 3, 9)]
    assert rows(heavy_cells([df], ["k"], floor=4, nulls=True), "k", "__rows0") == sorted([("a", 6), (None, 5)], key=repr)
    assert rows(heavy_cells([df, other], ["k"], floor=0, most=1), "k") == [("b",)]  # the largest cells come first
    assert heavy_cells([df, other], ["k"], floor=9) is None
    marked = mark_heavy(df, heavy_cells([df], ["k"], floor=4, nulls=True), ["k"])
    assert marked.where("__rows0 IS NOT NULL").count() == 11 and marked.count() == 14


def test_heavy_cells_keep_times_whole(spark):
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.sql(f"SELECT CAST('2024-03-31 02:30:00.000001' AS {kind}) AS t FROM range(3)")
        heavy = heavy_cells([df], ["t"], floor=1)
        assert heavy.schema["t"] == df.schema["t"] and mark_heavy(df, heavy, ["t"]).where("__rows0 = 3").count() == 3


def test_salts_grow_with_rows_and_stay_one_for_ordinary_keys(spark):
    df = spark.createDataFrame([(None,), (0,), (150,), (5000,)], "rows long")
    assert [r.s for r in df.select(salts_of(F.col("rows"), 100).alias("s")).collect()] == [1, 1, 2, 50]


def test_evaluate_counts_and_empty_denominators(spark):
    df = spark.createDataFrame([(2, True), (2, False), (0, True), (0, False)], "score int, label boolean")
    row = evaluate(df, "score", "label").first()
    assert (row.true_positives, row.false_positives, row.false_negatives) == (1, 1, 1)
    assert (row.precision, row.recall, row.f1, row.flagged_rate) == (0.5, 0.5, 0.5, 0.5)
    assert row.true_positives + row.false_negatives == row.malicious_events
    none = evaluate(df.where("score = 0"), "score", "label").first()
    assert none.precision is None and none.recall == 0.0 and none.f1 is None


def test_frequency_lookup_spreads_hot_and_missing_keys(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(40000).selectExpr("CASE WHEN id % 10 < 6 THEN 'hot' WHEN id % 10 < 9 THEN 'k' || id END AS k", "id")
        table = df.where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        got = attach_by_frequency(df, table, "k", "n", 0.5)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "__salt" in plan.split("SortMergeJoin", 1)[1].split("\n")[0].split("LeftOuter")[0]
        spread = got.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in spread) < 2 * 40000 / len(spread) and sum(r["count"] for r in spread) == 40000
        assert got.where("n IS NULL").count() == 4000 and got.where("n = 24000").count() == 24000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_interval_join_splits_either_hot_side(spark):
    for hot in (0, 1):
        left, right = moments(6, 40 if hot else 300, 60, hot=0.9), moments(7, 300 if hot else 40, 60, hot=0.9)
        starts = spark.createDataFrame(left, "k string, s timestamp, i int")
        points = spark.createDataFrame(right, "k string, p timestamp, j int")
        plain = interval_join(starts, points, "s", "p", "30 minutes", ["k"])
        split = interval_join(starts, points, "s", "p", "30 minutes", ["k"], split=True, floor=5)
        assert rows(split, "i", "j") == rows(plain, "i", "j")
