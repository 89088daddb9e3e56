import math
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sieveline.functions import clock, hosts, scores


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(column.alias("x")).first()["x"]


def entropy(text):
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


@pytest.mark.parametrize("text", ["", "a", "ab", "aaaa", "stackoverflowcom", "x9-k2.é日本", "$$[[((..**"])
def test_entropy_matches_definition(spark, text):
    assert one(spark, hosts.shannon_entropy(F.col("s")), s=text) == pytest.approx(entropy(text), abs=1e-9)


def test_entropy_of_null_is_null(spark):
    assert one(spark, hosts.shannon_entropy(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "host, base, tld",
    [
        ("a.b.c.example.com", "example.com", "com"),
        (" .WWW.Example.ORG. ", "example.org", "org"),
        ("localhost", None, None),
        ("", None, None),
        ("...", None, None),
    ],
)
def test_base_domain(spark, host, base, tld):
    assert one(spark, hosts.base_domain(F.col("h")), h=host) == base
    assert one(spark, hosts.last_label(hosts.base_domain(F.col("h"))), h=host) == tld


def test_keyword_and_tld(spark):
    assert one(spark, hosts.keyword_hit(F.lit("my-LOGIN.example.com"), ["login", "c++"])) is True
    assert one(spark, hosts.keyword_hit(F.lit("example.com"), ["login", "e.ample"])) is False
    assert one(spark, hosts.keyword_hit(F.lit(None).cast("string"), ["login"])) is False
    assert one(spark, hosts.keyword_hit(F.lit("login"), [])) is False
    assert one(spark, hosts.suspicious_tld(F.lit("xyz"), ["xyz"])) is True
    assert one(spark, hosts.suspicious_tld(F.lit(None).cast("string"), ["xyz"])) is False


@pytest.mark.parametrize("ip, kind", [("10.1.2.3", "internal"), ("101.1.2.3", "external"), ("bad", "external"), (None, "external")])
def test_address_class(spark, ip, kind):
    assert one(spark, hosts.address_class(F.lit(ip).cast("string"))) == kind


@pytest.mark.parametrize(
    "start, seconds, boundaries",
    [(datetime(2024, 1, 1, 0, 0, 59), 1, 1), (datetime(2024, 1, 1), 59, 0), (datetime(2024, 1, 1, 23, 59, 59, 999999), 86400, 1440)],
)
def test_minute_boundaries(spark, start, seconds, boundaries):
    end = start + timedelta(seconds=seconds)
    for kind in ("timestamp", "timestamp_ntz"):
        col = clock.minute_boundaries(F.col("a").cast(kind), F.col("b").cast(kind))
        assert one(spark, col, a=start, b=end) == boundaries


def test_span_is_exact_over_days(spark):
    start, end = datetime(2024, 2, 28, 23, 0, 0, 1), datetime(2024, 3, 2, 1, 30, 0, 2)
    assert one(spark, clock.span_seconds(F.col("a"), F.col("b")), a=start, b=end) == pytest.approx(
        (end - start).total_seconds(), abs=1e-6
    )
    assert one(spark, clock.span_hours(F.col("b"), F.col("a")), a=start, b=end) < 0


@pytest.mark.parametrize(
    "ts, inside",
    [
        (datetime(2024, 3, 1, 17, 59), True),   # Friday
        (datetime(2024, 3, 1, 18, 0), False),
        (datetime(2024, 3, 3, 10, 0), False),   # Sunday
        (datetime(2024, 3, 4, 9, 0), True),     # Monday
        (datetime(2024, 3, 4, 8, 59), False),
    ],
)
def test_business_hours(spark, ts, inside):
    assert one(spark, clock.business_hours(F.col("t")), t=ts) is inside


def test_weekday_counts_from_sunday(spark):
    assert [one(spark, clock.weekday_sunday0(F.col("t")), t=datetime(2024, 3, d)) for d in (3, 4, 9)] == [0, 1, 6]


def test_tier_and_band(spark):
    steps = [(10, 3), (5, 2)]
    assert [one(spark, scores.tier(F.lit(v), steps, 1)) for v in (10, 9, 5, 4)] == [3, 2, 2, 1]
    assert one(spark, scores.tier(F.lit(None).cast("int"), steps, 1)) == 1
    assert one(spark, scores.band(F.lit(39), [(70, "high"), (40, "medium")], "low")) == "low"


def test_ratios_and_clamp(spark):
    assert one(spark, scores.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, scores.ratio(F.lit(2), F.lit(3), 2)) == 0.67
    assert one(spark, scores.positive_ratio(F.lit(0), F.lit(0), 3)) is None
    assert [one(spark, scores.clamp01(F.lit(v))) for v in (-1.0, 0.5, 2.0)] == [0.0, 0.5, 1.0]
    assert one(spark, scores.f1_score(F.lit(0.0), F.lit(0.0))) == 0.0
    assert one(spark, scores.f1_score(F.lit(None).cast("double"), F.lit(0.5))) is None


@pytest.mark.parametrize("text, value", [(" 3.5 ", 3.5), ("", None), ("x", None), ("-2", -2.0), (None, None)])
def test_lenient_double(spark, text, value):
    assert one(spark, scores.lenient_double(F.lit(text).cast("string"))) == value


@pytest.mark.parametrize("text, value", [("5d", None), ("5f", None), ("0x1p3", None), ("-1.5e3", -1500.0), (".5", 0.5), ("7.", 7.0), ("1 2", None)])
def test_lenient_double_takes_plain_numbers_only(spark, text, value):
    assert one(spark, scores.lenient_double(F.lit(text).cast("string"))) == value


@pytest.mark.parametrize("host", ["a.Example.com\n", "\ta.example.com.", "\r\n .a.example.com\x0b", "a.example.com\xa0"])
def test_hosts_lose_all_white_space(spark, host):
    assert one(spark, hosts.base_domain(F.lit(host))) == "example.com"
