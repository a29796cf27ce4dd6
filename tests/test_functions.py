"""Null, NaN, division and boundary rules, with results worked out by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from funnelspark import functions as fx
from funnelspark.functions.numbers import exact_parts, exact_sum, exact_total
from funnelspark.operators import metrics
from tests.helpers import same, values

INF, NAN = float("inf"), float("nan")


def test_cap_keeps_null(spark):
    assert values(spark, "double", [None, 1.0, 5e8, 6e8], fx.cap("x", 500_000_000)) == [None, 1.0, 5e8, 5e8]


def test_ieee_div(spark):
    pairs = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None), (6.0, 3.0), (NAN, 0.0)]
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(pairs)], "i int, n double, d double")
    got = [r.y for r in df.selectExpr("i", f"{fx.ieee_div('n', 'd')} as y").orderBy("i").collect()]
    want = [INF, -INF, NAN, None, None, 2.0, NAN]
    assert all(same(a, b) for a, b in zip(got, want)), got


def test_special_values(spark):
    items = [1.0, NAN, INF, -INF, None]
    assert values(spark, "double", items, fx.is_special("x")) == [False, True, True, True, None]
    df = spark.createDataFrame([(v,) for v in [*items, 2.0]], "x double")
    assert df.selectExpr(f"{metrics.sum_finite('x')} as s").first().s == 3.0


def test_revenue_clamp_is_strict(spark):
    items = [10**11, -(10**11), 10**11 - 1, None, 5]
    assert values(spark, "bigint", items, metrics.revenue_micros("x")) == [0, 0, 10**11 - 1, 0, 5]


def test_micros_and_likelihood(spark):
    assert values(spark, "bigint", [1500000, None], fx.micros("x")) == [1.5, None]
    assert values(spark, "bigint", [1500000000], fx.per_impression("x")) == [1.5]
    assert values(spark, "double", [2e6], fx.norm_likelihood("x", "true")) == [2.0]
    assert values(spark, "double", [2e6], fx.norm_likelihood("x", "cast(null as boolean)")) == [2e6]


def test_recode(spark):
    names = ["VUNGLE", "OTHER_ONE", None]
    assert values(spark, "string", names, fx.exchange_group("x")) == ["VUNGLE", "others", "others"]
    assert values(spark, "string", ["US", "DE", None], fx.country_group("x")) == ["US", "others", "others"]
    formats = ["video", "native", "320x50", "728x90", "300x250", "480x320", None]
    want = ["VAST", "native", "banner", "banner", "mrec", "html-interstitial", "html-interstitial"]
    assert values(spark, "string", formats, fx.ad_format("x")) == want
    assert values(spark, "string", ["video", "native", None], fx.ad_format_group("x")) == ["VAST", "Non-VAST", "Non-VAST"]
    models = ["revenue", "revenue-v3", "install", None]
    assert values(spark, "string", models, fx.model_type("x")) == ["revenue", "revenue", "install", None]


def test_tested_and_emitted_exchange_differ(spark):
    """A listed original exchange lets an unlisted later one through."""
    df = spark.createDataFrame([("VUNGLE", "SMALL"), ("SMALL", "VUNGLE")], "tested string, emitted string")
    got = [r.y for r in df.selectExpr(f"{fx.exchange_group('tested', emit='emitted')} as y").collect()]
    assert got == ["SMALL", "others"]


def test_tracker_type(spark):
    rows = [("apple-skan", 1), ("no-tracker", 1), (None, 1), ("adjust", None), (None, None)]
    df = spark.createDataFrame(rows, "name string, campaign int")
    got = [r.y for r in df.selectExpr(f"{fx.tracker_type('name', 'campaign')} as y").collect()]
    assert got == ["SKAN", "NON-MEASURABLE", "MMP", "N/A", "N/A"]


def test_viewthrough_interstitial_rule_is_dead(spark):
    rows = [
        ("HTML", "html-interstitial", True, True, True, True, False),
        ("HTML", "interstitial", False, False, True, False, True),
        ("VAST", "VAST", True, False, False, False, True),
        ("VAST", "VAST", None, True, True, True, False),
        ("HTML", "mrec", False, True, False, False, True),
        ("NATIVE", "native", False, False, False, True, True),
        (None, "native", False, False, False, None, False),
    ]
    df = spark.createDataFrame(
        rows, "c string, f string, v boolean, b boolean, i boolean, n boolean, want boolean"
    ).selectExpr(f"{fx.viewthrough_enabled('c', 'f', 'v', 'b', 'i', 'n')} as y", "want")
    assert all(r.y is r.want for r in df.collect())
    reachable = values(spark, "string", ["video", "native", "320x50", "300x250", "x", None], fx.ad_format("x"))
    assert "interstitial" not in reachable


def test_names_and_flags(spark):
    assert values(spark, "double", [None, 0.0, 1.0], fx.vio_enrolled("x")) == [False, False, True]
    assert values(spark, "string", [None, "a"], fx.name_or_na("x")) == ["N/A", "a"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_text_ignores_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ms = [1683421234567, 0, None, 1678604400000]
        hours = ["2023-05-07T01:00:00Z", "1970-01-01T00:00:00Z", None, "2023-03-12T07:00:00Z"]
        days = ["2023-05-07T00:00:00Z", "1970-01-01T00:00:00Z", None, "2023-03-12T00:00:00Z"]
        assert values(spark, "bigint", ms, fx.iso_hour("x")) == hours
        assert values(spark, "bigint", ms, fx.iso_day("x")) == days
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hour_range_ends(spark):
    hours = ["2023-05-09T00", "2023-05-09T01", "2023-05-10T00", None]

    def kept(closed):
        return values(spark, "string", hours, fx.hour_range("x", "2023-05-09T00", "2023-05-10T00", closed))

    assert kept("left") == [True, True, False, None]
    assert kept("both") == [True, True, True, None]
    assert kept("neither") == [False, True, False, None]  # the first hour is dropped
    assert kept("right") == [False, True, True, None]
    with pytest.raises(ValueError):
        fx.hour_range("x", "a", "b", "open")


@pytest.mark.parametrize("closed", ["left", "right", "both", "neither"])
@pytest.mark.parametrize("low,high", [("2023-05-09T00", "2023-05-11T00"), ("2023-05-09T05", "2023-05-11T05"), ("2023-05-09T00:00:00Z", "2023-05-11T00:00:00Z")])
def test_day_range_equals_text_comparison(spark, closed, low, high):
    day = 86_400_000
    first = 1683504000000  # 2023-05-08T00:00:00Z
    ms = [first + d * day + offset for d in range(5) for offset in (0, 1, day // 2, day - 1)]
    above = ">=" if closed in ("left", "both") else ">"
    below = "<=" if closed in ("right", "both") else "<"
    text = f"{fx.iso_day('x')} {above} '{low}' and {fx.iso_day('x')} {below} '{high}'"
    assert values(spark, "bigint", ms, fx.day_range("x", low, high, closed)) == values(spark, "bigint", ms, text)


def test_hour_plus():
    assert fx.hour_plus("2023-12-31T23", 1) == "2024-01-01T00"
    assert fx.hour_plus("2024-03-01T00", -1) == "2024-02-29T23"


def test_cohort_gate(spark):
    hour, day = 3_600_000, 86_400_000
    gaps = [-hour, 0, 6 * day + 23 * hour, 7 * day, None]
    inside = fx.in_cohort("x", "0", 7)
    assert values(spark, "bigint", gaps, metrics.cohort_value("9", inside)) == [9, 9, 9, 0, 0]


def test_first_chain_order(spark):
    df = spark.createDataFrame(
        [("a", "r", "i"), (None, "r", "i"), (None, None, "i"), (None, None, None)],
        "attribution_event__click__v string, reeng_click__v string, install__ad_click__v string",
    )
    latest = [r.y for r in df.selectExpr(f"{fx.first_chain('v', fx.LATEST_FIRST)} as y").collect()]
    origin = [r.y for r in df.selectExpr(f"{fx.first_chain('v', fx.ORIGIN_FIRST)} as y").collect()]
    assert latest == ["a", "r", "i", None]
    assert origin == ["i", "i", "i", None]


def test_target_events(spark):
    rows = [(1, 1, True), (1, 1, False), (1, 1, None), (1, 2, True), (None, 1, True)]
    df = spark.createDataFrame(rows, "target int, event int, first boolean")
    terms = metrics.target_event_terms("target", "event", "first")
    sums = df.selectExpr(*[f"sum({sql}) as {name}" for name, sql in terms.items()]).first()
    assert (sums.target_events_d7, sums.target_events_first_d7) == (3, 1)


def test_quoting(spark):
    assert values(spark, "int", [1], fx.quoted("it's a \\ test")) == ["it's a \\ test"]


def test_exact_sums_do_not_depend_on_order_or_grouping(spark):
    r = random.Random(1)
    values = [r.choice([r.uniform(-1, 1) * 10 ** r.randint(-9, 14), 0.1, -0.1, 1e-7 * r.random(), 3.0, None]) for _ in range(20_000)]
    exact, plain = set(), set()
    for parts in (1, 3, 7, 16):
        r.shuffle(values)
        df = spark.createDataFrame([(v, i % 5) for i, v in enumerate(values)], "x double, g int").repartition(parts)
        a, b = df.selectExpr(exact_sum("x"), "sum(x)").first()
        exact.add(a)
        plain.add(b)
        # Sums of the parts' sums are those of the parts.
        names = [f"p{i}" for i in range(5)]
        grouped = df.groupBy("g").agg(*[F.expr(f"sum({sql})").alias(n) for n, sql in zip(names, exact_parts("x"))])
        exact.add(grouped.agg(F.expr(exact_total([f"sum({n})" for n in names]))).first()[0])
    assert exact == {math.fsum(v for v in values if v is not None)} and len(plain) > 1


@pytest.mark.parametrize(
    "values, want",
    [
        ([], None), ([None], None), ([1.0, float("nan")], float("nan")), ([1.0, float("inf"), None], float("inf")),
        ([float("inf"), float("-inf")], float("nan")), ([-5e18, 4e18, -0.3, 0.1], -1e18), ([-0.5, 0.25, None], -0.25), ([-(2.0**-60)], -(2.0**-60)),
    ],
)
def test_exact_sums_of_odd_numbers(spark, values, want):
    got = spark.createDataFrame([(v,) for v in values], "x double").selectExpr(exact_sum("x")).first()[0]
    assert got == want or (want != want and got != got)
