"""Bucket edges, the two forms of the lookup, and both percentile methods."""

import random

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import buckets, percentiles
from tests.grid_join import assign_bucket_by_grid

INF, NAN = float("inf"), float("nan")


def segments_of(spark, cuts):
    df = spark.createDataFrame([("s", cuts)], "seg string, cuts array<double>")
    return df.selectExpr("seg", f"{buckets.intervals('cuts')} as axis")


def place(spark, cuts, items, by_grid=False):
    segments = segments_of(spark, cuts)
    facts = spark.createDataFrame([(i, "s", v) for i, v in enumerate(items)], "i int, seg string, v double")
    keys, axes = {"seg": "seg"}, {"axis": ("v", 1.0)}
    if by_grid:
        out = assign_bucket_by_grid(facts, buckets.bucket_grid(segments, ["axis"]), keys, axes)
    else:
        out = buckets.assign_bucket(facts, segments, keys, axes)
    found = {r.i: r.axis_percentile for r in out.collect()}
    return [found.get(i) for i in range(len(items))]


CUTS = [float(i) for i in range(1, 12)]


@pytest.mark.parametrize("by_grid", [False, True])
def test_ascending_cuts(spark, by_grid):
    items = [None, NAN, -1.0, 0.0, 0.5, 1.0, 10.5, 11.0, 99.0, INF]
    want = [None, None, None, "0-10", "0-10", "10-20", "95-99", "99-100", "99-100", "99-100"]
    assert place(spark, CUTS, items, by_grid) == want


@pytest.mark.parametrize("by_grid", [False, True])
def test_tied_cuts_leave_empty_intervals(spark, by_grid):
    assert place(spark, [4.0] * 11, [2.0, 4.0, 8.0], by_grid) == ["0-10", "99-100", "99-100"]


@pytest.mark.parametrize("by_grid", [False, True])
def test_negative_first_cut(spark, by_grid):
    cuts = [-5.0, 3.0] + [float(i) for i in range(4, 13)]
    assert place(spark, cuts, [-6.0, -5.0, 2.0], by_grid) == [None, "10-20", "10-20"]


@pytest.mark.parametrize("seed", range(3))
def test_lookup_equals_range_join(spark, seed):
    """Also: every finite value at or above zero is in exactly one cell."""
    rng = random.Random(seed)
    cuts = sorted(rng.choice([rng.uniform(0, 5), 2.0, 3.0]) for _ in range(11))
    items = [rng.uniform(0, 6) for _ in range(200)] + cuts
    looked_up = place(spark, cuts, items)
    assert looked_up == place(spark, cuts, items, by_grid=True)
    assert None not in looked_up


def test_scaled_edges_round_on_the_edge(spark):
    """Edges are multiplied, values are not divided: some equal values fall below their own cut."""
    n = next(i for i in range(1, 10**6) if (i / 1e6) * 1e6 > i)
    segments = segments_of(spark, [n / 1e6] * 11)
    facts = spark.createDataFrame([("s", n)], "seg string, v bigint")
    keys, axes = {"seg": "seg"}, {"axis": ("v", 1e6)}
    assert buckets.assign_bucket(facts, segments, keys, axes).first().axis_percentile == "0-10"
    grid = buckets.bucket_grid(segments, ["axis"])
    assert assign_bucket_by_grid(facts, grid, keys, axes).first().axis_percentile == "0-10"


def training_rows(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice([1.0, 2.0, rng.random() * 9]), float(rng.randrange(1000))) for _ in range(3000)]
    rows += [("a", NAN, 1.0), ("a", None, None), ("nulls", None, 3.0), (None, 1.0, 1.0)]
    return rows, spark.createDataFrame(rows, "seg string, x double, y double")


def exact_reference(values, p):
    from fractions import Fraction
    from math import ceil

    ordered = sorted(v for v in values if v is not None and v == v)
    return ordered[max(1, ceil(Fraction(str(p)) * len(ordered))) - 1]


def test_exact_cuts_against_sorting(spark):
    rows, df = training_rows(spark)
    named = df.where("seg is not null")
    got = {r.seg: r for r in percentiles.exact_cuts(named, ["seg"], {"x": "x", "y": "y"}).collect()}
    assert set(got) == {"a", "b", "nulls"}
    for seg in "ab":
        for axis, at in (("x", 1), ("y", 2)):
            column = [r[at] for r in rows if r[0] == seg]
            assert got[seg][axis] == [exact_reference(column, p) for p in percentiles.PROBABILITIES]
    assert got["nulls"].x is None


@pytest.mark.parametrize("bins", [2, 512])
def test_exact_cuts_of_values_far_apart(spark, monkeypatch, bins):
    """From the smallest to the largest doubles, both signs, zeros and infinities; few passes with many bins."""
    rng = random.Random(bins)
    edge = [0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, INF, -INF]
    wide = [rng.choice([-1, 1]) * rng.uniform(1, 10) * 10.0 ** rng.randint(-307, 307) for _ in range(400)] + edge * 3
    near = [1.0 + rng.randint(0, 200) * 2.0**-52 for _ in range(300)] + [-1e15 - rng.randint(0, 50) for _ in range(300)]
    rows = [("wide", x, rng.random()) for x in wide] + [("near", x, None) for x in near] + [("one", 7.0, -0.0)]
    passes = []
    real = percentiles.via_shared_table
    monkeypatch.setattr(percentiles, "via_shared_table", lambda df, name: passes.append(name) or real(df, name))
    df = spark.createDataFrame(rows, "_seg string, x double, y double").repartition(3)
    got = {r["_seg"]: r for r in percentiles.exact_cuts(df, ["_seg"], {"x": "x", "y": "y"}, bins=bins).collect()}
    for seg in ("wide", "near", "one"):
        column = [x for s, x, _ in rows if s == seg]
        assert got[seg].x == [exact_reference(column, p) for p in percentiles.PROBABILITIES]
    assert got["near"].y is None and got["one"].y == [0.0] * 11
    assert len(passes) <= (8 if bins == 512 else 64)


def test_exact_cuts_with_one_hot_segment_and_value(spark):
    """Two thirds of the rows share segment and value; ranks still come out exact."""
    rows = [("hot", 7.0)] * 6000 + [("hot", float(i)) for i in range(2000)] + [("cold", 1.0)]
    got = {
        r.seg: r.x
        for r in percentiles.exact_cuts(spark.createDataFrame(rows, "seg string, x double"), ["seg"], {"x": "x"}).collect()
    }
    hot = [v for s, v in rows if s == "hot"]
    assert got["hot"] == [exact_reference(hot, p) for p in percentiles.PROBABILITIES]
    assert got["cold"] == [1.0] * 11


def test_sketch_cuts_within_rank_error(spark):
    n = 40_000
    df = spark.range(n).selectExpr("'s' as seg", "cast((id * 7919) % 40000 as double) as x", "double('NaN') as z")
    row = percentiles.sketch_cuts(df, ["seg"], {"x": "x", "z": "z"}, k=400, salts=3).first()
    assert row.z is None
    for p, cut in zip(percentiles.PROBABILITIES, row.x):
        assert abs(cut / n - p) < 0.02


def test_training_drops_incomplete_segments(spark):
    _, df = training_rows(spark)
    for method in ("exact", "sketch"):
        trained = buckets.train_buckets(df, {"seg": "seg"}, {"x": "x", "y": "y"}, method)
        assert sorted(r.seg for r in trained.collect()) == ["a", "b"]
    with pytest.raises(KeyError):
        buckets.train_buckets(df, {"seg": "seg"}, {"x": "x"}, "other")


def test_grid_size_and_round_trip(spark):
    _, df = training_rows(spark)
    trained = buckets.train_buckets(df, {"seg": "seg"}, {"x": "x", "y": "y"}, "exact")
    grid = buckets.bucket_grid(trained, ["x", "y"])
    assert grid.count() == 2 * 144
    assert grid.columns[1:4] == ["x_percentile_low", "x_percentile_high", "x_percentile"]
    back = buckets.segments_from_grid(grid, ["seg"], ["x", "y"])
    assert sorted(map(repr, back.collect())) == sorted(map(repr, trained.collect()))


def test_segment_trained_twice_is_refused(spark):
    grid = buckets.bucket_grid(segments_of(spark, CUTS), ["axis"])
    twice = grid.unionByName(buckets.bucket_grid(segments_of(spark, [c * 2 for c in CUTS]), ["axis"]))
    with pytest.raises(Exception, match="not 12 intervals"):
        buckets.segments_from_grid(twice, ["seg"], ["axis"]).collect()


def test_null_cuts_give_no_grid_rows(spark):
    df = spark.createDataFrame([("s", None)], "seg string, cuts array<double>")
    grid = buckets.bucket_grid(df.selectExpr("seg", f"{buckets.intervals('cuts')} as axis"), ["axis"])
    assert grid.count() == 0


def test_lookup_join_is_per_segment(spark):
    """The joined side has a row per segment, not per cell."""
    segments = segments_of(spark, CUTS)
    facts = spark.range(10).select(F.lit("s").alias("seg"), F.col("id").cast("double").alias("v"))
    out = buckets.assign_bucket(facts, segments, {"seg": "seg"}, {"axis": ("v", 1.0)})
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 10
