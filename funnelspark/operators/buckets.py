"""Percentile buckets: train per segment, expand to a grid, assign rows to cells."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.text import quoted
from funnelspark.operators.percentiles import exact_cuts, sketch_cuts
from funnelspark.sources.sinks import via_shared_table

# Names of the twelve intervals between the cut points.
LABELS = (
    "0-10", "10-20", "20-30", "30-40", "40-50", "50-60",
    "60-70", "70-80", "80-90", "90-95", "95-99", "99-100",
)

_NAMES = "array(" + ", ".join(quoted(name) for name in LABELS) + ")"


def intervals(cuts: str) -> str:
    """Half-open labelled intervals from zero through the cuts to an open end; null for null cuts."""
    low = f"concat(array(0D), {cuts})"
    high = f"concat({cuts}, array(cast(null as double)))"
    return (
        f"case when {cuts} is not null then cast(arrays_zip({low}, {high}, {_NAMES})"
        " as array<struct<low:double,high:double,name:string>>) end"
    )


def train_buckets(
    df: DataFrame,
    keys: Mapping[str, str],
    axes: Mapping[str, str],
    method: str = "sketch",
    **options,
) -> DataFrame:
    """One row per segment with an interval array per axis, all axes from one pass over the rows.

    `keys` and `axes` map output names to expressions. Segments with a null key, or with no
    usable value on some axis, are left out. The sketch method is randomised: store the result
    (`write_once`) rather than recompute it per use.
    """
    cutter = {"sketch": sketch_cuts, "exact": exact_cuts}[method]
    named = {**keys, **axes}
    rows = df.selectExpr(*[f"{sql} as {name}" for name, sql in named.items()]).dropna(subset=list(keys))
    return segments_from_cuts(cutter(rows, list(keys), {a: a for a in axes}, **options), list(keys), list(axes))


def segments_from_cuts(cuts: DataFrame, keys: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """Interval arrays from cuts per segment; segments without a usable value on some axis are left out."""
    return cuts.dropna(subset=list(axes)).selectExpr(*keys, *[f"{intervals(a)} as {a}" for a in axes])


def bucket_grid(segments: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Every combination of intervals per segment: 12 rows for one axis, 144 for two, 1,728 for three."""
    grid = segments
    for axis in axes:
        kept = [c for c in grid.columns if c != axis]
        grid = grid.selectExpr(
            *kept, f"inline({axis}) as ({axis}_percentile_low, {axis}_percentile_high, {axis}_percentile)"
        )
    return grid


def segments_from_grid(grid: DataFrame, keys: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """The compact form of a stored grid, one row per segment again.

    A segment trained twice would have more than twelve intervals on an axis; that is an error.
    """

    def cells(axis: str) -> str:
        # Tied edges leave the order of intervals to their names.
        cell = (
            f"named_struct('position', array_position({_NAMES}, {axis}_percentile), 'low', {axis}_percentile_low,"
            f" 'high', {axis}_percentile_high, 'name', {axis}_percentile)"
        )
        return f"array_sort(collect_set({cell}))"

    sets = grid.groupBy(*keys).agg(*[F.expr(cells(a)).alias(a) for a in axes])
    wrong = f"bucket table: not {len(LABELS)} intervals on axis "
    return sets.selectExpr(
        *keys,
        *[
            f"case when size({a}) = {len(LABELS)} then transform({a}, c -> struct(c.low, c.high, c.name))"
            f" else raise_error({quoted(wrong + a)}) end as {a}"
            for a in axes
        ],
    )


def _interval_index(value: str, edge: Callable[[int], str], first: int, last: int) -> str:
    """Position of the last interval among first..last whose low edge is at or below value.

    Edges ascend from position 1 on, so halving finds it in four comparisons.
    """
    if first == last:
        return str(first)
    middle = (first + last + 1) // 2
    upper = _interval_index(value, edge, middle, last)
    lower = _interval_index(value, edge, first, middle - 1)
    return f"case when {value} >= {edge(middle)} then {upper} else {lower} end"


def _edge(axis: str, factor: float) -> Callable[[int], str]:
    return lambda i: f"get(_lows_{axis}, {i}) * {float(factor)!r}D" if factor != 1 else f"get(_lows_{axis}, {i})"


def _located(
    facts: DataFrame, segments: DataFrame, keys: Mapping[str, str], axes: Mapping[str, tuple[str, float]], take: Sequence[str]
) -> DataFrame:
    """Rows that have a cell, with its place on each axis and some columns of the small side."""
    small = segments.selectExpr(
        *[f"{k} as _key_{k}" for k in keys],
        *[f"{a}.low as _lows_{a}" for a in axes],
        *[c for c in take if not c.startswith("_lows_")],
    )
    probe = facts.selectExpr(
        "*",
        *[f"{sql} as _probe_{k}" for k, sql in keys.items()],
        *[f"cast({sql} as double) as _value_{a}" for a, (sql, _) in axes.items()],
    )
    edges = {a: _edge(a, factor) for a, (_, factor) in axes.items()}
    same_segment = " and ".join(f"_probe_{k} = _key_{k}" for k in keys)
    # A row has a cell when it reaches the first edge or the first cut, whichever is lower.
    # Null fails every comparison; NaN, which Spark sorts above all, fails the one with Infinity.
    has_cell = " and ".join(
        f"_value_{a} <= double('Infinity') and _value_{a} >= least({edge(0)}, {edge(1)})" for a, edge in edges.items()
    )
    return probe.join(small, F.expr(f"{same_segment} and {has_cell}")).selectExpr(
        *[f"`{c}`" for c in facts.columns],
        *take,
        *[f"{_interval_index(f'_value_{a}', edge, 0, len(LABELS) - 1)} as _index_{a}" for a, edge in edges.items()],
    )


def _named(located: DataFrame, columns: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """Low, high and name per axis from the place and the low edges of the segment."""
    return located.selectExpr(
        *[f"`{c}`" for c in columns],
        *[
            sql
            for a in axes
            for sql in (
                f"get(_lows_{a}, _index_{a}) as {a}_percentile_low",
                f"get(_lows_{a}, _index_{a} + 1) as {a}_percentile_high",
                f"get({_NAMES}, _index_{a}) as {a}_percentile",
            )
        ],
    )


def assign_bucket(
    facts: DataFrame,
    segments: DataFrame,
    keys: Mapping[str, str],
    axes: Mapping[str, tuple[str, float]],
) -> DataFrame:
    """Inner join of rows to their grid cell: adds low, high and name per axis.

    `keys` maps a segment key to the row's expression for it. `axes` maps an axis to the row's
    value and the factor its edges are scaled by before the comparison (the factor goes on the
    edge, not the value: the two round differently). Rows whose segment is not trained, or with
    a null, NaN or below-range value, are dropped.

    The small side has one row per segment, not one per cell, and brings one array of low edges per
    axis (a high edge is the next low one), in which the cell is looked up. Beyond the broadcast threshold Spark sort-merges and splits hot segments at
    run time.
    """
    return _named(_located(facts, segments, keys, axes, [f"_lows_{a}" for a in axes]), facts.columns, list(axes))


def numbered_segments(segments: DataFrame) -> DataFrame:
    """Segments with a number of their own, `_segment`, for `locate_bucket` and `name_bucket`; stored, so that it stays."""
    return via_shared_table(segments.withColumn("_segment", F.monotonically_increasing_id()), "segments")


def locate_bucket(
    facts: DataFrame,
    segments: DataFrame,
    keys: Mapping[str, str],
    axes: Mapping[str, tuple[str, float]],
) -> DataFrame:
    """`assign_bucket` short of the names and edges: adds `_segment`, and `_index_...` per axis, in place of nine columns."""
    return _located(facts, segments, keys, axes, ["_segment"])


def name_bucket(located: DataFrame, segments: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Low, high and name per axis in place of what `locate_bucket` has added; null where that is null."""
    kept = [c for c in located.columns if c not in ("_segment", *[f"_index_{a}" for a in axes])]
    small = segments.selectExpr("_segment as _numbered", *[f"{a}.low as _lows_{a}" for a in axes])
    return _named(located.join(small, F.expr("_segment = _numbered"), "left"), kept, axes)
