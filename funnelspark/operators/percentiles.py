"""Cut points of several values per segment, without gathering a segment in one task.

Both methods return one row per segment: the key columns and, per axis, an array of doubles,
one per probability (null when the segment has no usable value). NaN and null are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.sources.sinks import shuffles_released, via_shared_table

# The eleven probabilities every bucket table is cut at.
PROBABILITIES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99)


def _usable(value: str) -> str:
    v = f"cast({value} as double)"
    return f"case when not isnan({v}) then {v} end"


def sketches(df: DataFrame, keys: Sequence[str], axes: Mapping[str, str], k: int = 4096, salts: int = 256) -> DataFrame:
    """Keys and, per axis, a bounded-size quantile sketch as binary; `merged_cuts` reads cuts off any number of them.

    Each task folds its rows into one sketch per segment before the shuffle. The sketches of a
    segment are then merged in two steps, first spread over `salts` reducers, so that a segment
    with a third of all rows does not end in one reducer that merges a sketch from every task.
    """
    return (
        df.selectExpr(*keys, *[f"{_usable(v)} as {a}" for a, v in axes.items()])
        .groupBy(*keys, F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
        .agg(*[F.kll_sketch_agg_double(a, k).alias(a) for a in axes])
        .groupBy(*keys)
        .agg(*[F.kll_merge_agg_double(a, k).alias(a) for a in axes])
    )


def _cuts(merged: DataFrame, keys: Sequence[str], axes: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    wanted = ", ".join(f"{float(p)!r}D" for p in probabilities)
    return merged.selectExpr(
        *keys,
        *[
            f"case when kll_sketch_get_n_double({a}) > 0"
            f" then kll_sketch_get_quantile_double({a}, array({wanted})) end as {a}"
            for a in axes
        ],
    )


def merged_cuts(
    stored: DataFrame, keys: Sequence[str], axes: Sequence[str], probabilities: Sequence[float] = PROBABILITIES, k: int = 4096
) -> DataFrame:
    """Approximate cuts per key from stored sketches, several of them to a key."""
    return _cuts(stored.groupBy(*keys).agg(*[F.kll_merge_agg_double(a, k).alias(a) for a in axes]), keys, axes, probabilities)


def sketch_cuts(
    df: DataFrame,
    keys: Sequence[str],
    axes: Mapping[str, str],
    probabilities: Sequence[float] = PROBABILITIES,
    k: int = 4096,
    salts: int = 256,
) -> DataFrame:
    """Approximate cuts from `sketches`; rank error about 0.1 % at the default k."""
    return _cuts(sketches(df, keys, axes, k, salts), keys, list(axes), probabilities)


#: Values are told apart by class before anything is divided: -Infinity, below zero, zero, above zero, Infinity.
_CLASS = "case when v = double('-Infinity') then 0 when v < 0 then 1 when v = 0 then 2 when v < double('Infinity') then 3 else 4 end"


def _bin(bins: int) -> str:
    """Place of v between low and high, both of one sign: by logarithm where they are far apart, else linear.

    It never falls as v grows, and low and high themselves come in different bins.
    """
    far_up, far_down = "(low > 0 and high / low > 16)", "(high < 0 and low / high > 16)"
    share = (
        f"case when {far_up} then (ln(v) - ln(low)) / (ln(high) - ln(low))"
        f" when {far_down} then 1 - (ln(-v) - ln(-high)) / (ln(-low) - ln(-high))"
        " else (v - low) / (high - low) end"
    )
    return f"cast(case when v = high then {bins - 1} else least(greatest(floor(({share}) * {bins}), 0), {bins - 1}) end as int)"


def _narrowed(bins: DataFrame, group: Sequence[str], place: str, within: Sequence[str] = ()) -> DataFrame:
    """Of bins (n, low, high, and before and ranks of their range), those that hold a wanted rank, as ranges.

    `within` tells the ranges of a group apart.
    """
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*group, *within).orderBy(place))
    kept = bins.withColumn("upto", upto).withColumn("first", F.col("upto") - F.col("n"))
    inside = "filter(ranks, r -> r.rank > first and r.rank <= upto)"
    return kept.selectExpr(*group, "low", "high", "first as before", f"{inside} as ranks").where("size(ranks) > 0")


def exact_cuts(
    df: DataFrame,
    keys: Sequence[str],
    axes: Mapping[str, str],
    probabilities: Sequence[float] = PROBABILITIES,
    bins: int = 512,
) -> DataFrame:
    """Exact discrete percentiles: the smallest value whose cumulative share reaches the probability.

    By selection. Rows are counted by value range, the ranges that hold a wanted rank are divided again, and
    so on until each holds one value, three or four times for prices. Every pass reads the rows and shuffles
    histograms only: a count, least and largest value for each bin that a task has met, so the shuffle does
    not depend on the number of rows or of distinct values, and a hot segment is folded where it is read.
    A pass's histograms are removed once they are read. The ranges of a segment, eleven to an axis at
    most, are joined to the rows; while they are under the broadcast threshold no row moves. Rows without a value give nothing; key columns must not be null.
    """
    keys, names = list(keys), list(axes)
    group = [*keys, "axis"]
    rows = df.selectExpr(*keys, *[f"{_usable(axes[a])} as `_v{i}`" for i, a in enumerate(names)])
    values = ", ".join(f"named_struct('axis', {i}, 'v', `_v{i}`)" for i in range(len(names)))
    classes = (
        rows.selectExpr(*keys, f"inline(array({values}))")
        .where("v is not null")
        .groupBy(*group, F.expr(_CLASS).alias("class"))
        .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    ranks = ", ".join(
        f"named_struct('point', {i}, 'rank', cast(ceil(cast(total as decimal(20,0)) * {Decimal(str(p))}BD) as bigint))"
        for i, p in enumerate(probabilities)
    )
    whole = Window.partitionBy(*group)
    classes = classes.withColumn("total", F.sum("n").over(whole)).selectExpr("*", "0L as before", f"array({ranks}) as ranks")
    spark = df.sparkSession
    with shuffles_released(spark):
        ranges = via_shared_table(_narrowed(classes, group, "class"), "ranges")
    found = [ranges.where("low = high")]
    while not ranges.where("low < high").isEmpty():
        ranges = ranges.where("low < high")
        lists = ranges.groupBy(*keys).agg(
            *[F.expr(f"collect_list(struct(low, high)) filter (where axis = {i})").alias(f"_r{i}") for i in range(len(names))]
        )
        # The one range of its axis that a value is in, if any.
        hits = ", ".join(
            f"named_struct('axis', {i}, 'v', `_v{i}`, 'r', get(filter(`_r{i}`, r -> `_v{i}` >= r.low and `_v{i}` <= r.high), 0))" for i in range(len(names))
        )
        met = rows.join(lists, keys).selectExpr(*keys, f"inline(filter(array({hits}), h -> h.r is not null))")
        binned = met.selectExpr(*group, "v", "r.low as low", "r.high as high").selectExpr(*group, "low as _low", f"{_bin(bins)} as bin", "v")
        # Numbers only, so that tasks fold rows in a hash table; with an array among them Spark would sort all rows.
        counts = binned.groupBy(*group, "_low", "bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        counts = counts.join(ranges.select(*group, F.col("low").alias("_low"), "before", "ranks"), [*group, "_low"])
        with shuffles_released(spark):
            ranges = via_shared_table(_narrowed(counts, group, "bin", ["_low"]), "ranges")
        found.append(ranges.where("low = high"))
    points = reduce(DataFrame.unionByName, found).selectExpr(*group, "low as value", "inline(ranks)")
    lists = points.groupBy(*keys).agg(
        *[
            F.expr(f"array_sort(collect_list(case when axis = {i} then struct(point, value) end))").alias(a)
            for i, a in enumerate(names)
        ]
    )
    return lists.selectExpr(*keys, *[f"case when size({a}) > 0 then {a}.value end as {a}" for a in names])
