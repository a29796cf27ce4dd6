"""Actual against predicted, suggested and planned revenue over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.operators.metrics import sum_finite

SERIES_KEYS = ["time_bucket", "ab_test_group_ids", "ad_group_id"]


def revenue_calibration(
    results: DataFrame, history: DataFrame, lookback: str, as_of: str = "current_timestamp()"
) -> DataFrame:
    """Revenue sums in units per time bucket, for buckets older than an hour and within `lookback`.

    `lookback` is an interval expression such as `interval '7' day`. Both series are summed per
    join key before they meet, each keeping its row count, and the sums are scaled by the other
    side's count: the same totals as joining row by row, but a key repeated on both sides does
    not multiply rows, and the join reuses the partitioning of the sums.
    """
    in_window = f"time_bucket > {as_of} - {lookback} and time_bucket < {as_of} - interval '1' hour"
    if ("bid_target_micros" in results.columns) == ("bid_target_micros" in history.columns):
        raise ValueError("bid_target_micros must be a column of exactly one of the two series")

    def usable(df: DataFrame, condition: str) -> DataFrame:
        if "bid_target_micros" in df.columns:
            condition += " and bid_target_micros > 0"
        return df.where(f"{in_window} and {condition}")

    actual = (
        usable(history, "enabled and estimated")
        .groupBy(*SERIES_KEYS)
        .agg(F.sum("revenue_micros").alias("actual"), F.count("*").alias("n_history"))
    )
    modelled = (
        usable(results, "suggested_bid_target_micros is not null")
        .groupBy(*SERIES_KEYS)
        .agg(
            F.expr(sum_finite("predicted_revenue_micros")).alias("predicted"),
            F.sum("suggested_revenue_micros").alias("suggested"),
            F.sum("planned_revenue_micros").alias("planned"),
            F.count("*").alias("n_results"),
        )
    )
    totals = {
        "revenue": "actual * n_results",
        "predicted_revenue": "predicted * n_history",
        "suggested_revenue": "suggested * n_history",
        "planned_revenue": "planned * n_history",
    }
    return (
        modelled.join(actual, SERIES_KEYS)
        .groupBy(F.col("time_bucket").alias("time"))
        .agg(*[F.expr(f"cast(sum({sql}) as double) / 1e6D").alias(name) for name, sql in totals.items()])
    )
