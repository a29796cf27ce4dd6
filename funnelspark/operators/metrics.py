"""Aggregates of the funnel and of calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.numbers import (
    cap,
    clamp_or_zero,
    exact_parts,
    exact_sum,
    exact_total,
    finite_or_null,
    ieee_div,
    micros,
    norm_likelihood,
)
from funnelspark.functions.recode import is_revenue_model

# Ceiling of a revenue rate, limits of one event's revenue, cohort length.
REVENUE_RATE_CEILING = 500_000_000
REVENUE_LIMIT_MICROS = 100_000_000_000
COHORT_DAYS = 7

# Metric names in output order, with the type each has before the final sum.
METRICS = {
    "impressions": "bigint",
    "clicks": "bigint",
    "installs": "bigint",
    "internal_spend": "double",
    "external_spend": "double",
    "customer_revenue_d7": "bigint",
    "target_events_d7": "bigint",
    "target_events_first_d7": "bigint",
    "predicted_conversion_likelihood": "double",
    "preshaded_cpm": "double",
    "private_value": "double",
    "shaded_cpm": "double",
    "predicted_clicks": "double",
    "predicted_installs_ct": "double",
    "predicted_installs_vt": "double",
    "predicted_target_events_ct": "double",
    "predicted_target_events_vt": "double",
    "predicted_customer_revenue_micros_ct": "double",
    "predicted_customer_revenue_micros_vt": "double",
}


def sum_finite(value: str, exact: bool = False) -> str:
    """Sum that skips NaN and ±Infinity; exact, it does not depend on the order of rows."""
    return exact_sum(finite_or_null(value)) if exact else f"sum({finite_or_null(value)})"


def _parts(metric: str) -> list[str]:
    return [f"_{metric}_{i}" for i in range(5)]


def summands(exact: bool) -> dict[str, str]:
    """What is summed for METRICS, as columns by name: the metrics, or the exact parts of those that are doubles."""
    out = {}
    for m, kind in METRICS.items():
        out |= dict(zip(_parts(m), exact_parts(m))) if exact and kind == "double" else {m: m}
    return out


def totals(exact: bool) -> dict[str, str]:
    """METRICS from the sums of `summands`, or of their sums."""
    return {m: exact_total(_parts(m)) if exact and kind == "double" else m for m, kind in METRICS.items()}


def predicted_terms(variant: str, prefix: str = "bid__") -> dict[str, str]:
    """Per-impression terms of the price and prediction metrics; null terms are skipped by sum.

    v2 uses click-based formulas for every ad-group type but user acquisition (also for null)
    and leaves the click-based revenue uncapped; v1 uses the install-based ones throughout.
    """
    data = f"{prefix}price_data__"
    winner = micros(f"{prefix}auction_result__winner__price_cpm_micros")
    click = f"{data}predicted_imp_to_click_rate"
    view_install = f"{data}predicted_imp_to_install_vt_rate"
    installs = (
        f"(coalesce({click} * {data}predicted_click_to_install_rate, 0D)"
        f" + coalesce({data}predicted_imp_to_install_ct_rate, 0D))"
    )
    revenue_rate = cap(f"{data}predicted_install_to_revenue_rate", REVENUE_RATE_CEILING)
    events_ct = f"{installs} * {data}predicted_install_to_preferred_app_event_rate"
    revenue_ct = f"{installs} * {revenue_rate}"
    if variant == "v2":
        when_acquired = f"case when {prefix}ad_group_type = 'user-acquisition' then"
        events_ct = (
            f"{when_acquired} {events_ct} else {click} * {data}predicted_click_to_preferred_app_event_rate end"
        )
        revenue_ct = f"{when_acquired} {revenue_ct} else {click} * {data}predicted_click_to_revenue_rate end"
    elif variant != "v1":
        raise ValueError(f"variant must be v1 or v2, not {variant!r}")
    return {
        "predicted_conversion_likelihood": norm_likelihood(
            f"{data}conversion_likelihood", is_revenue_model(f"{data}model_type")
        ),
        "preshaded_cpm": winner,
        "private_value": ieee_div(winner, f"{data}compensated_margin_bid_multiplier"),
        "shaded_cpm": micros(f"{prefix}price_cpm_micros"),
        "predicted_clicks": click,
        "predicted_installs_ct": installs,
        "predicted_installs_vt": view_install,
        "predicted_target_events_ct": events_ct,
        "predicted_target_events_vt": f"{view_install} * {data}predicted_install_to_preferred_app_event_vt_rate",
        "predicted_customer_revenue_micros_ct": revenue_ct,
        "predicted_customer_revenue_micros_vt": f"{view_install} * {revenue_rate}",
    }


def predicted_metrics(variant: str, prefix: str = "bid__", exact: bool = False) -> list[Column]:
    """Sums of `predicted_terms`, for use in an aggregation over impressions; exact, over their columns."""
    if exact:
        return [F.expr(exact_sum(name)).alias(name) for name in predicted_terms(variant, prefix)]
    return [F.expr(f"sum({sql})").alias(name) for name, sql in predicted_terms(variant, prefix).items()]


def gathered(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt to tasks by key before exact sums of them, those of a hot key to several.

    Exact sums are several times as wide as the rows they are of. Where rows of many keys come mixed, a task would hold
    sums of nearly as many keys as it has rows. Dealt out, it holds those of few, and sends few on.
    """
    return rows.withColumn("_key", F.xxhash64(*keys)).hint("rebalance", "_key").drop("_key")


def revenue_micros(value: str) -> str:
    """One event's revenue; implausible amounts and null count as zero."""
    return clamp_or_zero(value, -REVENUE_LIMIT_MICROS, REVENUE_LIMIT_MICROS)


def target_event_terms(target: str, event: str, first_occurrence: str) -> dict[str, str]:
    """1 for a campaign's target event, and 1 for its first occurrence; null comparisons count 0."""
    return {
        "target_events_d7": f"case when {target} = {event} then 1 else 0 end",
        "target_events_first_d7": f"case when {target} = {event} and {first_occurrence} then 1 else 0 end",
    }


def cohort_value(value: str, inside: str) -> str:
    """The value inside the cohort window, zero outside and where the window is unknown."""
    return f"(case when {inside} then {value} else 0 end)"
