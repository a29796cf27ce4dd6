"""Row-level check of bid economics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.functions.numbers import ieee_div, micros, norm_likelihood, per_impression
from funnelspark.functions.recode import REVENUE_BID_TYPES
from funnelspark.functions.text import quoted_list
from funnelspark.operators.dimensions import attach
from funnelspark.sources.readers import scan_hours
from funnelspark.sources.sinks import limited


def bid_validation(
    impressions: DataFrame,
    ad_groups: DataFrame,
    start: str,
    end: str,
    ad_group_ids: Sequence[int] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Bid, price and margin of each impression of the hours start to end, both included.

    `limit` returns that many arbitrary rows for a look at the data, by `limited`.
    """
    rows = scan_hours(impressions, start, end, closed="both")
    if ad_group_ids is not None:
        rows = rows.where(F.col("bid__ad_group_id").isin(*ad_group_ids))
    rows = attach(rows, ad_groups, {"bid__ad_group_id": "id"}, {"bid_type": "bid_type"})

    data = "bid__price_data__"
    likelihood = norm_likelihood(f"{data}conversion_likelihood", f"bid_type in {quoted_list(REVENUE_BID_TYPES)}")
    winner = per_impression("bid__auction_result__winner__price_cpm_micros")
    multiplier = f"{data}compensated_margin_bid_multiplier"
    columns = {
        "bid__ad_group_id": "bid__ad_group_id",
        "p_cvr": likelihood,
        "bid_target": micros(f"{data}ad_group_cpx_bid_micros"),
        "preshaded_w_multiplier": f"{likelihood} * {data}effective_cpx_bid_micros / 1e6D",
        "preshaded_value": winner,
        "private_value": ieee_div(winner, multiplier),
        "CPM_per_impression": per_impression("bid__price_cpm_micros"),
        "revenue": micros("revenue_micros"),
        "spend": micros("spend_micros"),
        "nrm_by_cal": f"1 - {ieee_div('spend_micros', 'revenue_micros')}",
        "margin_multiplier": f"cast({multiplier} as double)",
        "bid_target_with_multiplier": f"{data}effective_cpx_bid_micros",
    }
    out = rows.selectExpr(*[f"{sql} as {name}" for name, sql in columns.items()])
    return out if limit is None else limited(out, limit)
