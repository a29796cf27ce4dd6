"""Hourly platform health: the funnel, gated to its seven-day cohort, with dimensions attached.

One shuffle carries the whole job while dimensions are under the broadcast threshold. The funnel is
summed per group key; what is known of a campaign is joined among dimensions first, so that the sums
meet four dimensions at most; CRM rows that agree are attached once, with their number; and the second sum, needed because joins may repeat rows, groups by a
superset of the keys the rows are already partitioned on. A dimension over the threshold costs one
shuffle of the sums, over which the rows of a hot campaign, customer or app are spread; several large ones, too,
cost that one, and the second sum needs no other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.functions import recode
from funnelspark.functions.numbers import micros
from funnelspark.functions.times import hour_plus, in_cohort
from funnelspark.operators.buckets import name_bucket, numbered_segments
from funnelspark.operators.dimensions import DEALT, attach_all, campaign_dimension, crm_campaign_v1, crm_campaign_v2, primary_goal
from funnelspark.operators.funnel import BUCKET_AXES, BUCKET_PLACES, KEYS, format_hours, funnel_rows, key_names
from funnelspark.operators.metrics import COHORT_DAYS, METRICS, cohort_value, summands, totals
from funnelspark.sources.sinks import shuffles_released, via_shared_table

COHORT_METRICS = ("customer_revenue_d7", "target_events_d7", "target_events_first_d7")
VIEWTHROUGH_FLAGS = {
    f"{kind}_viewthrough_enabled": f"_{kind}_vt" for kind in ("video", "banner", "interstitial", "native")
}


def _gate_cohort(rows: DataFrame) -> DataFrame:
    """Zero the down-funnel measures of events seven or more days after their anchor.

    The anchor is the click for re-engagement and the install otherwise. Everything the test
    reads is a group key, so testing rows gives what testing their sums would.
    """
    anchor = "(case when ad_group_type = 'reengagement' then click_at else install_at end)"
    inside = in_cohort("at", anchor, COHORT_DAYS)
    return replaced(rows, {m: cohort_value(m, inside) for m in COHORT_METRICS})


def _edges_in_units(rows: DataFrame) -> DataFrame:
    """Edges of revenue models are stored in millionths and reported in units."""
    edges = ("convx_percentile_low", "convx_percentile_high")
    return replaced(rows, {e: f"case when model_type = 'revenue' then {micros(e)} else {e} end" for e in edges})


_BY_CAMPAIGN = {"campaign_id": "campaign_id"}
VIEWTHROUGH = recode.viewthrough_enabled("creative_type", "ad_format", *VIEWTHROUGH_FLAGS.values())


def _first_sums(rows: DataFrame, keys: Sequence[str], exact: bool) -> DataFrame:
    """Sums per group key: one row per key of any dimension."""
    return rows.groupBy(*keys).agg(*[F.expr(f"sum({sql})").alias(name) for name, sql in summands(exact).items()])


def _report(enriched: DataFrame, keys: Sequence[str], derived: Mapping[str, str], exact: bool) -> DataFrame:
    """Second sum, per group key and dimension; revenue from micros to units."""
    added = list(summands(exact))
    repeated = [f"{m} * coalesce(_times, 1L) as {m}" for m in added]
    dealt = [c for c in DEALT if c in enriched.columns]  # sums of one group have these in common
    keyed = enriched.selectExpr(*dealt, *keys, *[f"{sql} as {name}" for name, sql in derived.items()], *repeated)
    if not exact:
        sums = [F.expr(f"sum({micros(m) if m == 'customer_revenue_d7' else m})").alias(m) for m in METRICS]
        return format_hours(keyed.groupBy(*dealt, *keys, *derived).agg(*sums).drop(*dealt))
    sums = keyed.groupBy(*dealt, *keys, *derived).agg(*[F.sum(m).alias(m) for m in added])
    put_together = {m: micros(sql) if m == "customer_revenue_d7" else sql for m, sql in totals(exact).items()}
    return format_hours(sums.selectExpr(*keys, *derived, *[f"{sql} as {m}" for m, sql in put_together.items()]))


def _stored_campaigns(*arguments) -> DataFrame:
    """Written first: Spark then knows its size when it plans the join, which a chain of joins hides."""
    with shuffles_released(arguments[0].sparkSession):
        return via_shared_table(campaign_dimension(*arguments), "campaigns")


def _folded(crm: DataFrame) -> DataFrame:
    """CRM rows that agree in all columns as one, and their number, by which sums are multiplied where it is attached."""
    return crm.groupBy(*crm.columns).agg(F.count("*").alias("_times"))


def replaced(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{columns[c]} as {c}" if c in columns else c for c in df.columns])


def _hours(hour: str, until: str | None) -> tuple[str, str]:
    return hour, until or hour_plus(hour, 1)


def platform_health_v1(
    tables: Mapping[str, DataFrame],
    segments: DataFrame,
    hour: str,
    until: str | None = None,
    as_of: str = "current_timestamp()",
    goal_tiebreak: Sequence[str] = ("type", "target_value"),
    exact: bool = False,
) -> DataFrame:
    """Funnel with bucket axes: 44 dimensions, 19 metrics, for one hour (or [hour, until)).

    Small dimension joins run, and are stored, when this is called. `segments` is the trained table in
    compact form (`train_segments_v1`, or a stored grid through `segments_from_grid`). Matched events
    without a bucket are not reported. With `exact`, sums of doubles are those of `exact_sum`: two runs
    of an hour agree to the last bit.
    """
    start, end = _hours(hour, until)
    keys = key_names("v1")
    f = _first_sums(_edges_in_units(_gate_cohort(funnel_rows(tables, start, end, "v1", segments))), keys, exact)

    def located() -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
        """The same sums by place on the axes, and the names and edges when the sums have been moved."""
        numbered = numbered_segments(segments)
        rows = _gate_cohort(funnel_rows(tables, start, end, "v1", numbered, named=False))
        sums = _first_sums(rows, [*KEYS, *BUCKET_PLACES], exact)
        return sums, list(KEYS), lambda df: _edges_in_units(name_bucket(df, numbered, BUCKET_AXES))

    crm = _folded(crm_campaign_v1(tables["crm_campaigns"], tables["campaigns"], as_of))
    campaign = _stored_campaigns(
        tables["campaigns"],
        [
            (tables["trackers"], {"_tracker_id": "id"}, {"name": "_tracker"}),
            (primary_goal(tables["goals"], goal_tiebreak), _BY_CAMPAIGN, {"type": "_goal", "target_value": "_goal_value"}),
            (tables["treasurer_configs"], _BY_CAMPAIGN, {"target": "_treasurer"}),
            (crm, _BY_CAMPAIGN, {"sales_region": "_region", "sales_sub_region": "_sub_region", "service_level": "_service", "_times": "_times"}),
        ],
        {"display_name": "_campaign_name", "current_optimization_state": "_optimization", "vt_cap": "_vt_cap", "tracker_id": "_tracker_id"},
    )
    ad_group = {"display_name": "_ad_group", "exploratory": "_exploratory", "bid_type": "_bid_type"}
    f = attach_all(
        f,
        [
            (tables["customers"], {"customer_id": "id"}, {"company": "_company"}),
            (tables["apps"], {"dest_app_id": "id"}, {"display_name": "_app", **VIEWTHROUGH_FLAGS}),
            (tables["ad_groups"], {"ad_group_id": "id"}, ad_group),
            (campaign, _BY_CAMPAIGN, {c: c for c in campaign.columns if c not in ("campaign_id", "_tracker_id")}),
        ],
        located,
    )
    report = _report(
        f,
        keys,
        {
            "service_level": "_service",
            "customer_name": "_company",
            "dest_app_name": "_app",
            "campaign_name": "_campaign_name",
            "campaign_tracker": recode.name_or_na("_tracker"),
            "campaign_tracker_type": recode.tracker_type("_tracker", "campaign_id"),
            "current_optimization_state": "_optimization",
            "campaign_sales_region": "_region",
            "campaign_sales_sub_region": "_sub_region",
            "goal_type_3": "_goal",
            "goal_3_value": "_goal_value",
            "treasurer_target": "_treasurer",
            "ad_group_name": "_ad_group",
            "exploratory_ad_group": "_exploratory",
            "ad_group_bid_type": "_bid_type",
            "viewthrough_enabled": VIEWTHROUGH,
            "is_enrolled_in_vio": recode.vio_enrolled("_vt_cap"),
        },
        exact,
    )
    # Column order of the report: name before edges on the price axes.
    order = [c for c in report.columns if not c.startswith(("private_cpm_percentile", "cpm_percentile"))]
    at = order.index("convx_percentile_high") + 1
    price = [f"{axis}_percentile{end}" for axis in ("private_cpm", "cpm") for end in ("", "_low", "_high")]
    return report.select(*order[:at], *price, *order[at:])


def platform_health_v2(
    tables: Mapping[str, DataFrame],
    hour: str,
    until: str | None = None,
    as_of: str = "current_timestamp()",
    goal_tiebreak: Sequence[str] = ("type", "target_value"),
    exact: bool = False,
) -> DataFrame:
    """Funnel without buckets, ad groups, exchanges and countries: 28 dimensions, 19 metrics.

    Small dimension joins run, and are stored, when this is called. The click hour serves the cohort
    test only, so it is dropped before the first sum. `exact` as in the first report.
    """
    start, end = _hours(hour, until)
    keys = [k for k in key_names("v2") if k != "click_at"]
    f = _first_sums(_gate_cohort(funnel_rows(tables, start, end, "v2")), keys, exact)

    crm = crm_campaign_v2(tables["crm_campaigns"], tables["crm_opportunities"], tables["campaigns"], as_of)
    crm = via_shared_table(_folded(crm), "crm-campaigns")
    campaign = _stored_campaigns(
        tables["campaigns"],
        [
            (tables["campaign_types"], {"_type_id": "id"}, {"name": "_campaign_type"}),
            (tables["trackers"], {"_tracker_id": "id"}, {"name": "_tracker"}),
            (primary_goal(tables["goals"], goal_tiebreak), _BY_CAMPAIGN, {"type": "_goal", "target_value": "_goal_value"}),
        ],
        {
            "display_name": "_campaign_name",
            "current_optimization_state": "_optimization",
            "campaign_type_id": "_type_id",
            "tracker_id": "_tracker_id",
        },
    )
    sold = {"service_level": "_service", "sales_region": "_region", "sales_sub_region": "_sub_region", "scale_zone": "_zone", "_times": "_times"}
    app = {"display_name": "_app", "category": "_category", **VIEWTHROUGH_FLAGS}
    f = attach_all(
        f,
        [
            (tables["customers"], {"customer_id": "id"}, {"company": "_company"}),
            (tables["apps"], {"dest_app_id": "id", "customer_id": "customer_id"}, app),
            (campaign, _BY_CAMPAIGN, {c: c for c in campaign.columns if c not in ("campaign_id", "_type_id", "_tracker_id")}),
            (crm, {"campaign_id": "campaign_id", "customer_id": "customer_id"}, sold),
        ],
    )
    return _report(
        f,
        keys,
        {
            "service_level": "_service",
            "customer_name": "_company",
            "dest_app_name": "_app",
            "dest_app_category": "_category",
            "campaign_sales_region": "_region",
            "campaign_sales_sub_region": "_sub_region",
            "scale_zone": "_zone",
            "current_optimization_state": "_optimization",
            "campaign_name": "_campaign_name",
            "campaign_type": "_campaign_type",
            "goal_type_3": "_goal",
            "goal_3_value": "_goal_value",
            "campaign_tracker_type": recode.tracker_type("_tracker", "campaign_id"),
            "viewthrough_enabled": VIEWTHROUGH,
        },
        exact,
    )
