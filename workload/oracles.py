"""SQL counterparts of the queries, for DuckDB over views named like the given tables.

Written apart from the library: row-level unions and single-level aggregation, plain interval
joins, `quantile_disc`, text comparison of hours.
"""

from __future__ import annotations

from workload.queries import (
    BACKFILL,
    SKETCHED,
    AS_OF,
    CALIBRATION_AS_OF,
    CALIBRATION_DAYS,
    CHECKED_HOURS,
    CHECKED_IDS,
    END,
    EVENT_HOUR,
    IMPRESSION_HOUR,
    START,
    TRAINING,
    WEEK,
    large_sum_digits,
    metric_digits,
)
from workload.tables import duckdb_select

ORACLES: dict[str, str] = {}

# Listed exchanges, names of the intervals, probabilities of the cuts.
_LISTED = "('VUNGLE','APPLOVIN','INNERACTIVE_DIRECT','DOUBLECLICK','MINTEGRAL','IRONSOURCE','UNITY','APPODEAL','INMOBI','VERVE')"
_LABELS = "['0-10','10-20','20-30','30-40','40-50','50-60','60-70','70-80','80-90','90-95','95-99','99-100']"
_P = "[0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,0.95,0.99]"


def _with(*names: str) -> str:
    return "with " + ", ".join(f"{n} as ({duckdb_select(n)})" for n in names)


def exchange(x: str, emit: str | None = None) -> str:
    return f"case when {x} in {_LISTED} then {emit or x} else 'others' end"


def country(x: str) -> str:
    return f"case when {x} in ('US','GB','IN','JP','BR') then {x} else 'others' end"


def fmt(x: str) -> str:
    return (
        f"case {x} when 'video' then 'VAST' when 'native' then 'native' when '320x50' then 'banner'"
        f" when '728x90' then 'banner' when '300x250' then 'mrec' else 'html-interstitial' end"
    )


def vast(x: str) -> str:
    return f"if({x} = 'video', 'VAST', 'Non-VAST')"


def model(x: str) -> str:
    return f"if({x} = 'revenue-v3', 'revenue', {x})"


def hour(ms: str) -> str:
    return f"strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT%H:00:00Z')"


def day(ms: str) -> str:
    return f"strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT00:00:00Z')"


def capped(x: str) -> str:
    return f"if({x} is null, null, least({x}, 5e8))"


# --- scans, predicates, scalar functions ---------------------------------------------------

_LO, _HI = "'1997-01-01T01'", "'2000-01-01T03'"
ORACLES["hour_range_scan"] = f"""
{_with("impressions")}
select bid__app_platform as platform,
  count(*) filter (where dt >= {_LO} and dt < {_HI}) as n_left,
  count(*) filter (where dt > {_LO} and dt <= {_HI}) as n_right,
  count(*) filter (where dt between {_LO} and {_HI}) as n_both,
  count(*) filter (where dt > {_LO} and dt < {_HI}) as n_neither,
  count(*) filter (where {day('"at"')} > '1997-01-01T00' and {day('"at"')} < '2000-01-01T00') as n_day_open,
  count(*) filter (where {day('"at"')} >= '1997-01-01T05' and {day('"at"')} <= '2000-01-01T05') as n_day_shifted
from impressions group by 1
"""

ORACLES["iso_hour_counts"] = f"""
{_with("matched_app_events")}
select {hour("event_timestamp")} as "hour", any_value({day("event_timestamp")}) as "day", count(*) as n
from matched_app_events group by 1
"""

ORACLES["recode_dims"] = f"""
{_with("impressions")}
select {exchange("bid__bid_request__exchange")} as exchange_group,
  {country("bid__bid_request__device__geo__country")} as country_group,
  {fmt("bid__creative__ad_format")} as ad_format,
  {vast("bid__creative__ad_format")} as ad_format_group,
  {model("bid__price_data__model_type")} as model_type,
  count(*) as n
from impressions group by all
"""

ORACLES["bid_economics"] = f"""
{_with("impressions", "ad_groups")},
rows as (
  select f.*, if(g.bid_type in ('cpr', 'cprv3'), bid__price_data__conversion_likelihood / 1000000,
      bid__price_data__conversion_likelihood) as p,
    cast(bid__auction_result__winner__price_cpm_micros as double) / 1e9 as winner
  from impressions f left join ad_groups g on g.id = f.bid__ad_group_id)
select bid__ad_group_id, p as p_cvr,
  bid__price_data__ad_group_cpx_bid_micros / 1e6 as bid_target,
  p * bid__price_data__effective_cpx_bid_micros / 1e6 as preshaded_w_multiplier,
  winner as preshaded_value,
  winner / bid__price_data__compensated_margin_bid_multiplier as private_value,
  bid__price_cpm_micros / 1e9 as CPM_per_impression,
  revenue_micros / 1e6 as revenue,
  spend_micros / 1e6 as spend,
  1 - cast(spend_micros as double) / cast(revenue_micros as double) as nrm_by_cal,
  bid__price_data__compensated_margin_bid_multiplier as margin_multiplier,
  bid__price_data__effective_cpx_bid_micros as bid_target_with_multiplier
from rows
"""

# --- aggregates ----------------------------------------------------------------------------

_D = "bid__price_data__"
_INSTALLS = (
    f"(coalesce({_D}predicted_imp_to_click_rate * {_D}predicted_click_to_install_rate, 0.0)"
    f" + coalesce({_D}predicted_imp_to_install_ct_rate, 0.0))"
)


def _terms(variant: str) -> dict[str, str]:
    events = f"{_INSTALLS} * {_D}predicted_install_to_preferred_app_event_rate"
    revenue = f"{_INSTALLS} * {capped(_D + 'predicted_install_to_revenue_rate')}"
    if variant == "v2":
        acquisition = "bid__ad_group_type = 'user-acquisition'"
        click = f"{_D}predicted_imp_to_click_rate"
        events = f"if({acquisition}, {events}, {click} * {_D}predicted_click_to_preferred_app_event_rate)"
        revenue = f"if({acquisition}, {revenue}, {click} * {_D}predicted_click_to_revenue_rate)"
    return {
        "predicted_conversion_likelihood": (
            f"if({_D}model_type in ('revenue', 'revenue-v3'), {_D}conversion_likelihood / 1e6, {_D}conversion_likelihood)"
        ),
        "preshaded_cpm": "bid__auction_result__winner__price_cpm_micros / 1e6",
        "private_value": f"bid__auction_result__winner__price_cpm_micros / 1e6 / {_D}compensated_margin_bid_multiplier",
        "shaded_cpm": "bid__price_cpm_micros / 1e6",
        "predicted_clicks": f"{_D}predicted_imp_to_click_rate",
        "predicted_installs_ct": _INSTALLS,
        "predicted_installs_vt": f"{_D}predicted_imp_to_install_vt_rate",
        "predicted_target_events_ct": events,
        "predicted_target_events_vt": (
            f"{_D}predicted_imp_to_install_vt_rate * {_D}predicted_install_to_preferred_app_event_vt_rate"
        ),
        "predicted_customer_revenue_micros_ct": revenue,
        "predicted_customer_revenue_micros_vt": (
            f"{_D}predicted_imp_to_install_vt_rate * {capped(_D + 'predicted_install_to_revenue_rate')}"
        ),
    }


for _variant in ("v1", "v2"):
    ORACLES[f"predicted_metrics_{_variant}"] = f"""
{_with("impressions")}
select bid__campaign_id, bid__app_platform, bid__ad_group_type, bid__creative__type,
  {", ".join(f"round(sum({sql}), {large_sum_digits(name)}) as {name}" for name, sql in _terms(_variant).items())}
from impressions group by all
"""

ORACLES["finite_sum"] = f"""
{_with("ad_group_results")}
select ad_group_id,
  round(sum(predicted_revenue_micros) filter (where isfinite(predicted_revenue_micros)), 2) as finite_revenue,
  count(*) filter (where isnan(predicted_revenue_micros) or isinf(predicted_revenue_micros)) as n_special,
  count(*) as n
from ad_group_results group by 1
"""


def revenue(x: str) -> str:
    return f"if(abs({x}) < 100000000000, {x}, 0)"


ORACLES["clamp_revenue"] = f"""
{_with("matched_app_events")}
select custom_event_id, is_viewthrough,
  cast(sum({revenue("customer_revenue_micros")}) as bigint) as revenue_micros, count(*) as n
from matched_app_events group by 1, 2
"""

ORACLES["cohort_d7"] = """
select l_returnflag, l_linestatus, o_orderpriority,
  cast(sum(if(l_shipdate - o_orderdate < interval '7' day, cast(l_quantity as bigint), 0)) as bigint) as quantity_d7,
  count(*) filter (where l_shipdate - o_orderdate < interval '7' day) as n_inside,
  count(*) as n
from lineitem left join orders on l_orderkey = o_orderkey group by 1, 2, 3
"""

ORACLES["two_level_agg"] = """
select s_nationkey as nation, l_returnflag, l_linestatus,
  cast(sum(cast(l_quantity as bigint)) as bigint) as quantity, count(*) as n
from lineitem left join supplier on s_suppkey = l_suppkey group by 1, 2, 3
"""

# --- snapshots and dimensions --------------------------------------------------------------

_NOW = f"timestamp '{AS_OF}'"


def _newest(table: str, days: int) -> str:
    return f"(select max(dt) from {table} where cast(dt as timestamp) >= {_NOW} - interval {days} day)"


def _snapshot_rows(days: int) -> str:
    return (
        f"select dt, service_level__c, count(*) as n, {days} as days from crm_campaigns"
        f" where dt = {_newest('crm_campaigns', days)} group by 1, 2"
    )


ORACLES["latest_snapshot"] = f"""
{_with("crm_campaigns")}
{_snapshot_rows(2)} union all {_snapshot_rows(20)} union all {_snapshot_rows(0)}
"""

_GOAL = """
select campaign_id, priority, "type", target_value from (
  select *, row_number() over (partition by campaign_id order by priority, "type", target_value) as r
  from goals where priority is not null and "type" <> 'pacing-model') where r = 1
"""
ORACLES["primary_goal"] = f"{_with('goals')} {_GOAL}"

_CRM_V1 = f"""
select b.id as campaign_id, sales_region__c as sales_region, service_level__c as service_level,
  sales_sub_region__c as sales_sub_region
from campaigns b, crm_campaigns s
where s.campaign_id_18_digit__c = b.salesforce_campaign_id and s.dt = {_newest("crm_campaigns", 2)}
"""
_CRM_V2 = f"""
select c.customer_id, c.id as campaign_id, s.sales_region__c as sales_region,
  s.sales_sub_region__c as sales_sub_region, o.scale_zone__c as scale_zone, s.service_level__c as service_level
from campaigns c, crm_campaigns s, crm_opportunities o
where s.campaign_id_18_digit__c = c.salesforce_campaign_id and o.opportunity_id_18_digit__c = s.opportunity__c
  and s.dt = {_newest("crm_campaigns", 4)} and o.dt = {_newest("crm_opportunities", 4)} and c.state = 'enabled'
"""
ORACLES["crm_campaigns_v1"] = f"{_with('crm_campaigns', 'campaigns')} {_CRM_V1}"
ORACLES["crm_campaigns_v2"] = f"{_with('crm_campaigns', 'crm_opportunities', 'campaigns')} {_CRM_V2}"
ORACLES["repeated_dimension_keys"] = f"""
{_with('crm_campaigns', 'campaigns')}
select campaign_id, count(*) as n from ({_CRM_V1}) group by 1 having count(*) > 1
"""


def tracker(name: str, campaign: str) -> str:
    return (
        f"case when {name} = 'apple-skan' then 'SKAN' when {name} = 'no-tracker' then 'NON-MEASURABLE'"
        f" when {campaign} is null then 'N/A' else 'MMP' end"
    )


def viewthrough(creative: str, f: str, app: str) -> str:
    return (
        f"coalesce(({creative} = 'VAST' and {app}.video_viewthrough_enabled), false)"
        f" or coalesce(({creative} = 'HTML' and {f} in ('banner', 'mrec') and {app}.banner_viewthrough_enabled), false)"
        f" or coalesce(({f} = 'native' and {app}.native_viewthrough_enabled), false)"
    )


ORACLES["star_enrich"] = f"""
{_with("ad_clicks", "campaigns", "trackers", "apps", "ad_groups")}
select c.display_name as campaign_name, a.display_name as app_name, g.exploratory,
  ifnull(t.name, 'N/A') as campaign_tracker,
  {tracker("t.name", "impression__bid__campaign_id")} as campaign_tracker_type,
  ifnull(c.vt_cap > 0, false) as is_enrolled_in_vio,
  {viewthrough("impression__bid__creative__type", fmt("impression__bid__creative__ad_format"), "a")} as viewthrough_enabled,
  count(*) as n
from ad_clicks f
left join campaigns c on c.id = f.impression__bid__campaign_id
left join trackers t on t.id = c.tracker_id
left join apps a on a.id = f.impression__bid__app_id and a.customer_id = f.impression__bid__customer_id
left join ad_groups g on g.id = f.impression__bid__ad_group_id
group by all
"""

ORACLES["null_rejecting_join"] = """
select o_orderstatus, o_orderpriority, l_linestatus, count(*) as n
from orders join lineitem on o_orderkey = l_orderkey
where l_returnflag = 'R' and l_quantity > 25 group by 1, 2, 3
"""

# --- buckets -------------------------------------------------------------------------------

_FLAG_CUTS = f"""
select l_returnflag, l_linestatus, quantile_disc(l_extendedprice, {_P}) as price_cuts,
  quantile_disc(l_extendedprice / 1e6, {_P}) as unit_cuts, quantile_disc(l_discount, {_P}) as discount_cuts
from lineitem group by 1, 2
"""


def edges(i: str, cuts: str, name: str) -> str:
    """Columns low, high and label of interval i of a cut list."""
    return (
        f"if({i} = 0, 0.0, {cuts}[{i}]) as {name}_low, {cuts}[{i} + 1] as {name}_high,"
        f" {_LABELS}[{i} + 1] as {name}_percentile"
    )


def within(x: str, low: str, high: str) -> str:
    return f"({x} >= {low} and ({high} is null or {x} < {high}) and not isnan({x}))"


ORACLES["percentile_cuts_exact"] = f"""
select l_returnflag, l_linestatus, cast(i as int) as "position", price_cuts[i + 1] as price, discount_cuts[i + 1] as discount
from ({_FLAG_CUTS}), range(11) r(i)
"""

ORACLES["percentile_cuts_sketch"] = f"""
select l_returnflag, l_linestatus, count(*) as n_rows, cast(p as double) as probability, true as within_tolerance
from lineitem, (select unnest({_P}) as p) group by 1, 2, 4
"""

ORACLES["bucket_intervals"] = f"""
select l_returnflag, l_linestatus, discount_low, discount_high, discount_percentile as bucket
from (select l_returnflag, l_linestatus, {edges("i", "discount_cuts", "discount")} from ({_FLAG_CUTS}), range(12) r(i))
"""

ORACLES["bucket_assign"] = f"""
with cuts as ({_FLAG_CUTS}),
price as (select l_returnflag, l_linestatus, {edges("i", "unit_cuts", "price")} from cuts, range(12) r(i)),
discount as (select l_returnflag, l_linestatus, {edges("i", "discount_cuts", "discount")} from cuts, range(12) r(i))
select l.l_returnflag, l.l_linestatus, price_percentile, discount_percentile, price_low as price_percentile_low,
  discount_high as discount_percentile_high, count(*) as n, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
from lineitem l
join price p on p.l_returnflag = l.l_returnflag and p.l_linestatus = l.l_linestatus
  and {within("l_extendedprice", "price_low * 1e6", "price_high * 1e6")}
join discount d on d.l_returnflag = l.l_returnflag and d.l_linestatus = l.l_linestatus
  and {within("l_discount", "discount_low", "discount_high")}
group by all
"""


def _usable_quantiles(x: str) -> str:
    return f"quantile_disc({x}, {_P}) filter (where {x} is not null and not isnan({x}))"


_TRAIN_ROWS = f"""
select bid__app_platform as platform, {exchange("bid__bid_request__exchange")} as exchange_group,
  {model("bid__price_data__model_type")} as model_type, {vast("bid__creative__ad_format")} as ad_format_group,
  bid__price_data__conversion_likelihood as convx,
  bid__auction_result__winner__price_cpm_micros / bid__price_data__compensated_margin_bid_multiplier / 1e6 as private_cpm,
  bid__price_cpm_micros / 1e6 as cpm
from impressions
where bid__price_data__model_type <> '' and dt > '{START}' and dt < '{END}'
  and {day('"at"')} > '{START}' and {day('"at"')} < '{END}'
"""


def _cuts(keys: str, axes: tuple[str, ...]) -> str:
    lists = ", ".join(f"{_usable_quantiles(a)} as {a}_cuts" for a in axes)
    complete = " and ".join(f"{a}_cuts is not null" for a in axes)
    named = " and ".join(f"{k} is not null" for k in keys.split(", "))
    return f"select * from (select {keys}, {lists} from training where {named} group by all) where {complete}"


def _grid(keys: str, axes: tuple[str, ...]) -> str:
    ranges = ", ".join(f"range(12) r{n}(i{n})" for n in range(len(axes)))
    columns = ", ".join(
        edges(f"i{n}", f"{a}_cuts", a)
        .replace(f"{a}_low", f"{a}_percentile_low")
        .replace(f"{a}_high", f"{a}_percentile_high")
        for n, a in enumerate(axes)
    )
    return (
        f"{_with('impressions')}, training as ({_TRAIN_ROWS}), cuts as ({_cuts(keys, axes)})"
        f" select {keys}, {columns} from cuts, {ranges}"
    )


_K1 = "platform, model_type, exchange_group, ad_format_group"
ORACLES["bucket_grid_v1"] = _grid(_K1, ("convx", "private_cpm", "cpm"))
ORACLES["bucket_grid_v2"] = _grid("platform, model_type", ("convx", "private_cpm"))
ORACLES["bucket_table_round_trip"] = ORACLES["bucket_grid_v2"]

ORACLES["write_once_keeps_first"] = "select l_returnflag, count(*) as n from lineitem group by 1"
ORACLES["write_hour_replaces_hour"] = f"""
{_with("matched_app_events")}
select custom_event_id, count(*) * f as n, v.dt
from matched_app_events, (values (1, '2024-01-01T00'), (10, '2024-01-01T01')) v(f, dt) group by custom_event_id, f, v.dt
"""

# --- funnel --------------------------------------------------------------------------------

_A, _R, _I = "attribution_event__click__", "reeng_click__", "install__ad_click__"


def latest(x: str) -> str:
    return f"coalesce({_A}{x}, {_R}{x}, {_I}{x})"


def origin(x: str) -> str:
    return f"coalesce({_I}{x}, {_R}{x}, {_A}{x})"


_B = "impression__bid__"
_EVENT_COUNTRY = "coalesce(install__geo__country, reeng_click__geo__country, attribution_event__click__geo__country)"
_EVENT_EXCHANGE = exchange(origin(f"{_B}bid_request__exchange"), latest(f"{_B}bid_request__exchange"))

ORACLES["attribution_coalesce"] = f"""
{_with("matched_app_events")}
select {origin(f"{_B}app_platform")} as platform_v1, {latest(f"{_B}app_platform")} as platform_v2,
  {_EVENT_EXCHANGE} as exchange_group, {country(_EVENT_COUNTRY)} as country_group,
  {latest(f"{_B}campaign_id")} as campaign_id, {fmt(origin(f"{_B}creative__ad_format"))} as ad_format,
  {model(latest(f"{_B}price_data__model_type"))} as model_type, {latest("click_source")} as click_source, count(*) as n
from matched_app_events group by all
"""

ORACLES["target_events"] = f"""
{_with("matched_app_events", "campaigns")}
select {latest(f"{_B}campaign_id")} as campaign_id, c.customer_id as target_customer_id, count(*) as n,
  count(*) filter (where cpa_target_event_id = custom_event_id) as target_events_d7,
  count(*) filter (where cpa_target_event_id = custom_event_id and first_occurrence) as target_events_first_d7
from matched_app_events left join campaigns c on c.id = {latest(f"{_B}campaign_id")} group by 1, 2
"""

_COUNTS = ("impressions", "clicks", "installs")
_COHORT = ("customer_revenue_d7", "target_events_d7", "target_events_first_d7")
_SPEND = ("internal_spend", "external_spend")
_METRICS = (*_COUNTS, *_SPEND, *_COHORT, *_terms("v1"))
_LONGS = (*_COUNTS, *_COHORT)
_BUCKET = [f"{a}_percentile{e}" for a in ("convx", "private_cpm", "cpm") for e in ("", "_low", "_high")]
_KEYS = [
    "impression_at", "click_at", "install_at", "at", "platform", "exchange_group", "country_group", "customer_id",
    "dest_app_id", "campaign_id", "ad_group_id", "ad_group_type", "creative_type", "ad_format", "is_viewthrough",
    "model_type", "is_nonpersonalized", "click_source",
]
_SEG = ["s_platform", "s_model", "s_exchange", "s_format", "x_convx", "x_private", "x_cpm"]


def _event(source: str, from_: str, keys: dict[str, str], measures: dict[str, str], seg: list[str] | None) -> str:
    columns = [f"'{source}' as source", f"{'true' if seg else 'false'} as matched"]
    columns += [f'{keys.get(k, "null")} as "{k}"' for k in _KEYS]
    columns += [f"{measures.get(m, '0')} as {m}" for m in _METRICS]
    columns += [f"{s} as {name}" for s, name in zip(seg or ["null"] * len(_SEG), _SEG)]
    return f"select {', '.join(columns)} from {from_}"


def _private(bid: str) -> str:
    return f"{bid}auction_result__winner__price_cpm_micros / {bid}price_data__compensated_margin_bid_multiplier"


def _simple_keys(bid: str) -> dict[str, str]:
    return {
        "platform": f"{bid}app_platform",
        "exchange_group": exchange(f"{bid}bid_request__exchange"),
        "customer_id": f"{bid}customer_id",
        "dest_app_id": f"{bid}app_id",
        "campaign_id": f"{bid}campaign_id",
        "ad_group_id": f"{bid}ad_group_id",
        "ad_group_type": f"{bid}ad_group_type",
        "creative_type": f"{bid}creative__type",
        "ad_format": fmt(f"{bid}creative__ad_format"),
        "model_type": model(f"{bid}price_data__model_type"),
        "is_nonpersonalized": f"{bid}bid_request__non_personalized",
    }


def _simple_seg(bid: str) -> list[str]:
    return [
        f"{bid}app_platform",
        model(f"{bid}price_data__model_type"),
        exchange(f"{bid}bid_request__exchange"),
        vast(f"{bid}creative__ad_format"),
        f"{bid}price_data__conversion_likelihood",
        _private(bid),
        f"cast({bid}price_cpm_micros as double)",
    ]


def _events(variant: str) -> str:
    in_hours = f"dt >= '{START}' and dt < '{END}'"
    reported = f"{in_hours} and for_reporting = true and is_uncredited = false"
    imp = {
        **_simple_keys("bid__"),
        "impression_at": hour('"at"'),
        "at": hour('"at"'),
        "country_group": country("bid__bid_request__device__geo__country"),
        "is_viewthrough": "'N/A'",
    }
    click = {
        **_simple_keys("impression__bid__"),
        "impression_at": hour("impression__at"),
        "click_at": hour('"at"'),
        "at": hour('"at"'),
        "country_group": country("geo__country"),
        "is_viewthrough": "'N/A'",
        "click_source": "click_source",
    }
    install_bid = "ad_click__impression__bid__"
    install = {
        **_simple_keys(install_bid),
        "impression_at": hour("ad_click__impression__at"),
        "click_at": hour("ad_click__at"),
        "install_at": hour("event_timestamp"),
        "at": hour("event_timestamp"),
        "country_group": country("geo__country"),
        "is_viewthrough": "cast(is_viewthrough as varchar)",
        "click_source": "ad_click__click_source",
    }
    unmatched = {
        "platform": "tracker_params__platform",
        "exchange_group": "'UNMATCHED'",
        "creative_type": "'UNMATCHED'",
        "campaign_id": "tracker_params__campaign_id",
        "customer_id": "c.customer_id",
        "dest_app_id": "c.app_id",
    }
    app = {
        "impression_at": hour(latest("impression__at")),
        "click_at": hour(latest("at")),
        "install_at": hour("install__at"),
        "at": hour("event_timestamp"),
        "platform": (origin if variant == "v1" else latest)(f"{_B}app_platform"),
        "exchange_group": _EVENT_EXCHANGE,
        "country_group": country(_EVENT_COUNTRY),
        "customer_id": latest(f"{_B}customer_id"),
        "dest_app_id": latest(f"{_B}app_id"),
        "campaign_id": latest(f"{_B}campaign_id"),
        "ad_group_id": latest(f"{_B}ad_group_id"),
        "ad_group_type": latest(f"{_B}ad_group_type"),
        "creative_type": latest(f"{_B}creative__type"),
        "ad_format": fmt(origin(f"{_B}creative__ad_format")),
        "is_viewthrough": "cast(is_viewthrough as varchar)",
        "model_type": model(latest(f"{_B}price_data__model_type")),
        "is_nonpersonalized": latest(f"{_B}bid_request__non_personalized"),
        "click_source": latest("click_source"),
    }
    app_measures = {
        "customer_revenue_d7": revenue("customer_revenue_micros"),
        "target_events_d7": "if(c.cpa_target_event_id = custom_event_id, 1, 0)",
        "target_events_first_d7": "if(c.cpa_target_event_id = custom_event_id and first_occurrence, 1, 0)",
    }
    app_seg = [
        origin(f"{_B}app_platform"),
        model(latest(f"{_B}price_data__model_type")),
        exchange(latest(f"{_B}bid_request__exchange")),
        vast(origin(f"{_B}creative__ad_format")),
        origin(f"{_B}price_data__conversion_likelihood"),
        f"coalesce({_private(_I + _B)}, {_private(_R + _B)}, {_private(_A + _B)})",
        f"cast({origin(f'{_B}price_cpm_micros')} as double)",
    ]
    prices = {"internal_spend": "spend_micros / 1e6", "external_spend": "revenue_micros / 1e6", **_terms(variant)}
    branches = [
        _event("impressions", f"impressions where {in_hours}", imp, {"impressions": "1", **prices}, _simple_seg("bid__")),
        *[
            _event(t, f"{t} where {in_hours} and has_prior_click = false", click, {"clicks": "1"}, _simple_seg("impression__bid__"))
            for t in ("ad_clicks", "view_clicks")
        ],
        _event("matched_installs", f"matched_installs where {reported}", install, {"installs": "1"}, _simple_seg(install_bid)),
        _event(
            "unmatched_installs",
            f"unmatched_installs left join campaigns c on c.id = tracker_params__campaign_id where {reported}",
            {**install, **unmatched, "country_group": country("coalesce(ad_click__geo__country, geo__country)")},
            {"installs": "1"},
            None,
        ),
        _event(
            "matched_app_events",
            f"matched_app_events left join campaigns c on c.id = {latest(f'{_B}campaign_id')} where {reported}",
            app,
            app_measures,
            app_seg,
        ),
        _event(
            "unmatched_app_events",
            f"unmatched_app_events left join campaigns c on c.id = tracker_params__campaign_id where {reported}",
            {**app, **unmatched, "country_group": country("coalesce(install__geo__country, geo__country)")},
            app_measures,
            None,
        ),
    ]
    return " union all ".join(branches)


_SOURCES = (
    "impressions", "ad_clicks", "view_clicks", "matched_installs", "unmatched_installs",
    "matched_app_events", "unmatched_app_events", "campaigns",
)


def _axis_table(axis: str, factor: str) -> str:
    return (
        f"select {_K1}, {edges('i', f'{axis}_cuts', axis)}, {axis}_low * {factor} as {axis}_from,"
        f" {axis}_high * {factor} as {axis}_to from cuts, range(12) r(i)"
    )


def _axis_join(axis: str, x: str) -> str:
    same = (
        f"{axis}.platform = e.s_platform and {axis}.model_type = e.s_model"
        f" and {axis}.exchange_group = e.s_exchange and {axis}.ad_format_group = e.s_format"
    )
    return f"join axis_{axis} {axis} on {same} and {within(x, f'{axis}_from', f'{axis}_to')}"


def _funnel_ctes(variant: str, *more: str) -> str:
    """CTE `f`: every event with its keys and measures, in v1 with its bucket."""
    head = f"{_with(*_SOURCES, *more)}, events_all as ({_events(variant)})"
    if variant == "v2":
        return f"{head}, f as (select * from events_all)"
    located = ", ".join(
        f"{a}_percentile, {a}_low as {a}_percentile_low, {a}_high as {a}_percentile_high" for a in ("convx", "private_cpm", "cpm")
    )
    empty = ", ".join(f"null as {b}" for b in _BUCKET)
    return f"""{head},
training as ({_TRAIN_ROWS}), cuts as ({_cuts(_K1, ("convx", "private_cpm", "cpm"))}),
axis_convx as ({_axis_table("convx", "1.0")}),
axis_private_cpm as ({_axis_table("private_cpm", "1e6")}),
axis_cpm as ({_axis_table("cpm", "1e6")}),
f as (
  select e.*, {located} from events_all e
  {_axis_join("convx", "x_convx")} {_axis_join("private_cpm", "x_private")} {_axis_join("cpm", "x_cpm")}
  where matched
  union all by name
  select *, {empty} from events_all where not matched)"""


def _sum(metric: str, sql: str | None = None) -> str:
    total = f"sum({sql or 'f.' + metric})"
    if metric in _LONGS:
        return f"cast({total} as bigint) as {metric}"
    return f"round({total}, {metric_digits(metric)}) as {metric}"


def _v2_keys() -> list[str]:
    return [k for k in _KEYS if k not in ("exchange_group", "country_group", "ad_group_id")]


def _q(names: list[str], table: str = "f") -> str:
    return ", ".join(f'{table}."{n}"' for n in names)


for _variant in ("v1", "v2"):
    _names = [*_KEYS, *_BUCKET] if _variant == "v1" else _v2_keys()
    ORACLES[f"funnel_{_variant}"] = f"""
{_funnel_ctes(_variant)}
select * exclude (source) from (
  select source, {_q(_names)}, {", ".join(_sum(m) for m in _METRICS)}
  from f group by source, {_q(_names)})
"""

_INSIDE = (
    "cast(replace(replace(f.\"at\", 'T', ' '), 'Z', '') as timestamp)"
    " - cast(replace(replace(if(f.ad_group_type = 'reengagement', f.click_at, f.install_at), 'T', ' '), 'Z', '') as timestamp)"
    " < interval '7' day"
)


def _report_sums() -> str:
    sums = []
    for m in _METRICS:
        if m == "customer_revenue_d7":
            sums.append(f"round(sum(if({_INSIDE}, f.{m}, 0)) / 1e6, {metric_digits(m)}) as {m}")
        elif m in _COHORT:
            sums.append(_sum(m, f"if({_INSIDE}, f.{m}, 0)"))
        else:
            sums.append(_sum(m))
    return ", ".join(sums)


def _report(ctes: str, dims: dict[str, str], joins: str) -> str:
    select = ", ".join(f'{sql} as "{name}"' for name, sql in dims.items())
    return f"{ctes} select {select}, {_report_sums()} from f {joins} group by {', '.join(dims.values())}"


_REPORT_V1 = {
    **{k: f'f."{k}"' for k in _KEYS},
    **{b: f"f.{b}" for b in _BUCKET},
    **{
        f"convx_percentile{e}": f"if(f.model_type = 'revenue', f.convx_percentile{e} / 1e6, f.convx_percentile{e})"
        for e in ("_low", "_high")
    },
    "service_level": "sd.service_level",
    "customer_name": "cu.company",
    "dest_app_name": "apps.display_name",
    "campaign_name": "c.display_name",
    "campaign_tracker": "ifnull(t.name, 'N/A')",
    "campaign_tracker_type": tracker("t.name", "f.campaign_id"),
    "current_optimization_state": "c.current_optimization_state",
    "campaign_sales_region": "sd.sales_region",
    "campaign_sales_sub_region": "sd.sales_sub_region",
    "goal_type_3": 'g."type"',
    "goal_3_value": "g.target_value",
    "treasurer_target": "tc.target",
    "ad_group_name": "ag.display_name",
    "exploratory_ad_group": "ag.exploratory",
    "ad_group_bid_type": "ag.bid_type",
    "viewthrough_enabled": viewthrough("f.creative_type", "f.ad_format", "apps"),
    "is_enrolled_in_vio": "ifnull(c.vt_cap > 0, false)",
}
ORACLES["platform_health_v1_report"] = _report(
    _funnel_ctes("v1", "customers", "crm_campaigns", "trackers", "apps", "ad_groups", "goals", "treasurer_configs"),
    _REPORT_V1,
    f"""left join customers cu on cu.id = f.customer_id
left join ({_CRM_V1}) sd on sd.campaign_id = f.campaign_id
left join campaigns c on c.id = f.campaign_id
left join trackers t on t.id = c.tracker_id
left join apps on apps.id = f.dest_app_id
left join ad_groups ag on ag.id = f.ad_group_id
left join ({_GOAL}) g on g.campaign_id = f.campaign_id
left join treasurer_configs tc on tc.campaign_id = f.campaign_id""",
)

_REPORT_V2 = {
    **{k: f'f."{k}"' for k in _v2_keys() if k != "click_at"},
    "service_level": "sd.service_level",
    "customer_name": "cu.company",
    "dest_app_name": "apps.display_name",
    "dest_app_category": "apps.category",
    "campaign_sales_region": "sd.sales_region",
    "campaign_sales_sub_region": "sd.sales_sub_region",
    "scale_zone": "sd.scale_zone",
    "current_optimization_state": "c.current_optimization_state",
    "campaign_name": "c.display_name",
    "campaign_type": "ct.name",
    "goal_type_3": 'g."type"',
    "goal_3_value": "g.target_value",
    "campaign_tracker_type": tracker("t.name", "f.campaign_id"),
    "viewthrough_enabled": viewthrough("f.creative_type", "f.ad_format", "apps"),
}
ORACLES["platform_health_v2_report"] = _report(
    _funnel_ctes(
        "v2", "customers", "crm_campaigns", "crm_opportunities", "trackers", "apps", "goals", "campaign_types"
    ),
    _REPORT_V2,
    f"""left join customers cu on cu.id = f.customer_id
left join ({_CRM_V2}) sd on sd.campaign_id = f.campaign_id and sd.customer_id = f.customer_id
left join apps on apps.id = f.dest_app_id and apps.customer_id = f.customer_id
left join ({_GOAL}) g on g.campaign_id = f.campaign_id
left join campaigns c on c.id = f.campaign_id
left join campaign_types ct on ct.id = c.campaign_type_id
left join trackers t on t.id = c.tracker_id""",
)

_CALIBRATION_WINDOW = (
    f"h.time_bucket > timestamp '{CALIBRATION_AS_OF}' - interval {CALIBRATION_DAYS} day"
    f" and h.time_bucket < timestamp '{CALIBRATION_AS_OF}' - interval 1 hour"
)
ORACLES["revenue_calibration_series"] = f"""
{_with("ad_group_results", "ad_group_history")}
select r.time_bucket as "time",
  round(cast(sum(h.revenue_micros) as double) / 1e6, 8) as revenue,
  round(sum(r.predicted_revenue_micros) filter (where isfinite(r.predicted_revenue_micros)) / 1e6, 8) as predicted_revenue,
  round(sum(r.suggested_revenue_micros) / 1e6, 8) as suggested_revenue,
  round(sum(r.planned_revenue_micros) / 1e6, 8) as planned_revenue
from ad_group_results r
join ad_group_history h on h.time_bucket = r.time_bucket and h.ab_test_group_ids = r.ab_test_group_ids
  and h.ad_group_id = r.ad_group_id
where {_CALIBRATION_WINDOW} and h.enabled and h.estimated and bid_target_micros > 0
  and r.suggested_bid_target_micros is not null
group by 1
"""

# --- the same over windows -----------------------------------------------------------------

_ALL_HOURS = f"dt >= '{START}' and dt < '{END}'"


def _during(name: str, hours: str) -> str:
    assert _ALL_HOURS in ORACLES[name]
    return ORACLES[name].replace(_ALL_HOURS, hours)


def _week(name: str) -> str:
    return _during(name, f"dt >= '{WEEK[0]}' and dt < '{WEEK[1]}'")


ORACLES["platform_health_v1_hour"] = _during("platform_health_v1_report", f"dt = '{IMPRESSION_HOUR}'")
ORACLES["platform_health_v2_hour"] = _during("platform_health_v2_report", f"dt = '{EVENT_HOUR}'")
ORACLES["platform_health_v1_week"] = _week("platform_health_v1_report")
ORACLES["platform_health_v2_week"] = _week("platform_health_v2_report")
ORACLES["platform_health_v1_stored"] = ORACLES["platform_health_v1_report"]
ORACLES["bucket_grid_v1_window"] = ORACLES["bucket_grid_v1"].replace(START, TRAINING[0]).replace(END, TRAINING[1])
_HALF_OPEN = {f"dt > '{START}'": f"dt >= '{TRAINING[0]}'", f"{day('\"at\"')} > '{START}'": f"{day('\"at\"')} >= '{TRAINING[0]}'", END: TRAINING[1]}
_grid_v2 = ORACLES["bucket_grid_v2"].replace("where bid__price_data__model_type", "where bid__app_platform in ('ANDROID', 'IOS') and bid__price_data__model_type")
ORACLES["bucket_grid_v2"] = ORACLES["bucket_table_round_trip"] = _grid_v2
for _old, _new in _HALF_OPEN.items():
    assert _old in _grid_v2
    _grid_v2 = _grid_v2.replace(_old, _new)
ORACLES["bucket_grid_v2_window"] = _grid_v2
ORACLES["bid_validation_hours"] = (
    ORACLES["bid_economics"].rstrip()
    + f" where dt >= '{CHECKED_HOURS[0]}' and dt <= '{CHECKED_HOURS[1]}' and bid__ad_group_id in {CHECKED_IDS}"
)
ORACLES["write_once_keeps_folder"] = ORACLES["write_once_after_half_run"] = ORACLES["write_once_keeps_first"]
ORACLES["write_hour_empty_rerun"] = f"""
{_with("matched_app_events")}
select custom_event_id, count(*) as n, '2024-01-01T00' as dt from matched_app_events group by custom_event_id
"""
ORACLES["write_once_without_marker"] = ORACLES["write_once_keeps_first"]
ORACLES["write_hour_failed_swap"] = ORACLES["write_hour_replaces_hour"]
ORACLES["backfill_hours"] = (
    "select *, substr(\"at\", 1, 13) as dt from ("
    + _during("platform_health_v2_report", f"dt >= '{BACKFILL[0]}' and dt < '{BACKFILL[2]}'")
    + f") where substr(\"at\", 1, 13) <> '{BACKFILL[1]}'"
)
ORACLES["bid_validation_limit"] = f"""
with whole as ({ORACLES["bid_economics"]})
select asked::bigint as asked, least(asked, (select count(*) from whole))::bigint as n_rows, least(asked, (select count(*) from whole))::bigint as n_in_whole
from (values (10), (1000), (2000000000)) as v(asked)
"""


def _ranked(keys: str, axes: tuple[str, ...], rows: str) -> str:
    """All cuts are in place; what is checked beside that is which segments there are, and their rows."""
    counts = ", ".join(f"count(*) filter (where {a} is not null and not isnan({a})) as n_{a}" for a in axes)
    named = " and ".join(f"{k} is not null" for k in keys.split(", "))
    each = " union all ".join(
        f"select {keys}, n_rows, '{a}' as axis, p::double as probability, n_{a} as n_values, true as within_tolerance from found, unnest({_P}) as u(p)" for a in axes
    )
    return (
        f"{_with('impressions')}, training as ({rows}), found as (select * from (select {keys}, count(*) as n_rows, {counts}"
        f" from training where {named} group by all) where {' and '.join(f'n_{a} > 0' for a in axes)}) {each}"
    )


_sketched = _TRAIN_ROWS.replace(START, SKETCHED[0]).replace(END, SKETCHED[1])
ORACLES["bucket_sketches_v1_days"] = _ranked(_K1, ("convx", "private_cpm", "cpm"), _sketched)
_sketched = _sketched.replace(f"> '{SKETCHED[0]}'", f">= '{SKETCHED[0]}'") + " and bid__app_platform in ('ANDROID', 'IOS')"
ORACLES["bucket_sketches_v2_days"] = _ranked("platform, model_type", ("convx", "private_cpm"), _sketched)


def _exact(x: str, where: str = "") -> str:
    """Sum of doubles cut into whole multiples of four powers of two; the counterpart of the exact sum."""
    units, rest, parts = ("2147483648.0::double", "1.0::double", "(1.0::double / 2147483648)", "(1.0::double / 4611686018427387904)"), f"({x})::double", []
    whole_numbers = f"abs(({x})::double) < 4611686018427387904 and not isnan(({x})::double){where}"
    for unit in units:
        whole = f"trunc(({rest}) / {unit})"
        parts.append(f"sum(case when {whole_numbers} then ({whole})::bigint end)::double * {unit}")
        rest = f"({rest}) - {whole} * {unit}"
    large = f"sum({x}) filter (where not (abs(({x})::double) < 4611686018427387904 and not isnan(({x})::double)){where})"
    small = f"({parts[0]}) + (({parts[1]}) + (({parts[2]}) + ({parts[3]})))"
    return f"case when ({parts[0]}) is not null or ({large}) is not null then coalesce({large}, 0) + coalesce({small}, 0) end"


ORACLES["finite_sum_exact"] = f"""
{_with("ad_group_results")}
select ad_group_id, {_exact("predicted_revenue_micros", " and isfinite(predicted_revenue_micros)")} as finite_revenue, count(*) as n
from ad_group_results group by 1
"""
for _variant in ("v1", "v2"):
    _columns = _terms(_variant)
    ORACLES[f"predicted_metrics_exact_{_variant}"] = f"""
{_with("impressions")}
select bid__campaign_id, bid__app_platform, bid__ad_group_type, bid__creative__type, {", ".join(f"{_exact(name)} as {name}" for name in _columns)}
from (select *, {", ".join(f"{sql} as {name}" for name, sql in _columns.items())} from impressions) group by all
"""


def _exactly(name: str) -> str:
    """A report's SQL with exact sums in place of rounded ones."""
    sql = ORACLES[name]
    for m in _METRICS:
        if m not in _LONGS:
            assert _sum(m) in sql
            sql = sql.replace(_sum(m), f"{_exact('f.' + m)} as {m}")
    rounded_revenue = f", {metric_digits('customer_revenue_d7')}) as customer_revenue_d7"
    assert rounded_revenue in sql
    return sql.replace(f"round(sum(if({_INSIDE}, f.customer_revenue_d7, 0)) / 1e6{rounded_revenue}", f"sum(if({_INSIDE}, f.customer_revenue_d7, 0)) / 1e6 as customer_revenue_d7")


ORACLES["platform_health_v1_exact_hour"] = _exactly("platform_health_v1_hour")
ORACLES["platform_health_v2_exact_week"] = _exactly("platform_health_v2_week")

# Trained exactly over the same window; no cut is left in the result.
_sketched_report = _during("platform_health_v1_report", f"dt >= '{SKETCHED[0]}' and dt < '{SKETCHED[1]}'")
for _old, _new in ((f"dt > '{START}' and dt < '{END}'", f"dt > '{SKETCHED[0]}' and dt < '{SKETCHED[1]}'"), (f"> '{START}' and {day('\"at\"')} < '{END}'", f"> '{SKETCHED[0]}' and {day('\"at\"')} < '{SKETCHED[1]}'")):
    assert _old in _sketched_report
    _sketched_report = _sketched_report.replace(_old, _new)
_without = [k for k in _REPORT_V1 if k not in _BUCKET]
_whole = [m for m in _METRICS if m in _LONGS and m != "customer_revenue_d7"]
ORACLES["platform_health_v1_sketched"] = (
    f"select {', '.join(f'\"{k}\"' for k in _without)}, {', '.join(f'cast(sum({m}) as bigint) as {m}' for m in _whole)} from ({_sketched_report}) group by all"
)
