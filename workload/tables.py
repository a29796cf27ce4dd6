"""Source tables of the funnel, derived from the given tables.

Each derivation is one SELECT that Spark and DuckDB both run, so the queries and the SQL they
are compared with start from the same rows. Only the *inputs* are shared; the logic under test
is written twice. Every derivation reads whole tables, and nulls, NaN, zero divisors, ties,
out-of-range amounts and repeated dimension keys come from the values of the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.session import apply_settings
from funnelspark.sources import SCHEMAS, PartitionedTable, read_table, shared_folder

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@dataclass(frozen=True)
class Dialect:
    """The few functions the two engines spell differently."""

    epoch_ms: Callable[[str], str]
    longs: Callable[[str], str]
    quote: str


SPARK = Dialect(
    epoch_ms=lambda ts: f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', {ts})",
    longs=lambda items: f"array({items})",
    quote="`",
)
DUCKDB = Dialect(
    epoch_ms=lambda ts: f"(epoch_us({ts}) // 1000)",
    longs=lambda items: f"[{items}]",
    quote='"',
)


def _pick(index: str, values: list[str | None]) -> str:
    """The value at a row's index; null stands for itself."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values) if v is not None)
    return f"case ({index}) % {len(values)} {arms} else null end"


# The listed exchanges and countries, and some that are not listed.
_EXCHANGE = [
    "VUNGLE", "APPLOVIN", "INNERACTIVE_DIRECT", "DOUBLECLICK", "MINTEGRAL", "IRONSOURCE",
    "UNITY", "APPODEAL", "INMOBI", "VERVE", "SMALL_ONE", "SMALL_TWO", None,
]
_COUNTRY = ["US", "GB", "IN", "JP", "BR", "DE", None]
_FORMAT = ["video", "native", "320x50", "728x90", "300x250", "480x320", None]
_CREATIVE = ["VAST", "HTML", "VAST", "HTML", "NATIVE", "HTML", None]
_MODEL = ["revenue", "revenue-v3", "install", "preferred-app-event", "", None]
_TYPE = ["user-acquisition", "reengagement", None]
_SOURCE = ["banner-tap", "end-card", None]

_NAN = "cast('NaN' as double)"

_LINEITEM_DT = "cast(year(l_shipdate) as string) || '-01-01T0' || substr('013', cast(l_linenumber % 3 as int) + 1, 1)"


def _bid_from_lineitem() -> dict[str, str]:
    return {
        "bid__app_platform": "case when l_quantity = 48 then 'WEB' when l_linestatus = 'O' then 'ANDROID' else 'IOS' end",
        "bid__ad_group_type": "case l_returnflag when 'A' then 'user-acquisition' when 'R' then 'reengagement' end",
        "bid__creative__type": _pick("l_linenumber", _CREATIVE),
        "bid__creative__ad_format": _pick("l_linenumber", _FORMAT),
        "bid__bid_request__exchange": _pick("l_suppkey", _EXCHANGE),
        "bid__bid_request__device__geo__country": _pick("l_suppkey", _COUNTRY),
        "bid__bid_request__non_personalized": "case l_linenumber when 1 then null else l_linenumber % 2 = 0 end",
        "bid__customer_id": "case l_linenumber when 7 then null when 6 then l_suppkey + 1 else l_suppkey end",
        "bid__app_id": "l_suppkey + 1000",
        "bid__campaign_id": "case when l_linenumber = 5 and l_quantity > 40 then null else l_suppkey end",
        "bid__ad_group_id": "l_suppkey % 20",
        "bid__price_data__model_type": _pick("l_suppkey", _MODEL),
        "bid__price_data__conversion_likelihood": (
            f"case when l_quantity = 50 then null when l_quantity = 49 then {_NAN}"
            " when l_suppkey % 6 < 2 then l_extendedprice * 10 else l_discount * l_tax end"
        ),
        "bid__price_data__compensated_margin_bid_multiplier": "l_discount * 10",
        "bid__price_data__ad_group_cpx_bid_micros": "cast(floor(l_quantity * 250000) as bigint)",
        "bid__price_data__effective_cpx_bid_micros": "cast(floor(l_quantity * 250000 * (1 - l_discount)) as bigint)",
        "bid__auction_result__winner__price_cpm_micros": "cast(floor(l_extendedprice * 100) as bigint)",
        "bid__price_cpm_micros": "cast(floor(l_extendedprice * (100 - 100 * l_tax)) as bigint)",
        "bid__price_data__predicted_imp_to_click_rate": "case l_linenumber when 2 then null else l_discount end",
        "bid__price_data__predicted_click_to_install_rate": "case l_linenumber when 3 then null else l_tax end",
        "bid__price_data__predicted_imp_to_install_ct_rate": "case l_linenumber when 4 then null else l_tax / 4 end",
        "bid__price_data__predicted_imp_to_install_vt_rate": "case l_linenumber when 5 then null else l_tax / 8 end",
        "bid__price_data__predicted_install_to_preferred_app_event_rate": "l_discount * 2",
        "bid__price_data__predicted_install_to_preferred_app_event_vt_rate": "l_discount * 4",
        "bid__price_data__predicted_install_to_revenue_rate": "case l_linenumber when 6 then null else l_extendedprice * 16384 end",
        "bid__price_data__predicted_click_to_preferred_app_event_rate": "l_tax * 2",
        "bid__price_data__predicted_click_to_revenue_rate": "l_extendedprice * 8192",
    }


def _bid_from_event(prefix: str, shift: int, present: str = "true") -> dict[str, str]:
    """A bid record read off an event's numbers; `shift` makes the chains of one event differ."""
    k = f"(k + {shift})"
    columns = {
        "app_platform": f"case when {k} % 2 = 0 then 'ANDROID' else 'IOS' end",
        "ad_group_type": _pick(k, _TYPE),
        "creative__type": _pick(k, _CREATIVE),
        "creative__ad_format": _pick(k, _FORMAT),
        "bid_request__exchange": _pick(k, _EXCHANGE),
        "bid_request__device__geo__country": _pick(k, _COUNTRY),
        "bid_request__non_personalized": f"case when {k} % 5 = 0 then null else {k} % 3 = 0 end",
        "customer_id": f"user_id + {shift % 2}",
        "app_id": "user_id + 1000",
        "campaign_id": f"case when {k} % 17 = 0 then null else user_id + {shift} end",
        "ad_group_id": f"{k} % 20",
        "price_data__model_type": _pick(k, _MODEL),
        "price_data__conversion_likelihood": (
            f"case when {k} % 23 = 0 then null when {k} % 29 = 0 then {_NAN}"
            f" when {k} % 6 < 2 then value * 10000 else value / 50000 end"
        ),
        "price_data__compensated_margin_bid_multiplier": f"cast({k} % 11 as double) / 8",
        "auction_result__winner__price_cpm_micros": "cast(floor(value * 100000) as bigint)",
        "price_cpm_micros": f"cast(floor(value * (100000 - 1000 * {shift})) as bigint)",
    }
    return {
        f"{prefix}bid__{name}": f"case when {present} then {sql} end" for name, sql in columns.items()
    }


def _click_from_event(prefix: str, shift: int, hours_back: str, present: str = "true") -> dict[str, str]:
    return {
        f"{prefix}at": f"case when {present} then t_ms - ({hours_back}) * 3600000 end",
        f"{prefix}impression__at": f"case when {present} then t_ms - ({hours_back} + k % 5) * 3600000 end",
        f"{prefix}click_source": f"case when {present} then {_pick(f'(k + {shift})', _SOURCE)} end",
        **_bid_from_event(f"{prefix}impression__", shift, present),
    }


_FLAGS = {
    "is_viewthrough": "case when k % 10 = 0 then null else k % 3 = 0 end",
    "for_reporting": "case when k % 19 = 0 then null else k % 8 <> 1 end",
    "is_uncredited": "case when k % 21 = 0 then null else k % 9 = 1 end",
}


def _install() -> dict[str, str]:
    return {
        "event_timestamp": "t_ms",
        **_FLAGS,
        **_click_from_event("ad_click__", 0, "k % 50"),
        "geo__country": _pick("k", _COUNTRY),
    }


def _app_event() -> dict[str, str]:
    """Each chain is absent on some events, and on a few all three are."""
    return {
        "event_timestamp": "t_ms",
        # From four days after the event to eight days and more before it; absent on some.
        "install__at": "case when k % 13 = 0 then null else t_ms - (3 * k - 96) * 3600000 end",
        **_FLAGS,
        "customer_revenue_micros": (
            "case when k = 97 then null when k = 98 then -100000000000 when k = 99 then 100000000000"
            " else cast(floor(value * 1000000) as bigint) end"
        ),
        "custom_event_id": "k % 10",
        "first_occurrence": "case when k % 7 = 0 then null else k % 2 = 0 end",
        "install__geo__country": f"case when k % 4 <> 0 then {_pick('k', _COUNTRY)} end",
        "reeng_click__geo__country": f"case when k % 3 <> 0 then {_pick('(k + 1)', _COUNTRY)} end",
        "attribution_event__click__geo__country": f"case when k % 5 = 0 then {_pick('(k + 2)', _COUNTRY)} end",
        **_click_from_event("install__ad_click__", 0, "3 * k - 90", "k % 4 <> 0"),
        **_click_from_event("reeng_click__", 1, "2 * k", "k % 3 <> 0"),
        **_click_from_event("attribution_event__click__", 2, "k % 60", "k % 5 = 0"),
    }


_TRACKER_PARAMS = {
    "tracker_params__platform": "case when k % 2 = 1 then 'ANDROID' else 'IOS' end",
    "tracker_params__campaign_id": "case when k % 11 = 0 then null else user_id end",
}


def derivations(d: Dialect) -> dict[str, str]:
    """Name to SELECT; `{lineitem}` and the like stand for the given tables."""
    lineitem_at = f"{d.epoch_ms('l_year')} + (l_linenumber % 3) * 5400000"
    lineitems = f"(select *, {lineitem_at} as t_ms from (select *, date_trunc('year', l_shipdate) as l_year from {{lineitem}}) y) s"
    events = (
        f"(select *, {d.epoch_ms('ts')} as t_ms, cast(substr(props, 7, length(props) - 7) as bigint) as k"
        " from {events}) s"
    )

    def select(columns: dict[str, str], source: str, where: str = "") -> str:
        body = ", ".join(f"{sql} as {d.quote}{name}{d.quote}" for name, sql in columns.items())
        return f"select {body} from {source}" + (f" where {where}" if where else "")

    def fact(columns: dict[str, str], event_type: str, more: str = "") -> str:
        return select({**columns, "dt": "replace(substr(cast(ts as string), 1, 13), ' ', 'T')"}, events, f"event_type = '{event_type}'{more}")

    click = {
        "at": "t_ms",
        "click_source": _pick("k", _SOURCE),
        "impression__at": "t_ms - (k % 30) * 3600000",
        **_bid_from_event("impression__", 0),
        "geo__country": _pick("(k + 3)", _COUNTRY),
        "has_prior_click": "case when k % 10 = 0 then null else k % 4 = 0 end",
    }
    facts = {
        "impressions": select(
            {
                "at": "t_ms",
                **_bid_from_lineitem(),
                "spend_micros": "cast(floor(l_quantity * 1000 * (1 - l_tax)) as bigint)",
                "revenue_micros": "case when l_quantity = 1 then 0 else cast(floor(l_quantity * 1000) as bigint) end",
                "dt": _LINEITEM_DT,
            },
            lineitems,
        ),
        "ad_clicks": fact(click, "click"),
        "view_clicks": fact(click, "view"),
        "matched_installs": fact(_install(), "signup"),
        "unmatched_installs": fact(
            {**_install(), **_TRACKER_PARAMS, "ad_click__geo__country": f"case when k % 2 = 0 then {_pick('(k + 1)', _COUNTRY)} end"},
            "error",
            " and event_id % 2 = 0",
        ),
        "matched_app_events": fact(_app_event(), "purchase"),
        "unmatched_app_events": fact(
            {**_app_event(), **_TRACKER_PARAMS, "geo__country": _pick("(k + 4)", _COUNTRY)}, "error", " and event_id % 2 = 1"
        ),
    }
    dimensions = {
        "campaigns": select(
            {
                "id": "s_suppkey",
                "customer_id": "s_suppkey",
                "app_id": "s_suppkey + 1000",
                "tracker_id": "case when s_suppkey % 7 = 0 then null else s_suppkey % 5 end",
                "campaign_type_id": "s_suppkey % 6",
                "cpa_target_event_id": "case when s_suppkey % 12 = 0 then null else s_suppkey % 10 end",
                "display_name": "s_name",
                "state": "case when s_suppkey % 4 = 0 then 'paused' else 'enabled' end",
                "current_optimization_state": "case when s_acctbal > 5000 then 'cpa' else 'cpi' end",
                "salesforce_campaign_id": "'crm-' || cast(s_suppkey as string)",
                "vt_cap": "case when s_suppkey % 3 = 0 then null else s_acctbal - 2000 end",
            },
            "{supplier}",
        ),
        "goals": select(
            {
                "campaign_id": "o_custkey % 200",
                "priority": "case when o_orderpriority = '5-LOW' then null else cast(substr(o_orderpriority, 1, 1) as int) end",
                "type": "case o_orderstatus when 'P' then 'pacing-model' when 'O' then 'cpa' else 'roas' end",
                "target_value": "o_totalprice",
            },
            "{orders}",
        ),
        "treasurer_configs": select(
            # Two of five rows have campaigns that no event names.
            {"campaign_id": "case when s_acctbal > 3000 then s_suppkey else s_suppkey + 1000000 end", "target": "s_acctbal"},
            "{supplier}",
        ),
        "customers": select({"id": "c_custkey", "company": "c_name"}, "{customer}"),
        "trackers": select(
            {
                "id": "cast(r_regionkey as bigint)",
                "name": "case r_regionkey when 0 then 'apple-skan' when 1 then 'no-tracker' when 2 then null else r_name end",
            },
            "{region}",
        ),
        "apps": select(
            {
                "id": "s_suppkey + 1000",
                "customer_id": "s_suppkey",
                "display_name": "'App ' || s_name",
                "category": "case when s_nationkey < 10 then 'games' when s_nationkey < 20 then 'shopping' end",
                "video_viewthrough_enabled": "case when s_suppkey % 3 = 0 then null else s_suppkey % 2 = 0 end",
                "banner_viewthrough_enabled": "s_suppkey % 3 = 1",
                "interstitial_viewthrough_enabled": "true",
                "native_viewthrough_enabled": "s_suppkey % 4 = 1",
            },
            "{supplier}",
        ),
        "ad_groups": select(
            {
                "id": "p_partkey",
                "display_name": "p_name",
                "bid_type": "case p_partkey % 4 when 0 then 'cpr' when 1 then 'cprv3' when 2 then 'cpa' end",
                "exploratory": "p_size > 25",
            },
            "{part}",
        ),
        "campaign_types": select({"id": "cast(r_regionkey as bigint)", "name": "r_name"}, "{region}"),
        # Three daily snapshots; within one, some campaigns appear twice or more.
        "crm_campaigns": select(
            {
                "campaign_id_18_digit__c": "'crm-' || cast(c_custkey % 120 as string)",
                "sales_region__c": _pick("c_nationkey", ["EMEA", "APAC", "NA"]),
                "sales_sub_region__c": "case when c_nationkey > 20 then null else 'sub-' || cast(c_nationkey % 8 as string) end",
                "service_level__c": "c_mktsegment",
                "opportunity__c": "'opp-' || cast(c_nationkey as string)",
                "dt": _pick("c_custkey", ["2024-01-28", "2024-01-29", "2024-01-20"]),
            },
            "{customer}",
        ),
        "crm_opportunities": select(
            {
                "opportunity_id_18_digit__c": "'opp-' || cast(n_nationkey as string)",
                "scale_zone__c": "n_name",
                "dt": "case when n_nationkey % 6 = 5 then '2024-01-25' else '2024-01-27' end",
            },
            "{nation}",
        ),
    }
    series = {
        # One row per order; a few keys repeat on both sides.
        "ad_group_results": select(
            {
                "time_bucket": "o_orderdate",
                "ab_test_group_ids": d.longs("o_custkey % 2, 7"),
                "ad_group_id": "o_custkey % 50",
                "predicted_revenue_micros": (
                    f"case o_orderkey % 9 when 0 then {_NAN} when 1 then cast('Infinity' as double)"
                    " when 2 then cast('-Infinity' as double) when 3 then null else o_totalprice end"
                ),
                "suggested_revenue_micros": "case when o_orderkey % 10 = 0 then null else o_totalprice * 2 end",
                "planned_revenue_micros": "o_totalprice * 4",
                "suggested_bid_target_micros": "case when o_orderpriority = '5-LOW' then null else o_totalprice end",
            },
            "{orders}",
        ),
        "ad_group_history": select(
            {
                "time_bucket": "o_orderdate",
                "ab_test_group_ids": d.longs("o_custkey % 2, 7"),
                "ad_group_id": "o_custkey % 50",
                "revenue_micros": "cast(floor(l_extendedprice * 100) as bigint)",
                "bid_target_micros": "cast(l_quantity as bigint) - 5",
                "enabled": "case l_returnflag when 'A' then null when 'R' then true else l_linenumber <> 1 end",
                "estimated": "l_linestatus = 'O'",
            },
            "{lineitem} join {orders} on l_orderkey = o_orderkey",
        ),
    }
    return {**facts, **dimensions, **series}


class Tables:
    """The given and derived tables of one folder, as lazy DataFrames, each opened when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.folder = folder
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def _open(self, name: str) -> DataFrame:
        if name in GIVEN:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        sql = _SPARK_SQL[name]
        return self.spark.sql(sql, **{t: self[t] for t in GIVEN if f"{{{t}}}" in sql})


class TypedTables(Tables):
    """The same tables, those with a `dt` stored as declared and partitioned by it, and read back so.

    Each is written once per application and folder. Rows are dealt to tasks by `dt`, those of a large year's or
    snapshot's to several; line items before they are widened.
    """

    _written: dict[tuple[str, str, str], str] = {}

    def _open(self, name: str) -> DataFrame:
        if name not in SCHEMAS or "dt" not in SCHEMAS[name].names:
            return super()._open(name)
        if name == "impressions":
            items = self["lineitem"].withColumn("_dt", F.expr(_LINEITEM_DT)).hint("rebalance", "_dt").drop("_dt")
            derived = self.spark.sql(_SPARK_SQL[name], lineitem=items)
        elif "{events}" in _SPARK_SQL[name]:
            derived = super()._open(name).repartition("dt")  # hundreds of hours, none of them large
        else:
            derived = super()._open(name).hint("rebalance", "dt")
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in self._written:
            root = f"{shared_folder(self.spark)}/typed-{uuid.uuid4().hex}"
            given = [F.col(f.name) if f.name in derived.columns else F.lit(None) for f in SCHEMAS[name]]
            columns = [c.cast(f.dataType).alias(f.name) for c, f in zip(given, SCHEMAS[name])]
            derived.where("dt is not null").select(*columns).write.partitionBy("dt").parquet(f"{root}/{name}")
            self._written[key] = root
        return self._read(self._written[key], name)

    def _read(self, root: str, name: str) -> DataFrame:
        return read_table(self.spark, root, name)


class ListedTables(TypedTables):
    """The same stored tables by their partitions: only those in range are listed and read."""

    def _read(self, root: str, name: str) -> PartitionedTable:
        return PartitionedTable(self.spark, root, name)


_SPARK_SQL = derivations(SPARK)


def duckdb_select(name: str) -> str:
    """The same derivation for DuckDB, over views named like the given tables."""
    return derivations(DUCKDB)[name].format(**{t: t for t in GIVEN})
