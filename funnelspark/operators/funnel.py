"""The seven-source funnel: one row shape for impressions, clicks, installs and app events.

Each source is projected to the same keys and measures and the rows are joined end to end
before any aggregation, so the whole funnel needs one shuffle rather than one per source.
Hours stay epoch milliseconds until after aggregation.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions import chains, recode
from funnelspark.functions.numbers import ieee_div, micros
from funnelspark.functions.text import quoted
from funnelspark.functions.times import hour_ms, iso_text
from funnelspark.operators.buckets import assign_bucket, locate_bucket
from funnelspark.operators.dimensions import campaign_targets
from funnelspark.operators.metrics import METRICS, predicted_terms, revenue_micros, target_event_terms
from funnelspark.sources.readers import scan_hours

HOUR_KEYS = ("impression_at", "click_at", "install_at", "at")

# Group keys in output order, with types.
KEYS = {
    **{name: "bigint" for name in HOUR_KEYS},
    "platform": "string",
    "exchange_group": "string",
    "country_group": "string",
    "customer_id": "bigint",
    "dest_app_id": "bigint",
    "campaign_id": "bigint",
    "ad_group_id": "bigint",
    "ad_group_type": "string",
    "creative_type": "string",
    "ad_format": "string",
    "is_viewthrough": "string",
    "model_type": "string",
    "is_nonpersonalized": "boolean",
    "click_source": "string",
}
BUCKET_AXES = ("convx", "private_cpm", "cpm")
BUCKET_KEYS = {
    "convx_percentile": "string",
    "convx_percentile_low": "double",
    "convx_percentile_high": "double",
    "private_cpm_percentile_low": "double",
    "private_cpm_percentile_high": "double",
    "private_cpm_percentile": "string",
    "cpm_percentile_low": "double",
    "cpm_percentile_high": "double",
    "cpm_percentile": "string",
}
#: What stands for BUCKET_KEYS in rows that are located and not named.
BUCKET_PLACES = {"_segment": "bigint", **{f"_index_{a}": "int" for a in BUCKET_AXES}}
_V1_ONLY = ("exchange_group", "country_group", "ad_group_id")
_SEGMENT = ("platform", "model_type", "exchange_group", "ad_format_group")


def key_names(variant: str) -> list[str]:
    """Group keys of a variant: 27 in v1, 15 in v2."""
    if variant == "v1":
        return [*KEYS, *BUCKET_KEYS]
    return [k for k in KEYS if k not in _V1_ONLY]


# What a source gives for its exchange instead of the group: the one tested, the one named, or the group itself.
_EXCHANGE = ("exchange_tested", "exchange_named", "exchange_fixed")

# Common to all sources and stated once, on the joined rows: raw values to keys.
_RECODED = {
    **{k: hour_ms(k) for k in HOUR_KEYS},
    "exchange_group": f"coalesce(exchange_fixed, {recode.exchange_group('exchange_tested', emit='exchange_named')})",
    "country_group": recode.country_group("country_group"),
    "ad_format": recode.ad_format("ad_format"),
    "model_type": recode.model_type("model_type"),
    "_seg_model_type": recode.model_type("_seg_model_type"),
    "_seg_exchange_group": recode.exchange_group("_seg_exchange_group"),
    "_seg_ad_format_group": recode.ad_format_group("_seg_ad_format_group"),
}


def _shape(source: str, df: DataFrame, keys: Mapping[str, str], measures: Mapping[str, str], probe: Mapping[str, str]) -> DataFrame:
    """Project a source to the common row; absent keys are typed nulls, absent measures zeros.

    Hours, exchanges, countries, formats and model types are still raw.
    """
    unknown = (set(keys) - set(KEYS) - set(_EXCHANGE)) | (set(measures) - set(METRICS))
    if unknown:
        raise ValueError(f"{source}: unknown columns {sorted(unknown)}")
    given = {**{k: t for k, t in KEYS.items() if k != "exchange_group"}, **dict.fromkeys(_EXCHANGE, "string")}
    return df.selectExpr(
        f"{quoted(source)} as source",
        *[f"cast({keys.get(k, 'null')} as {t}) as {k}" for k, t in given.items()],
        *[f"cast({measures.get(m, '0')} as {t}) as {m}" for m, t in METRICS.items()],
        *[f"{sql} as {name}" for name, sql in probe.items()],
    )


def stated_once(union: DataFrame) -> DataFrame:
    """The union's rows, with a filter that every row passes and that the optimiser can't move.

    What is projected above it stays above it. Otherwise the same long expressions would be pushed into each
    of the union's sources, and optimised and compiled as many times. Columns are still pruned.
    """
    return union.where("spark_partition_id() >= 0")


def _recoded(rows: DataFrame) -> DataFrame:
    """Joined rows with raw values recoded to keys."""
    rows = stated_once(rows)
    kept = [c for c in rows.columns if c not in _EXCHANGE]
    return rows.selectExpr(
        *[f"{_RECODED[c]} as {c}" if c in _RECODED else c for c in kept], f"{_RECODED['exchange_group']} as exchange_group"
    )


def _exchange(raw: str, named: str | None = None) -> dict[str, str]:
    return {"exchange_tested": raw, "exchange_named": named or raw}


def _probe(platform: str, model: str, exchange: str, fmt: str, likelihood: str, private: str, price: str) -> dict[str, str]:
    """What the bucket lookup needs from a row: its segment, still raw, and its value on each axis."""
    return {
        "_seg_platform": platform,
        "_seg_model_type": model,
        "_seg_exchange_group": exchange,
        "_seg_ad_format_group": fmt,
        "_val_convx": likelihood,
        "_val_private_cpm": private,
        "_val_cpm": price,
    }


def private_price(bid: str) -> str:
    """Winning price before the margin multiplier, in micros."""
    return ieee_div(
        f"{bid}auction_result__winner__price_cpm_micros",
        f"{bid}price_data__compensated_margin_bid_multiplier",
    )


def _bid_keys(bid: str) -> dict[str, str]:
    """Keys read from one bid record."""
    return {
        "platform": f"{bid}app_platform",
        **_exchange(f"{bid}bid_request__exchange"),
        "customer_id": f"{bid}customer_id",
        "dest_app_id": f"{bid}app_id",
        "campaign_id": f"{bid}campaign_id",
        "creative_type": f"{bid}creative__type",
        **_bid_traits(bid),
    }


def _bid_traits(bid: str) -> dict[str, str]:
    """The keys an unmatched install still takes from its bid record."""
    return {
        "ad_group_id": f"{bid}ad_group_id",
        "ad_group_type": f"{bid}ad_group_type",
        "ad_format": f"{bid}creative__ad_format",
        "model_type": f"{bid}price_data__model_type",
        "is_nonpersonalized": f"{bid}bid_request__non_personalized",
    }


def _bid_probe(bid: str) -> dict[str, str]:
    return _probe(
        f"{bid}app_platform",
        f"{bid}price_data__model_type",
        f"{bid}bid_request__exchange",
        f"{bid}creative__ad_format",
        f"{bid}price_data__conversion_likelihood",
        private_price(bid),
        f"{bid}price_cpm_micros",
    )


def _impressions(tables: Mapping[str, DataFrame], variant: str, scan: Callable) -> DataFrame:
    keys = {
        **_bid_keys("bid__"),
        "impression_at": "at",
        "at": "at",
        "country_group": "bid__bid_request__device__geo__country",
        "is_viewthrough": "'N/A'",
    }
    measures = {
        "impressions": "1",
        "internal_spend": micros("spend_micros"),
        "external_spend": micros("revenue_micros"),
        **predicted_terms(variant),
    }
    return _shape("impressions", scan("impressions"), keys, measures, _bid_probe("bid__"))


def _clicks(source: str) -> Callable:
    def rows(tables: Mapping[str, DataFrame], variant: str, scan: Callable) -> DataFrame:
        bid = "impression__bid__"
        keys = {
            **_bid_keys(bid),
            "impression_at": "impression__at",
            "click_at": "at",
            "at": "at",
            "country_group": "geo__country",
            "is_viewthrough": "'N/A'",
            "click_source": "click_source",
        }
        first = scan(source).where("has_prior_click = false")
        return _shape(source, first, keys, {"clicks": "1"}, _bid_probe(bid))

    return rows


def _reported(df: DataFrame) -> DataFrame:
    """Reportable, credited conversions; a null flag drops the row."""
    return df.where("for_reporting and not is_uncredited")


def _install_keys(bid: str) -> dict[str, str]:
    return {
        "impression_at": "ad_click__impression__at",
        "click_at": "ad_click__at",
        "install_at": "event_timestamp",
        "at": "event_timestamp",
        "is_viewthrough": "cast(is_viewthrough as string)",
        "click_source": "ad_click__click_source",
        **_bid_traits(bid),
    }


def _matched_installs(tables: Mapping[str, DataFrame], variant: str, scan: Callable) -> DataFrame:
    bid = "ad_click__impression__bid__"
    keys = {
        **_bid_keys(bid),
        **_install_keys(bid),
        "country_group": "geo__country",
    }
    return _shape("matched_installs", _reported(scan("matched_installs")), keys, {"installs": "1"}, _bid_probe(bid))


def _unmatched_keys() -> dict[str, str]:
    """Without a matched bid, customer and app come from the campaign the tracker names."""
    return {
        "platform": "tracker_params__platform",
        "exchange_fixed": "'UNMATCHED'",
        "creative_type": "'UNMATCHED'",
        "campaign_id": "tracker_params__campaign_id",
        "customer_id": "target_customer_id",
        "dest_app_id": "target_app_id",
    }


def _with_target(df: DataFrame, tables: Mapping[str, DataFrame], campaign: str) -> DataFrame:
    targets = campaign_targets(tables["campaigns"])
    return df.join(targets, F.expr(f"{campaign} = target_campaign_id"), "left")


def _unmatched_installs(tables: Mapping[str, DataFrame], variant: str, scan: Callable) -> DataFrame:
    rows = _with_target(_reported(scan("unmatched_installs")), tables, "tracker_params__campaign_id")
    country = "coalesce(ad_click__geo__country, geo__country)"
    keys = {
        **_install_keys("ad_click__impression__bid__"),
        **_unmatched_keys(),
        "country_group": country,
    }
    return _shape("unmatched_installs", rows, keys, {"installs": "1"}, {})


def _latest(field: str) -> str:
    return chains.first_chain(field, chains.LATEST_FIRST)


def _origin(field: str) -> str:
    return chains.first_chain(field, chains.ORIGIN_FIRST)


def _app_event_keys() -> dict[str, str]:
    """Keys app events share; which chain wins differs from column to column."""
    bid = "impression__bid__"
    return {
        "impression_at": _latest("impression__at"),
        "click_at": _latest("at"),
        "install_at": "install__at",
        "at": "event_timestamp",
        "ad_group_id": _latest(f"{bid}ad_group_id"),
        "ad_group_type": _latest(f"{bid}ad_group_type"),
        "ad_format": _origin(f"{bid}creative__ad_format"),
        "is_viewthrough": "cast(is_viewthrough as string)",
        "model_type": _latest(f"{bid}price_data__model_type"),
        "is_nonpersonalized": _latest(f"{bid}bid_request__non_personalized"),
        "click_source": _latest("click_source"),
    }


def _app_event_measures() -> dict[str, str]:
    return {
        "customer_revenue_d7": revenue_micros("customer_revenue_micros"),
        **target_event_terms(
            "cpa_target_event_id", "custom_event_id", "first_occurrence"
        ),
    }


def _matched_app_events(tables: Mapping[str, DataFrame], variant: str, scan: Callable) -> DataFrame:
    bid = "impression__bid__"
    exchange = f"{bid}bid_request__exchange"
    campaign = _latest(f"{bid}campaign_id")
    rows = _with_target(_reported(scan("matched_app_events")), tables, campaign)
    keys = {
        **_app_event_keys(),
        "platform": _origin(f"{bid}app_platform") if variant == "v1" else _latest(f"{bid}app_platform"),
        # The original chain decides whether the exchange is listed, the latest one names it.
        **_exchange(_origin(exchange), named=_latest(exchange)),
        "country_group": chains.first_country(chains.ORIGIN_FIRST),
        "customer_id": _latest(f"{bid}customer_id"),
        "dest_app_id": _latest(f"{bid}app_id"),
        "campaign_id": campaign,
        "creative_type": _latest(f"{bid}creative__type"),
    }
    probe = _probe(
        _origin(f"{bid}app_platform"),
        _latest(f"{bid}price_data__model_type"),
        _latest(exchange),
        _origin(f"{bid}creative__ad_format"),
        _origin(f"{bid}price_data__conversion_likelihood"),
        f"coalesce({', '.join(private_price(prefix + bid) for prefix in chains.ORIGIN_FIRST)})",
        _origin(f"{bid}price_cpm_micros"),
    )
    return _shape("matched_app_events", rows, keys, _app_event_measures(), probe)


def _unmatched_app_events(tables: Mapping[str, DataFrame], variant: str, scan: Callable) -> DataFrame:
    rows = _with_target(_reported(scan("unmatched_app_events")), tables, "tracker_params__campaign_id")
    country = "coalesce(install__geo__country, geo__country)"
    keys = {**_app_event_keys(), **_unmatched_keys(), "country_group": country}
    return _shape("unmatched_app_events", rows, keys, _app_event_measures(), {})


MATCHED = {
    "impressions": _impressions,
    "ad_clicks": _clicks("ad_clicks"),
    "view_clicks": _clicks("view_clicks"),
    "matched_installs": _matched_installs,
    "matched_app_events": _matched_app_events,
}
UNMATCHED = {
    "unmatched_installs": _unmatched_installs,
    "unmatched_app_events": _unmatched_app_events,
}


def union_branches(branches: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(DataFrame.unionByName, branches)


def funnel_rows(
    tables: Mapping[str, DataFrame],
    start: str,
    end: str,
    variant: str,
    segments: DataFrame | None = None,
    named: bool = True,
) -> DataFrame:
    """Every event of [start, end) as one row: source, group keys, measures; not aggregated.

    v1 also places matched events in their bucket cell and drops those without one; unmatched
    events carry null buckets. The lookup runs once, over the union of the matched sources. Rows that
    are not `named` have BUCKET_PLACES for BUCKET_KEYS, until `name_bucket`; `segments` are numbered then.
    """

    def scan(name: str) -> DataFrame:
        return scan_hours(tables[name], start, end)

    matched = union_branches([f(tables, variant, scan) for f in MATCHED.values()])
    unmatched = union_branches([f(tables, variant, scan) for f in UNMATCHED.values()])
    if variant == "v2":
        probes = [c for c in matched.columns if c not in unmatched.columns]
        rows = _recoded(union_branches([matched.drop(*probes), unmatched]))
        return rows.select("source", *key_names(variant), *METRICS)
    if segments is None:
        raise ValueError("v1 needs the trained segments")
    matched = (assign_bucket if named else locate_bucket)(
        _recoded(matched),
        segments,
        {k: f"_seg_{k}" for k in _SEGMENT},
        # Buckets are trained on units for prices and raw likelihood.
        {
            "convx": ("_val_convx", 1.0),
            "private_cpm": ("_val_private_cpm", 1e6),
            "cpm": ("_val_cpm", 1e6),
        },
    )
    cell = BUCKET_KEYS if named else BUCKET_PLACES
    unmatched = _recoded(unmatched).selectExpr("*", *[f"cast(null as {t}) as {k}" for k, t in cell.items()])
    columns = ["source", *KEYS, *cell, *METRICS]
    return stated_once(union_branches([matched.select(*columns), unmatched.select(*columns)]))


def sum_metrics() -> list[Column]:
    return [F.sum(m).alias(m) for m in METRICS]


def format_hours(df: DataFrame) -> DataFrame:
    """Hour keys from epoch milliseconds to ISO text."""
    return df.selectExpr(*[f"{iso_text(c)} as {c}" if c in HOUR_KEYS else c for c in df.columns])


def funnel(
    tables: Mapping[str, DataFrame],
    start: str,
    end: str,
    variant: str,
    segments: DataFrame | None = None,
) -> DataFrame:
    """The funnel aggregated per source and group keys, revenue in micros and not yet cohort-gated."""
    keys = key_names(variant)
    sums = funnel_rows(tables, start, end, variant, segments).groupBy("source", *keys).agg(*sum_metrics())
    return format_hours(sums.drop("source"))
