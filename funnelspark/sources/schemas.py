"""Schemas of the source tables. Nothing is inferred from files.

Epochs are milliseconds, `*_micros` are millionths, `__` separates the path of a
flattened nested record.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "longs": ArrayType(LongType()),
    "binary": BinaryType(),
}


def _struct(*groups: tuple[str, str]) -> StructType:
    """Each group is (type name, space-separated column names)."""
    return StructType(
        [StructField(name, _TYPES[kind]) for kind, names in groups for name in names.split()]
    )


def _prefixed(prefix: str, *structs: StructType) -> StructType:
    return StructType([StructField(prefix + f.name, f.dataType) for s in structs for f in s])


def _joined(*structs: StructType) -> StructType:
    return StructType([f for s in structs for f in s])


BID = _prefixed(
    "bid__",
    _struct(
        ("string", "app_platform ad_group_type creative__type creative__ad_format"),
        ("string", "bid_request__exchange bid_request__device__geo__country"),
        ("boolean", "bid_request__non_personalized"),
        ("long", "customer_id app_id campaign_id ad_group_id"),
        ("long", "auction_result__winner__price_cpm_micros price_cpm_micros"),
    ),
    _prefixed(
        "price_data__",
        _struct(
            ("string", "model_type"),
            ("double", "conversion_likelihood compensated_margin_bid_multiplier"),
            ("long", "ad_group_cpx_bid_micros effective_cpx_bid_micros"),
            (
                "double",
                "predicted_imp_to_click_rate predicted_click_to_install_rate"
                " predicted_imp_to_install_ct_rate predicted_imp_to_install_vt_rate"
                " predicted_install_to_preferred_app_event_rate"
                " predicted_install_to_preferred_app_event_vt_rate"
                " predicted_install_to_revenue_rate"
                " predicted_click_to_preferred_app_event_rate predicted_click_to_revenue_rate",
            ),
        ),
    ),
)

DT = _struct(("string", "dt"))
IMPRESSION = _joined(_struct(("long", "at")), BID)
CLICK = _joined(_struct(("long", "at"), ("string", "click_source")), _prefixed("impression__", IMPRESSION))
CONVERSION_FLAGS = _struct(("long", "event_timestamp"), ("boolean", "is_viewthrough for_reporting is_uncredited"))
TRACKER_PARAMS = _struct(("string", "tracker_params__platform"), ("long", "tracker_params__campaign_id"))

_CLICKS = _joined(CLICK, _struct(("string", "geo__country"), ("boolean", "has_prior_click")), DT)
_MATCHED_INSTALLS = _joined(
    CONVERSION_FLAGS, _prefixed("ad_click__", CLICK), _struct(("string", "geo__country")), DT
)
_MATCHED_APP_EVENTS = _joined(
    CONVERSION_FLAGS,
    _struct(
        ("long", "install__at customer_revenue_micros custom_event_id"),
        ("boolean", "first_occurrence"),
        ("string", "install__geo__country reeng_click__geo__country attribution_event__click__geo__country"),
    ),
    *[_prefixed(p, CLICK) for p in ("install__ad_click__", "reeng_click__", "attribution_event__click__")],
    DT,
)

FACTS = {
    "impressions": _joined(IMPRESSION, _struct(("long", "spend_micros revenue_micros")), DT),
    "ad_clicks": _CLICKS,
    "view_clicks": _CLICKS,
    "matched_installs": _MATCHED_INSTALLS,
    "unmatched_installs": _joined(_MATCHED_INSTALLS, TRACKER_PARAMS, _struct(("string", "ad_click__geo__country"))),
    "matched_app_events": _MATCHED_APP_EVENTS,
    "unmatched_app_events": _joined(_MATCHED_APP_EVENTS, TRACKER_PARAMS, _struct(("string", "geo__country"))),
}

DIMENSIONS = {
    "campaigns": _struct(
        ("long", "id customer_id app_id tracker_id campaign_type_id cpa_target_event_id"),
        ("string", "display_name state current_optimization_state salesforce_campaign_id"),
        ("double", "vt_cap"),
    ),
    "goals": _struct(("long", "campaign_id"), ("int", "priority"), ("string", "type"), ("double", "target_value")),
    "treasurer_configs": _struct(("long", "campaign_id"), ("double", "target")),
    "customers": _struct(("long", "id"), ("string", "company")),
    "trackers": _struct(("long", "id"), ("string", "name")),
    "apps": _struct(
        ("long", "id customer_id"),
        ("string", "display_name category"),
        ("boolean", "video_viewthrough_enabled banner_viewthrough_enabled"),
        ("boolean", "interstitial_viewthrough_enabled native_viewthrough_enabled"),
    ),
    "ad_groups": _struct(("long", "id"), ("string", "display_name bid_type"), ("boolean", "exploratory")),
    "campaign_types": _struct(("long", "id"), ("string", "name")),
    "crm_campaigns": _struct(
        ("string", "campaign_id_18_digit__c sales_region__c sales_sub_region__c service_level__c opportunity__c dt")
    ),
    "crm_opportunities": _struct(("string", "opportunity_id_18_digit__c scale_zone__c dt")),
}

SERIES = {
    "ad_group_results": _struct(
        ("timestamp", "time_bucket"),
        ("longs", "ab_test_group_ids"),
        ("long", "ad_group_id"),
        (
            "double",
            "predicted_revenue_micros suggested_revenue_micros planned_revenue_micros suggested_bid_target_micros",
        ),
    ),
    "ad_group_history": _struct(
        ("timestamp", "time_bucket"),
        ("longs", "ab_test_group_ids"),
        ("long", "ad_group_id revenue_micros bid_target_micros"),
        ("boolean", "enabled estimated"),
    ),
}

_SEGMENT_V2 = "platform model_type"
_SEGMENT_V1 = "platform model_type exchange_group ad_format_group"


def _axis(name: str) -> StructType:
    return _struct(("double", f"{name}_percentile_low {name}_percentile_high"), ("string", f"{name}_percentile"))


BUCKETS = {
    "prediction_bucket_v1": _joined(
        _struct(("string", _SEGMENT_V1)), _axis("convx"), _axis("private_cpm"), _axis("cpm")
    ),
    "prediction_bucket_v2": _joined(_struct(("string", _SEGMENT_V2)), _axis("convx"), _axis("private_cpm")),
}

_SKETCHED_DAY = (("string", "day"), ("long", "own_day"), ("boolean", "first_hour"))

# Quantile sketches of a day's impressions, by `dt` days.
SKETCHES = {
    "bucket_sketches_v1": _struct(
        ("string", _SEGMENT_V1), *_SKETCHED_DAY, ("binary", "convx private_cpm cpm"), ("string", "dt")
    ),
    "bucket_sketches_v2": _struct(("string", _SEGMENT_V2), *_SKETCHED_DAY, ("binary", "convx private_cpm"), ("string", "dt")),
}

SCHEMAS = {**FACTS, **DIMENSIONS, **SERIES, **BUCKETS, **SKETCHES}
