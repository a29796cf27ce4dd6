"""Training jobs of the two bucket tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from funnelspark.functions import recode
from funnelspark.functions.numbers import micros
from funnelspark.functions.text import quoted_list
from funnelspark.functions.times import day_ms, day_plus, day_range
from funnelspark.operators.buckets import bucket_grid, segments_from_cuts, train_buckets
from funnelspark.operators.funnel import private_price
from funnelspark.operators.percentiles import merged_cuts, sketches
from funnelspark.sources.readers import PartitionedTable, scan_hours

KEYS_V1 = ("platform", "exchange_group", "model_type", "ad_format_group")
AXES_V1 = ("convx", "private_cpm", "cpm")
KEYS_V2 = ("platform", "model_type")
AXES_V2 = ("convx", "private_cpm")

# Platforms the two-axis table covers.
PLATFORMS_V2 = ("ANDROID", "IOS")

_KEY = {
    "platform": "bid__app_platform",
    "exchange_group": recode.exchange_group("bid__bid_request__exchange"),
    "model_type": recode.model_type("bid__price_data__model_type"),
    "ad_format_group": recode.ad_format_group("bid__creative__ad_format"),
}
_AXIS = {
    "convx": "bid__price_data__conversion_likelihood",
    "private_cpm": f"{private_price('bid__')} / 1e6D",
    "cpm": micros("bid__price_cpm_micros"),
}


_NAMED = "bid__price_data__model_type <> ''"
_ON_V2 = f"bid__app_platform in {quoted_list(PLATFORMS_V2)}"


def _training_rows(impressions: DataFrame | PartitionedTable, start: str, end: str, closed: str) -> DataFrame:
    """Impressions whose partition and own day are both in range, with a model named."""
    return scan_hours(impressions, start, end, closed).where(f"{day_range('at', start, end, closed)} and {_NAMED}")


def train_segments_v1(impressions: DataFrame, start: str, end: str, method: str = "sketch", **options) -> DataFrame:
    """Interval arrays on three axes per four-key segment. Both ends are exclusive: the first hour is not used."""
    return train_buckets(
        _training_rows(impressions, start, end, "neither"),
        {k: _KEY[k] for k in KEYS_V1},
        {a: _AXIS[a] for a in AXES_V1},
        method,
        **options,
    )


def train_segments_v2(impressions: DataFrame, start: str, end: str, method: str = "sketch", **options) -> DataFrame:
    """Interval arrays on two axes per platform and model type; half-open range."""
    rows = _training_rows(impressions, start, end, "left").where(_ON_V2)
    return train_buckets(
        rows, {k: _KEY[k] for k in KEYS_V2}, {a: _AXIS[a] for a in AXES_V2}, method, **options
    )


def prediction_bucket_v1(impressions: DataFrame, start: str, end: str, method: str = "sketch", **options) -> DataFrame:
    """The three-axis grid table; store it with `write_once`."""
    segments = train_segments_v1(impressions, start, end, method, **options)
    return bucket_grid(
        segments.select("platform", "model_type", "exchange_group", "ad_format_group", *AXES_V1), AXES_V1
    )


def prediction_bucket_v2(impressions: DataFrame, start: str, end: str, method: str = "sketch", **options) -> DataFrame:
    """The two-axis grid table; store it with `write_once`."""
    return bucket_grid(train_segments_v2(impressions, start, end, method, **options), AXES_V2)


def _daily_sketches(rows: DataFrame, keys: tuple[str, ...], axes: tuple[str, ...], **options) -> DataFrame:
    named = {
        **{k: _KEY[k] for k in keys},
        "day": "substr(dt, 1, 10)",
        "own_day": day_ms("at"),
        "first_hour": "substr(dt, 12, 2) = '00'",
    }
    shaped = rows.selectExpr(*[f"{sql} as {name}" for name, sql in named.items()], *[f"{_AXIS[a]} as {a}" for a in axes])
    return sketches(shaped.dropna(subset=list(keys)), list(named), {a: a for a in axes}, **options)


def daily_sketches_v1(impressions: DataFrame | PartitionedTable, day: str, until: str | None = None, **options) -> DataFrame:
    """What the three-axis table is trained from, for one day (or [day, until)): a sketch per segment and axis.

    Only that day's impressions are read. Store with `write_hours(..., day, until, at="day")`; training
    windows are then merged from stored days. A partition's rows are kept apart by their own day, which
    the window tests too, and by whether they are of the first hour, which a window with an open start
    leaves out.
    """
    rows = scan_hours(impressions, f"{day}T00", f"{until or day_plus(day, 1)}T00").where(_NAMED)
    return _daily_sketches(rows, KEYS_V1, AXES_V1, **options)


def daily_sketches_v2(impressions: DataFrame | PartitionedTable, day: str, until: str | None = None, **options) -> DataFrame:
    """The same for the two-axis table."""
    rows = scan_hours(impressions, f"{day}T00", f"{until or day_plus(day, 1)}T00").where(f"{_NAMED} and {_ON_V2}")
    return _daily_sketches(rows, KEYS_V2, AXES_V2, **options)


def _stored_window(stored: DataFrame | PartitionedTable, start: str, end: str, closed: str) -> DataFrame:
    """Sketches of the rows that `_training_rows` would give."""
    if not (start.endswith("T00") and end.endswith("T00")):
        raise ValueError(f"stored sketches are of whole days, not {start} to {end}")
    rows = scan_hours(stored, start[:10], end[:10], "both")
    first = "true" if closed in ("left", "both") else "not first_hour"
    last = "first_hour" if closed in ("right", "both") else "false"
    return rows.where(
        f"(dt > '{start[:10]}' or {first}) and (dt < '{end[:10]}' or {last}) and {day_range('own_day', start, end, closed)}"
    )


def stored_segments_v1(stored: DataFrame | PartitionedTable, start: str, end: str) -> DataFrame:
    """`train_segments_v1` from stored daily sketches: one row per day and segment is read, no impression."""
    cuts = merged_cuts(_stored_window(stored, start, end, "neither"), KEYS_V1, AXES_V1)
    return segments_from_cuts(cuts, KEYS_V1, AXES_V1)


def stored_segments_v2(stored: DataFrame | PartitionedTable, start: str, end: str) -> DataFrame:
    """`train_segments_v2` from stored daily sketches."""
    cuts = merged_cuts(_stored_window(stored, start, end, "left"), KEYS_V2, AXES_V2)
    return segments_from_cuts(cuts, KEYS_V2, AXES_V2)
