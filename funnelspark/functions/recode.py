"""Recoding of exchanges, countries, formats, models and trackers."""

from __future__ import annotations

from collections.abc import Sequence

from funnelspark.functions.text import quoted, quoted_list

# Names that keep their own group, formats and models.
EXCHANGES = (
    "VUNGLE", "APPLOVIN", "INNERACTIVE_DIRECT", "DOUBLECLICK", "MINTEGRAL",
    "IRONSOURCE", "UNITY", "APPODEAL", "INMOBI", "VERVE",
)
COUNTRIES = ("US", "GB", "IN", "JP", "BR")
REVENUE_MODELS = ("revenue", "revenue-v3")
REVENUE_BID_TYPES = ("cpr", "cprv3")
FORMATS = {
    "video": "VAST",
    "native": "native",
    "320x50": "banner",
    "728x90": "banner",
    "300x250": "mrec",
}


def keep_or_other(value: str, kept: Sequence[str], other: str = "others", emit: str | None = None) -> str:
    """Listed names unchanged, anything else (also null) one name.

    `emit` returns another expression where the tested one is listed; the emitted name itself
    need not be listed.
    """
    return f"(case when {value} in {quoted_list(kept)} then {emit or value} else {quoted(other)} end)"


def exchange_group(value: str, emit: str | None = None) -> str:
    return keep_or_other(value, EXCHANGES, emit=emit)


def country_group(value: str) -> str:
    return keep_or_other(value, COUNTRIES)


def ad_format(value: str) -> str:
    """Five reporting formats; null and unknown are html-interstitial."""
    arms = " ".join(f"when {quoted(raw)} then {quoted(name)}" for raw, name in FORMATS.items())
    return f"(case {value} {arms} else 'html-interstitial' end)"


def ad_format_group(value: str) -> str:
    return f"(case when {value} = 'video' then 'VAST' else 'Non-VAST' end)"


def is_revenue_model(value: str) -> str:
    return f"({value} in {quoted_list(REVENUE_MODELS)})"


def model_type(value: str) -> str:
    """Revenue model versions folded into one name; null stays null."""
    return f"(case when {is_revenue_model(value)} then 'revenue' else {value} end)"


def tracker_type(tracker_name: str, campaign_id: str) -> str:
    return (
        f"(case when {tracker_name} = 'apple-skan' then 'SKAN'"
        f" when {tracker_name} = 'no-tracker' then 'NON-MEASURABLE'"
        f" when {campaign_id} is null then 'N/A' else 'MMP' end)"
    )


def viewthrough_enabled(
    creative_type: str, format_name: str, video: str, banner: str, interstitial: str, native: str
) -> str:
    """Whether the app counts view-through conversions for this creative.

    The interstitial rule tests a name that `ad_format` never emits, so it never fires;
    kept because results must stay the same.
    """
    html = f"{creative_type} = 'HTML'"
    return (
        f"(case when {creative_type} = 'VAST' and {video} then true"
        f" when {format_name} in ('banner', 'mrec') and {html} and {banner} then true"
        f" when {format_name} = 'interstitial' and {html} and {interstitial} then true"
        f" when {format_name} = 'native' and {native} then true else false end)"
    )


def vio_enrolled(vt_cap: str) -> str:
    return f"coalesce({vt_cap} > 0, false)"


def name_or_na(name: str) -> str:
    return f"coalesce({name}, 'N/A')"
