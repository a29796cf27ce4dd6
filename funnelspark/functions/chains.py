"""Choosing a value from the event chains an app event carries."""

from __future__ import annotations

from collections.abc import Sequence

# Column prefixes of the three chains.
ATTRIBUTION = "attribution_event__click__"
REENGAGEMENT = "reeng_click__"
INSTALL = "install__ad_click__"

# The two precedences in use. Which column takes which is part of the result.
LATEST_FIRST = (ATTRIBUTION, REENGAGEMENT, INSTALL)
ORIGIN_FIRST = (INSTALL, REENGAGEMENT, ATTRIBUTION)

# Where each chain keeps its country.
COUNTRY_COLUMNS = {
    ATTRIBUTION: "attribution_event__click__geo__country",
    REENGAGEMENT: "reeng_click__geo__country",
    INSTALL: "install__geo__country",
}


def first_chain(field: str, order: Sequence[str]) -> str:
    """First non-null value of a field over chain prefixes, in the given order."""
    return f"coalesce({', '.join(prefix + field for prefix in order)})"


def first_country(order: Sequence[str]) -> str:
    return f"coalesce({', '.join(COUNTRY_COLUMNS[prefix] for prefix in order)})"
