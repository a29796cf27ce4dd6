"""Epoch-millisecond and hour-string expressions.

Everything is plain UTC arithmetic on longs and strings, so results do not depend on the
session time zone, and comparisons on raw columns reach the file scan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from funnelspark.functions.text import quoted

HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def _floor_to(ms: str, unit_ms: int) -> str:
    seconds = f"({ms} - {ms} % 1000)"  # whole seconds, cut toward zero
    return f"({seconds} - pmod({seconds}, {unit_ms}))"


def hour_ms(ms: str) -> str:
    """Start of the hour, as epoch milliseconds. Group by this; format after aggregating."""
    return _floor_to(ms, HOUR_MS)


def iso_text(ms: str) -> str:
    """`yyyy-MM-ddTHH:mm:ssZ` for whole-second epoch milliseconds; null stays null."""
    at = f"timestampadd(SECOND, {ms} div 1000, timestamp_ntz'1970-01-01 00:00:00')"
    return f"concat(translate(cast({at} as string), ' ', 'T'), 'Z')"


def day_ms(ms: str) -> str:
    """Start of the day, as epoch milliseconds."""
    return _floor_to(ms, DAY_MS)


def iso_hour(ms: str) -> str:
    return iso_text(hour_ms(ms))


def iso_day(ms: str) -> str:
    return iso_text(_floor_to(ms, DAY_MS))


def hour_plus(hour: str, hours: int) -> str:
    """Shift a `YYYY-MM-DDTHH` hour string (a value, not an expression)."""
    shifted = datetime.strptime(hour, "%Y-%m-%dT%H") + timedelta(hours=hours)
    return shifted.strftime("%Y-%m-%dT%H")


def day_plus(day: str, days: int) -> str:
    """Shift a `YYYY-MM-DD` day string (a value, not an expression)."""
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def hours_between(start: str, until: str) -> list[str]:
    """The hour strings of [start, until), or the day strings where the bounds are days."""
    step = day_plus if len(start) == 10 else hour_plus
    hours = []
    while start < until:
        hours.append(start)
        start = step(start, 1)
    return hours


def hour_range(dt: str, low: str, high: str, closed: str = "left") -> str:
    """Lexicographic range on an hour-string partition column; the bounds are values.

    closed: "left" [low, high), "both" [low, high], "neither" (low, high), "right" (low, high].
    """
    if closed not in ("left", "right", "both", "neither"):
        raise ValueError(f"closed must be left, right, both or neither, not {closed!r}")
    above = ">=" if closed in ("left", "both") else ">"
    below = "<=" if closed in ("right", "both") else "<"
    return f"({dt} {above} {quoted(low)} and {dt} {below} {quoted(high)})"


def _first_day_ms(bound: str, strictly_after: bool) -> int:
    """Start of the first day whose `iso_day` text sorts after (or at) the bound string."""
    day = date.fromisoformat(bound[:10])
    text = f"{day.isoformat()}T00:00:00Z"
    if text < bound or (strictly_after and text == bound):
        day += timedelta(days=1)
    return (day - date(1970, 1, 1)).days * DAY_MS


def day_range(ms: str, low: str, high: str, closed: str = "left") -> str:
    """Range on the event's own day, with bounds given as strings, tested on the raw epoch column.

    Same rows as comparing `iso_day(ms)` with the bounds as text, since that text grows with
    the day; but a comparison on the stored column is pushed into the Parquet scan.
    """
    start = _first_day_ms(low, strictly_after=closed in ("right", "neither"))
    end = _first_day_ms(high, strictly_after=closed in ("right", "both"))
    return f"({ms} >= {start} and {ms} < {end})"


def in_cohort(at_hour: str, anchor_hour: str, days: int) -> str:
    """True when less than `days` full days lie between anchor and event; null without an anchor.

    There is no lower limit: an event before its anchor counts.
    """
    return f"({at_hour} - {anchor_hour} < {days * DAY_MS})"
