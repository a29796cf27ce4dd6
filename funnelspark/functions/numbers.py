"""Numeric expressions whose null, NaN and division rules differ from Spark's defaults."""

from __future__ import annotations


def ieee_div(numerator: str, denominator: str) -> str:
    """Floating division that yields ±Infinity or NaN at zero instead of raising.

    At zero the result is the numerator times Infinity, which has the sign of the numerator, is
    NaN for zero and stays null for null. Zero divisors are taken as positive zero.
    """
    n, d = f"cast({numerator} as double)", f"cast({denominator} as double)"
    return f"(case when {d} = 0 then {n} * double('Infinity') else {n} / {d} end)"


def cap(value: str, ceiling: float) -> str:
    """The smaller of value and ceiling; null stays null (Spark's `least` would return the ceiling)."""
    return f"(case when {value} is not null then least({value}, double('{float(ceiling)!r}')) end)"


def micros(value: str) -> str:
    """Millionths to units."""
    return f"(cast({value} as double) / 1e6D)"


def per_impression(cpm_micros: str) -> str:
    """Price per thousand in millionths to price per impression in units."""
    return f"(cast({cpm_micros} as double) / 1e9D)"


def norm_likelihood(value: str, in_micros: str) -> str:
    """Likelihood on one scale: revenue-type models store theirs in millionths."""
    return f"cast(case when {in_micros} then {value} / 1e6D else {value} end as double)"


def is_special(value: str) -> str:
    """NaN or ±Infinity; null for null."""
    v = f"cast({value} as double)"
    return f"(case when {value} is not null then isnan({v}) or abs({v}) = double('Infinity') end)"


def finite_or_null(value: str) -> str:
    return f"(case when not {is_special(value)} then {value} end)"


def clamp_or_zero(value: str, low: int, high: int) -> str:
    """The value when strictly between the limits, else (also for null) zero."""
    return f"(case when {value} > {low} and {value} < {high} then {value} else 0 end)"


#: Limbs a number is cut into for `exact_sum`: multiples of these, each below 2 ** 31 of the next.
LIMBS = (2.0**31, 1.0, 2.0**-31, 2.0**-62)


def _limbs(value: str) -> list[str]:
    """Whole numbers, all of its sign, that add up, times LIMBS, to the value, but for what is below 2 ** -62 of it."""
    rest, out = value, []
    for unit in LIMBS:
        whole = f"cast(({rest}) / {unit!r}D as bigint)"
        out.append(whole)
        rest = f"({rest}) - cast({whole} as double) * {unit!r}D"
    return out


def exact_parts(value: str) -> list[str]:
    """What `exact_sum` adds up of a number: four whole numbers, and the number itself where it has none."""
    small = f"abs({value}) < {2.0**62!r}D"
    parts = [f"case when {small} then {limb} end" for limb in _limbs(value)]
    return [*parts, f"case when {value} is not null and not ({small}) then {value} end"]


def exact_total(sums: list[str]) -> str:
    """The sum, from the sums of the five parts."""
    high, one, low, least = (f"cast({part} as double) * {unit!r}D" for part, unit in zip(sums, LIMBS))
    known = f"{sums[0]} is not null or {sums[-1]} is not null"
    whole = f"({high}) + (({one}) + (({low}) + ({least})))"
    return f"(case when {known} then coalesce({sums[-1]}, 0D) + coalesce({whole}, 0D) end)"


def exact_sum(value: str) -> str:
    """Sum of doubles that is the same to the last bit in whatever order, and however grouped, rows come.

    Every number is cut into whole multiples of four powers of two, which are added as integers; the four
    sums are put together at the end. What a number has below 2 ** -62 is cut off. NaN and infinities, and
    numbers of 2 ** 62 and more, are added apart as doubles; nulls are skipped, and no numbers give null.
    Good for some two thousand million rows to a group; more raise an overflow error. `value` should
    be a column, since it is repeated.
    """
    return exact_total([f"sum({part})" for part in exact_parts(value)])
