"""Bucket assignment as a plain range join on grid rows, to compare the library's lookup with."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_bucket(value: str, low: str, high: str) -> str:
    """Half-open range with an open end when high is null; NaN is in no range."""
    return f"({value} >= {low} and ({high} is null or {value} < {high}) and not isnan({value}))"


def assign_bucket_by_grid(
    facts: DataFrame,
    grid: DataFrame,
    keys: Mapping[str, str],
    axes: Mapping[str, tuple[str, float]],
) -> DataFrame:
    """Tests every cell of the segment per row: for small inputs."""
    cells = [f"{a}_percentile{suffix}" for a in axes for suffix in ("_low", "_high", "")]
    side = grid.selectExpr(*[f"{k} as _key_{k}" for k in keys], *cells)
    probe = facts.selectExpr(
        "*",
        *[f"{sql} as _probe_{k}" for k, sql in keys.items()],
        *[f"cast({sql} as double) as _value_{a}" for a, (sql, _) in axes.items()],
    )
    on = [f"_probe_{k} = _key_{k}" for k in keys]
    on += [
        in_bucket(
            f"_value_{a}",
            f"{a}_percentile_low * {float(factor)!r}D",
            f"{a}_percentile_high * {float(factor)!r}D",
        )
        for a, (_, factor) in axes.items()
    ]
    return probe.join(side, F.expr(" and ".join(on))).select(*facts.columns, *cells)
