"""Literals in SQL text."""

from __future__ import annotations

from collections.abc import Iterable


def quoted(value: str) -> str:
    """A string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def quoted_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"
