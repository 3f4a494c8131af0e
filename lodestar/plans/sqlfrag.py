"""SQL fragments shared by oracle queries (DuckDB dialect)."""

from __future__ import annotations


def R(e: str, n: int = 6) -> str:
    return f"(round({e}, {n}) + 0.0)"


def DOT(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"


def SQD(a: str, b: str) -> str:
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def NORM(a: str) -> str:
    return f"sqrt(list_sum(list_transform({a}, lambda x: x * x)))"
