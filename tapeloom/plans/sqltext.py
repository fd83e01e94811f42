"""Pieces of SQL text that the oracles share."""

from __future__ import annotations

W = "PARTITION BY symbol ORDER BY date"


def over(expr: str, n: int | None = None, end: int = 0, w: str = W) -> str:
    """``expr`` over the whole series, or over the ``n`` rows that end ``end`` rows from here."""
    if n is None:
        return f"{expr} OVER ({w})"
    start = f"{n - 1 + end} PRECEDING" if n - 1 + end else "CURRENT ROW"
    stop = f"{end} PRECEDING" if end else "CURRENT ROW"
    return f"{expr} OVER ({w} ROWS BETWEEN {start} AND {stop})"


def full(agg: str, x: str, n: int, end: int = 0, w: str = W) -> str:
    return f"CASE WHEN {over(f'count({x})', n, end, w)} = {n} THEN {over(f'{agg}({x})', n, end, w)} END"


def lag(x: str, n: int = 1, w: str = W) -> str:
    return over(f"lag({x}, {n})", w=w)


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0.0))"


def flag(cond: str) -> str:
    return f"coalesce({cond}, false)::INTEGER"


def r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def filled(x: str, w: str = W) -> str:
    return f"last_value({x} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
