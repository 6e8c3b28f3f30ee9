"""Small helpers to compose oracle SQL (DuckDB dialect) from the same column lists the Spark side uses."""

from __future__ import annotations


def snap(expr: str, digits: int = 6) -> str:
    """Same deterministic rounding as ``agrospark.functions.snap`` (binary grid 2^k >= 10^digits)."""
    from agrospark.functions.numeric import _grid
    g = f"cast({_grid(digits)!r} as double)"
    return f"(floor(({expr}) * {g} + 0.5) / {g})"


def snapped(cols, digits: int = 6, keep=()) -> str:
    return ",\n  ".join(c if c in keep else f"{snap(c, digits)} as {c}" for c in cols)


def ctes(**parts) -> str:
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in parts.items())
