"""Numeric helpers shared by operators and query outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quantize(col: Column, bits: int = 24) -> Column:
    """Snap a double to the nearest multiple of ``2^-bits`` (ties up).

    Multiplying by a power of two is exact, so two engines that agree on ``col`` agree on
    the result; decimal rounding (``round(x, 6)``) is decided differently by different
    engines for values whose decimal form ends in 5 right after the cut.
    """
    scale = float(2 ** bits)
    return F.floor(col * scale + 0.5).cast("double") / scale


def quantize_sql(expr: str, bits: int = 24) -> str:
    """The same snapping as SQL text (for the DuckDB oracle)."""
    scale = float(2 ** bits)
    return f"(floor(({expr}) * {scale!r} + 0.5) / {scale!r})"
