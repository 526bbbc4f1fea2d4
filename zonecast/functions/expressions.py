"""Column expressions shared by the operators.

All of these are built-in Spark SQL expressions (they stay inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast import schema as S

__all__ = [
    "col_or_lit",
    "strike_label",
    "zone_mid",
    "dist_to_zone_center",
    "zone_number",
    "probability_band",
    "strike_call",
    "safe_div",
]


def col_or_lit(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def strike_label(description: str | Column = "description",
                 strikes: Sequence[str] = S.STRIKE_DESCRIPTIONS,
                 balls: Sequence[str] = S.BALL_DESCRIPTIONS) -> Column:
    """1 for a strike description, 0 for a ball description, else null (exact, case-sensitive)."""
    d = col_or_lit(description)
    return F.when(d.isin(list(strikes)), F.lit(1)).when(d.isin(list(balls)), F.lit(0)).cast("int")


def zone_mid(top: str | Column = "sz_top", bot: str | Column = "sz_bot") -> Column:
    return (col_or_lit(top) + col_or_lit(bot)) / F.lit(2.0)


def dist_to_zone_center(x: str | Column = "plate_x", z: str | Column = "plate_z",
                        mid: str | Column = "zone_mid") -> Column:
    x, z, mid = col_or_lit(x), col_or_lit(z), col_or_lit(mid)
    dz = z - mid
    return F.sqrt(x * x + dz * dz)


def zone_number(x_idx: str | Column, z_idx: str | Column, nx: int = 3, nz: int = 3) -> Column:
    """Zone number 1..nx*nz counted from the top-left cell."""
    return (F.lit(nz - 1) - col_or_lit(z_idx)) * F.lit(nx) + col_or_lit(x_idx) + F.lit(1)


def probability_band(p: str | Column, high: float = 0.7, moderate: float = 0.5) -> Column:
    p = col_or_lit(p)
    return F.when(p >= F.lit(high), "high").when(p >= F.lit(moderate), "moderate").otherwise("low")


def strike_call(p: str | Column, cut: float = 0.5) -> Column:
    p = col_or_lit(p)
    return F.when(p >= F.lit(cut), "Strike").otherwise("Ball")


def safe_div(num: Column, den: Column, default=0.0) -> Column:
    """num/den, or ``default`` when den is 0 (ANSI mode would raise on x/0)."""
    return F.when(den == 0, F.lit(default)).otherwise(num.cast("double") / den.cast("double"))


def _edge(i: Column, lo: Column, hi: Column, step: Column, n: int) -> Column:
    return F.when(i >= F.lit(n), hi).otherwise(i.cast("double") * step + lo)


def uniform_bin(x: str | Column, lo: Column, hi: Column, n: int, closed: str = "right") -> Column:
    """0-based index of x among n equal-width bins over [lo, hi] with edges
    ``i*((hi-lo)/n) + lo`` (last edge exactly hi), computed in O(1) per row.

    ``closed='right'``: bins (e_i, e_i+1], the lowest edge included (pandas ``cut``
    with ``include_lowest``).  ``closed='left'``: bins [e_i, e_i+1), the last one
    closed (NumPy ``histogram``).  The arithmetic guess is corrected against the
    actual edges, so results equal counting edges below x.  Null x gives null;
    x outside [lo, hi] is the caller's concern; with lo = hi the middle bin is taken
    (pandas ``cut`` widens a single value evenly to both sides).
    """
    x = col_or_lit(x)
    step = (hi - lo) / F.lit(float(n))
    g = F.least(F.greatest(F.floor(F.try_divide(x - lo, step)), F.lit(0)), F.lit(n - 1)).cast("int")
    e_g, e_next = _edge(g, lo, hi, step, n), _edge(g + 1, lo, hi, step, n)
    if closed == "right":
        b = F.when((x <= e_g) & (g > 0), g - 1).when((x > e_next) & (g < n - 1), g + 1).otherwise(g)
    else:
        b = F.when((x < e_g) & (g > 0), g - 1).when((x >= e_next) & (g < n - 1), g + 1).otherwise(g)
    return F.when(x.isNotNull() & (hi > lo), b).when(x.isNotNull() & (hi == lo), F.lit((n - 1) // 2))


__all__ += ["uniform_bin"]
