"""Column-level helpers.  All of them build JVM expressions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or_lit(df_columns, name: str, default) -> Column:
    """``row.get(name, default)``: the column when present, else a literal."""
    return F.col(name) if name in df_columns else F.lit(default)


def clip(c: Column, lo=None, hi=None) -> Column:
    """``clip(lo, hi)`` — NULL stays NULL."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def nonzero(c: Column, fallback=1.0) -> Column:
    """``x.replace(0, fallback)`` — the safe denominator used throughout."""
    return F.when(c == 0, F.lit(fallback)).otherwise(c)


def safe_div(num: Column, den: Column, fallback=1.0) -> Column:
    """num / (den, or ``fallback`` where den == 0).  ANSI-safe."""
    return num / nonzero(den, fallback)


def round_half_even(c: Column, digits: int) -> Column:
    """Python/NumPy ``round`` (banker's rounding)."""
    return F.bround(c, digits)


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))


def snake_case(c: Column) -> Column:
    """``s.lower().replace(' ', '_')``"""
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def title_from_snake(c: Column) -> Column:
    """``s.replace('_', ' ').title()`` for identifier-like strings."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def fmt_int_half_even(c: Column) -> Column:
    """``f'{x:.0f}'`` — half-even integer text without grouping."""
    return F.bround(c, 0).cast("bigint").cast("string")


def fmt_grouped(c: Column, digits: int = 0) -> Column:
    """``f'{x:,.{d}f}'`` — thousands separators, half-even."""
    return F.format_number(c, digits)


def fmt_currency(c: Column) -> Column:
    """``f'₹{x:,.0f}'``, NULL → ``N/A``."""
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.concat(F.lit("₹"), F.format_number(c, 0)))


def fmt_fixed(c: Column, digits: int) -> Column:
    """``f'{x:.{d}f}'`` without grouping; NULL → ``N/A``."""
    txt = F.replace(F.format_number(c, digits), F.lit(","), F.lit(""))
    return F.when(c.isNull(), F.lit("N/A")).otherwise(txt)


def fmt_percent(c: Column, digits: int) -> Column:
    """``f'{x:.{d}%}'``"""
    return F.concat(F.replace(F.format_number(c * 100, digits), F.lit(","), F.lit("")), F.lit("%"))


def fmt_signed(c: Column, digits: int) -> Column:
    """``f'{x:+.{d}f}'``"""
    body = F.replace(F.format_number(c, digits), F.lit(","), F.lit(""))
    return F.when(body.startswith("-"), body).otherwise(F.concat(F.lit("+"), body))


def unit_scale(total: Column) -> Column:
    """Crore above 1e7, else lakh: ``₹{x/1e7:.1f} Cr`` / ``₹{x/1e5:.1f} L``."""
    cr = F.concat(F.lit("₹"), fmt_fixed(total / 1e7, 1), F.lit(" Cr"))
    lk = F.concat(F.lit("₹"), fmt_fixed(total / 1e5, 1), F.lit(" L"))
    return F.when(total > 1e7, cr).otherwise(lk)


def color_band(score: Column) -> Column:
    """Traffic-light band of a 0–100 score (≥65 good, ≥40 watch, else weak)."""
    return (F.when(score >= 65, F.lit("success"))
            .when(score >= 40, F.lit("warning"))
            .otherwise(F.lit("danger")))


def parse_cutoff(key: Column) -> Column:
    """``int(k.replace('top_', '').replace('pct', ''))``"""
    return F.regexp_extract(key, r"^top_(\d+)pct$", 1).cast("int")


def month_bucket(date_col: Column) -> Column:
    """Calendar-month bucket (first day of the month, DATE)."""
    return F.trunc(date_col, "MM")
