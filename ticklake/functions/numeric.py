"""Numeric column helpers: safe ratios, status buckets, published types."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklake.schemas import FRESH_OK_MINUTES, FRESH_WARN_MINUTES


def pct_change(new: Column, base: Column, scale: int = 4) -> Column:
    """``100 * (new - base) / base`` for decimals, divided and rounded in decimal,
    only when ``base > 0``; published as DOUBLE after rounding."""
    return F.when(base > 0, F.round(F.lit(Decimal(100)) * (new - base) / base, scale)).cast("double")


def sla_status(age_minutes: Column, ok: float = FRESH_OK_MINUTES, warn: float = FRESH_WARN_MINUTES) -> Column:
    """OK / WARN / FAIL on the *unrounded* age."""
    return (F.when(age_minutes <= ok, F.lit("OK"))
             .when(age_minutes <= warn, F.lit("WARN"))
             .otherwise(F.lit("FAIL")))


def storable(c: Column, kind) -> Column:
    """True for a double that the decimal type can hold (NaN and infinities can't)."""
    return F.coalesce(~F.isnan(c) & c.try_cast(kind).isNotNull(), F.lit(False))
