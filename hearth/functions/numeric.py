"""Numeric and categorical column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DEAL_LABELS, FAIR_BAND, RON_PER_EUR


def safe_ratio(num: Column, den: Column) -> Column:
    """num/den when den > 0, else 0.0 (a NULL den gives 0.0, a NULL num with den > 0 gives NULL)."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def binary01(c: Column, dtype: T.DataType | None = None) -> Column:
    """True → 1, anything else (False, NULL) → 0; integers already encoded pass through."""
    if dtype is not None and isinstance(dtype, T.IntegralType):
        return F.when(c == 1, F.lit(1)).otherwise(F.lit(0))
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def default_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def to_eur(price: Column, currency: Column, ron_per_eur: float = RON_PER_EUR) -> Column:
    return F.when(F.upper(currency) == "RON", price / F.lit(ron_per_eur)).otherwise(price.cast("double"))


def fair_band(pred: Column, band: float = FAIR_BAND) -> tuple[Column, Column]:
    return pred * F.lit(1.0 + band), pred * F.lit(1.0 - band)


def delta_percent(asking: Column, pred: Column) -> Column:
    return F.when(pred > 0, (asking - pred) / pred * 100.0).otherwise(F.lit(0.0))


def deal_label(asking: Column, pred: Column, band: float = FAIR_BAND) -> Column:
    """Great, fair or overpriced; NULL when either price is missing."""
    hi, lo = fair_band(pred, band)
    great, fair, over = DEAL_LABELS
    label = F.when(asking > hi, F.lit(over)).when(asking < lo, F.lit(great)).otherwise(F.lit(fair))
    return F.when(asking.isNotNull() & pred.isNotNull(), label)
