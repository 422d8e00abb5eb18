"""Scalar building blocks (the reference's numpy/pandas helpers, as Columns)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens import constants as K


def as_of_lit(as_of: dt.date | str) -> Column:
    """A DATE literal; the pipeline never reads the wall clock."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def days_before(as_of: dt.date | str, day: Column) -> Column:
    """Whole days from ``day`` to ``as_of`` (positive when ``day`` is earlier)."""
    return F.datediff(as_of_lit(as_of), day)


def flag(condition: Column) -> Column:
    """0/1 integer from a predicate; NULL counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def present(text: Column) -> Column:
    """1 when a free-text field holds something other than blanks."""
    return flag(text.isNotNull() & (F.trim(text) != F.lit("")))


def safe_rate(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` when the denominator is positive, else 0.0.

    The guard also keeps ANSI mode from raising on division by zero.
    """
    return (F.when(denominator > 0, numerator.cast("double") / denominator)
            .otherwise(F.lit(0.0)))


def decay_score(days: Column, rate: float = K.RECENCY_DECAY_RATE,
                cap: int = K.RECENCY_DECAY_CAP_DAYS) -> Column:
    """``exp(-rate * min(days, cap))``; a missing input stays missing.

    ``least`` skips NULLs in Spark, so the NULL check is explicit.
    """
    return F.when(days.isNotNull(), F.exp(F.lit(-rate) * F.least(days, F.lit(cap))))


def sentinel_to_null(c: Column, sentinel: int = K.RECENCY_SENTINEL) -> Column:
    return F.nullif(c, F.lit(sentinel))


def null_to_sentinel(c: Column, sentinel: int = K.RECENCY_SENTINEL) -> Column:
    return F.coalesce(c, F.lit(sentinel))


def clip(c: Column, lo: Column | float, hi: Column | float) -> Column:
    """Bound ``c`` to [lo, hi]; NULL stays NULL."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(c.isNotNull(), F.greatest(lo_c, F.least(hi_c, c)))


def risk_bucket(probability: Column) -> Column:
    """Low below .3, Medium below .6, else High, on the unrounded probability."""
    return (F.when(probability < F.lit(K.RISK_LOW_BELOW), F.lit(K.RISK_LABELS[0]))
            .when(probability < F.lit(K.RISK_MEDIUM_BELOW), F.lit(K.RISK_LABELS[1]))
            .otherwise(F.lit(K.RISK_LABELS[2])))
