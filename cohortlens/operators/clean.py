"""Missing values and outliers.

NULL and NaN are missing throughout. Statistics are computed in as few passes
as possible and applied as literals: one pass gives the row count and each
column's number of values, min and max; one search (a sketch, then exact
counts) finds all medians and clip bounds together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import constants as K
from cohortlens.functions import clip
from cohortlens.operators.quantiles import (between, column_stats, exact_quantiles, missing, order_statistics,
                                            position)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns with a numeric type, in table order (booleans are not numeric)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: missing count, only where it is above zero; with table size."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(missing(df, c)).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    long = counts.selectExpr("_rows AS row_count", f"{len(cols)} AS column_count",
                             f"stack({len(cols)}, {pairs}) AS (column_name, missing_count)")
    return long.where(F.col("missing_count") > 0)


def _zero_imputed(name: str) -> bool:
    return any(part in name for part in K.ZERO_IMPUTE_NAME_PARTS)


def fit_imputation(df: DataFrame, exclude: tuple[str, ...] = ("member_id",),
                   stats: dict[str, tuple] | None = None) -> dict[str, float | None]:
    """Fill value per numeric column that has missing values.

    Names containing ``count``, ``total`` or ``days`` get 0, all others their
    median (exact). ``min_days_since_activity`` contains "days", so members
    with no activity at all get 0 there, as in the reference. A column with
    no value at all keeps NULL (its median is undefined).
    """
    cols = numeric_columns(df, exclude)
    stats = stats or column_stats(df, cols)
    gaps = [c for c in cols if stats[c][0] < stats["__rows__"]]
    medians = exact_quantiles(df, [c for c in gaps if not _zero_imputed(c)], [0.5], stats=stats)
    return {c: 0 if _zero_imputed(c) else medians[c][0] for c in gaps}


def apply_imputation(df: DataFrame, fills: dict[str, float | None]) -> DataFrame:
    """Missing values replaced; without a fill value they become NULL."""
    return df.withColumns({c: F.when(missing(df, c), F.lit(v)).otherwise(F.col(c)) for c, v in fills.items()})


def impute_by_name(df: DataFrame, exclude: tuple[str, ...] = ("member_id",)) -> DataFrame:
    return apply_imputation(df, fit_imputation(df, exclude))


def impute_zero(df: DataFrame, exclude: tuple[str, ...] = ("member_id",)) -> DataFrame:
    """Serving path of the reference: every numeric missing value becomes 0."""
    return df.na.fill(0, subset=numeric_columns(df, exclude))


def clip_columns(df: DataFrame, exclude: tuple[str, ...] = ("member_id",)) -> list[str]:
    """Numeric columns that get clipped: not the id, the label, or names with
    ``encoded`` / ``flag``. 0/1 flags and the helpers are clipped as well."""
    return [c for c in numeric_columns(df, exclude)
            if c != K.LABEL_COLUMN and not any(p in c for p in K.NO_CLIP_NAME_PARTS)]


def fit_clip_bounds(df: DataFrame, exclude: tuple[str, ...] = ("member_id",),
                    quantiles: tuple[float, float] = K.CLIP_QUANTILES,
                    stats: dict[str, tuple] | None = None) -> dict[str, tuple]:
    cols = clip_columns(df, exclude)
    q = exact_quantiles(df, cols, list(quantiles), stats=stats)
    return {c: tuple(q[c]) for c in cols}


def apply_clip_bounds(df: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    """``greatest(q01, least(q99, x))`` as double; a missing value stays NULL, no bounds means no clipping."""
    out = {}
    for c, (lo, hi) in bounds.items():
        x = F.when(~missing(df, c), F.col(c).cast("double"))
        out[c] = x if lo is None or hi is None else clip(x, float(lo), float(hi))
    return df.withColumns(out)


def clip_quantiles(df: DataFrame, exclude: tuple[str, ...] = ("member_id",)) -> DataFrame:
    return apply_clip_bounds(df, fit_clip_bounds(df, exclude))


def fit_missing_and_outliers(df: DataFrame, exclude: tuple[str, ...] = ("member_id",),
                             quantiles: tuple[float, float] = K.CLIP_QUANTILES
                             ) -> tuple[dict[str, float | None], dict[str, tuple]]:
    """Fill values, and the clip bounds of the filled columns, from one search.

    Filling puts ``m`` equal values v into a column, so rank k of the filled
    column is rank k of the present values if that is below v, rank k - m if
    that is above v, and else v itself. All these ranks are known before v is.
    """
    cols = numeric_columns(df, exclude)
    stats = column_stats(df, cols)
    rows = stats["__rows__"]
    gaps = [c for c in cols if stats[c][0] < rows]
    medians = [c for c in gaps if not _zero_imputed(c) and stats[c][0]]
    clipped = [c for c in clip_columns(df, exclude)]
    wanted: dict[str, set[int]] = {c: set() for c in {*medians, *clipped} if stats[c][0]}
    for c in medians:
        wanted[c].update(position(0.5, stats[c][0])[:2])
    size = {c: rows if _zero_imputed(c) or stats[c][0] else 0 for c in clipped}     # of the filled column
    for c in clipped:
        n = stats[c][0]
        for k in (k for p in quantiles if n for k in position(p, size[c])[:2]):
            wanted[c].update(x for x in (k, k - (rows - n)) if 0 <= x < n)
    values = order_statistics(df, wanted, stats)

    fills: dict[str, float | None] = {}
    for c in gaps:
        if _zero_imputed(c):
            fills[c] = 0
        else:
            low, high, share = position(0.5, stats[c][0]) if stats[c][0] else (0, 0, 0)
            fills[c] = between(values[c, low], values[c, high], share) if stats[c][0] else None

    def filled(c: str, k: int) -> float:
        """Rank ``k`` of the filled column."""
        if c not in fills:
            return values[c, k]
        v, before = float(fills[c]), k - (rows - stats[c][0])
        if (c, k) in values and values[c, k] < v:
            return values[c, k]
        return values[c, before] if (c, before) in values and values[c, before] > v else v

    bounds = {}
    for c in clipped:
        places = [position(p, size[c]) for p in quantiles] if size[c] else []
        bounds[c] = tuple(between(filled(c, low), filled(c, high), share) for low, high, share in places) or (None, None)
    return fills, bounds


def handle_missing_and_outliers(df: DataFrame, exclude: tuple[str, ...] = ("member_id",)) -> DataFrame:
    """Impute by name, then clip every eligible column to its [q01, q99]."""
    fills, bounds = fit_missing_and_outliers(df, exclude)
    return apply_clip_bounds(apply_imputation(df, fills), bounds)
