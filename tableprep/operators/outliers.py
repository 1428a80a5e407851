"""Outliers by IQR (stage "outliers", E1-E8).

Fences come from exact quantiles (bracket refinement, see ``functions.stats``)
or, with ``exact=False``, from one ``percentile_approx`` sketch per column.
Counting, flagging, clipping and dropping are single projections/aggregates
over fitted literals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_of, col, numeric_columns
from ..functions.stats import quantiles

# Fixed values of the outlier rules.
IQR_FACTOR = 1.5
ACTIONS = ("flag", "clip", "drop")


@dataclass(frozen=True)
class Fence:
    q1: float | None
    q3: float | None

    @property
    def iqr(self):
        return None if self.q1 is None else self.q3 - self.q1

    @property
    def lower(self):
        return None if self.q1 is None else self.q1 - IQR_FACTOR * self.iqr

    @property
    def upper(self):
        return None if self.q3 is None else self.q3 + IQR_FACTOR * self.iqr


@dataclass(frozen=True)
class OutlierFit:
    fences: dict            # column -> Fence (schema order)

    @property
    def columns(self):
        return list(self.fences)


def fit_outliers(df: DataFrame, cols=None, protect=(), exact: bool = True) -> OutlierFit:   # E1
    cols = numeric_columns(df, exclude=protect) if cols is None else list(cols)
    qs = quantiles(df, cols, [0.25, 0.75], exact=exact)
    return OutlierFit({c: Fence(qs[c][0], qs[c][1]) for c in cols})


def outlier_cond(c: str, f: Fence) -> Column:
    """Strictly outside the fences; NULL is never an outlier."""
    if f.q1 is None:
        return F.lit(False)
    x = col(c).cast("double")
    return F.coalesce((x < F.lit(f.lower)) | (x > F.lit(f.upper)), F.lit(False))


def any_outlier(fit: OutlierFit) -> Column:
    return any_of([outlier_cond(c, f) for c, f in fit.fences.items()])


def outlier_report(df: DataFrame, fit: OutlierFit) -> DataFrame:                         # E2, E7
    """``(column, outlier_count, lower_bound, upper_bound, pct_outliers)`` in one aggregate."""
    rows = F.count(F.lit(1))
    structs = []
    for c, f in fit.fences.items():
        n = F.count_if(outlier_cond(c, f))
        structs.append(F.struct(
            F.lit(c).alias("column"), n.alias("outlier_count"),
            F.bround(F.lit(f.lower).cast("double"), 4).alias("lower_bound"),
            F.bround(F.lit(f.upper).cast("double"), 4).alias("upper_bound"),
            F.bround(F.try_divide(n.cast("double"), rows.cast("double")) * 100, 2).alias("pct_outliers")))
    if not structs:
        return df.sparkSession.createDataFrame(
            [], "column string, outlier_count long, lower_bound double, upper_bound double, pct_outliers double")
    return df.agg(F.array(*structs).alias("a")).select(F.inline("a"))


def report_and_total(df: DataFrame, fit: OutlierFit):
    """Per-column report rows and the any-column row count from ONE aggregate."""
    rows = F.count(F.lit(1))
    cols = list(fit.fences.items())
    row = df.agg(rows.alias("rows"), F.count_if(any_outlier(fit)).alias("total"),
                 *[F.count_if(outlier_cond(c, f)).alias(f"n{i}") for i, (c, f) in enumerate(cols)]).first()
    n = row["rows"]
    rep = []
    for i, (c, f) in enumerate(cols):
        k = row[f"n{i}"]
        rep.append({"column": c, "outlier_count": k,
                    "lower_bound": None if f.lower is None else round(float(f.lower), 4),
                    "upper_bound": None if f.upper is None else round(float(f.upper), 4),
                    "pct_outliers": round(k / n * 100, 2) if n else None})
    return rep, row["total"], n


def total_outlier_rows(df: DataFrame, fit: OutlierFit) -> DataFrame:                     # E3
    return df.agg(F.count_if(any_outlier(fit)).alias("total_outlier_rows"),
                  F.count(F.lit(1)).alias("rows"))


def clip(df: DataFrame, fit: OutlierFit) -> DataFrame:                                   # E4
    """Winsorise to the fences; NULL stays NULL (``least/greatest`` would fill it)."""
    out = []
    for c in df.columns:
        f = fit.fences.get(c)
        if f is None or f.q1 is None:
            out.append(col(c))
            continue
        x = col(c).cast("double")
        out.append(F.when(x < F.lit(f.lower), F.lit(f.lower))
                   .when(x > F.lit(f.upper), F.lit(f.upper)).otherwise(x).alias(c))
    return df.select(*out)


def flag(df: DataFrame, fit: OutlierFit) -> DataFrame:                                   # E5
    return df.select("*", *[outlier_cond(c, f).alias(f"{c}_outlier") for c, f in fit.fences.items()])


def drop_rows(df: DataFrame, fit: OutlierFit) -> DataFrame:                              # E6
    return df.where(~any_outlier(fit))


def apply_outliers(df: DataFrame, fit: OutlierFit, action: str = "flag") -> DataFrame:
    if action == "clip":
        return clip(df, fit)
    if action == "flag":
        return flag(df, fit)
    if action == "drop":
        return drop_rows(df, fit)
    raise ValueError(f"unknown outlier action {action!r}; expected one of {ACTIONS}")


def zscore_flags(df: DataFrame, cols=None, threshold: float = 3.0) -> DataFrame:         # E8
    """Extension: ``|x - mean| / std > threshold`` per numeric column (one aggregate)."""
    cols = numeric_columns(df) if cols is None else list(cols)
    row = df.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_samp(col(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    flags = []
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        if m is None or not s:
            flags.append(F.lit(False).alias(f"{c}_zflag"))
        else:
            z = F.abs((col(c).cast("double") - F.lit(m)) / F.lit(s))
            flags.append(F.coalesce(z > F.lit(threshold), F.lit(False)).alias(f"{c}_zflag"))
    return df.select("*", *flags)
