"""Missing values (stage "missing", D1-D9).

``fit_impute`` runs one aggregate for null fractions, one for means, the
exact quantiles for medians and frequent-value summaries for modes -- each
only over the columns that need it.  ``apply_impute`` is a single projection
with the fitted fill values as literals.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC, STRING, col, families
from ..functions.heavy import top_values
from ..functions.stats import comparable_columns, python_value, quantiles

# Fixed values of the missing-value rules.
DROP_THRESHOLD = 0.7        # drop a column when its null fraction is >= this
UNKNOWN_FILL = "UNKNOWN"    # mode fill of a text column with no values
STRATEGIES = ("mean", "median", "mode", "constant", "drop")


def default_strategy(semantic: str) -> str:
    """numeric -> median; categorical, text, id, datetime, unknown -> mode."""
    return "median" if semantic == "numeric" else "mode"


@dataclass(frozen=True)
class ColumnAction:
    column: str
    null_fraction: float
    action: str                 # no_action | drop | mean | median | mode | constant
    fill: object = None
    log: str = ""


@dataclass(frozen=True)
class ImputeFit:
    actions: dict = field(default_factory=dict)   # column -> ColumnAction

    @property
    def dropped(self) -> list[str]:
        return [c for c, a in self.actions.items() if a.action == "drop"]


def null_fractions(df: DataFrame) -> DataFrame:                        # D1
    """``(column, null_fraction)`` -- one aggregate."""
    rows = F.count(F.lit(1))
    structs = [F.struct(F.lit(c).alias("column"),
                        F.try_divide(F.count_if(col(c).isNull()).cast("double"), rows.cast("double")).alias("null_fraction"))
               for c in df.columns]
    return df.agg(F.array(*structs).alias("a")).select(F.inline("a"))


def plan_actions(fractions: dict, semantic: dict, drop_threshold=DROP_THRESHOLD, overrides=None,
                 protect=()) -> dict:
    """Choose an action per column (D1-D3, D8).  Pure Python on per-column scalars."""
    overrides = overrides or {}
    out = {}
    for c, frac in fractions.items():
        if c in protect or frac is None or frac == 0:
            out[c] = "no_action"
        elif frac >= drop_threshold:
            out[c] = "drop"
        elif c in overrides:
            s = overrides[c]
            out[c] = s if s in STRATEGIES else "median"
        else:
            out[c] = default_strategy(semantic.get(c, "unknown"))
    return out


def fit_impute(df: DataFrame, semantic: dict | None = None, drop_threshold: float = DROP_THRESHOLD,
               overrides: dict | None = None, protect=(), constant=0, exact_median: bool = True,
               fractions: dict | None = None) -> ImputeFit:
    """``fractions`` (column -> null fraction) may come from an earlier profile
    of the same rows, saving a scan."""
    semantic = semantic or {}
    if isinstance(overrides, DataFrame):       # advice table (column, strategy), one row per column
        # a row without a strategy is no advice
        rows = (overrides.where(F.col("column").isin(list(df.columns)) & F.col("strategy").isNotNull())
                .groupBy("column").agg(F.max("strategy").alias("strategy")).collect())   # <= one per column
        overrides = {r["column"]: r["strategy"] for r in rows}
    fams = families(df)
    fr = dict(fractions) if fractions is not None else \
        {r["column"]: r["null_fraction"] for r in null_fractions(df).collect()}
    acts = plan_actions(fr, semantic, drop_threshold, overrides, protect)

    def numeric_ok(c):
        return fams[c] == NUMERIC

    # a mean/median on a non-numeric column falls back to mode
    for c, a in list(acts.items()):
        if a in ("mean", "median") and not numeric_ok(c):
            acts[c] = "mode"
    # a column whose values cannot be compared, or a constant its type cannot hold, is carried through
    comparable = set(comparable_columns(df))
    for c, a in list(acts.items()):
        if a == "mode" and c not in comparable or a == "constant" and not _holds(df.schema[c].dataType, constant):
            acts[c] = "skipped"
    means = [c for c, a in acts.items() if a == "mean"]
    medians = [c for c, a in acts.items() if a == "median"]
    modes = [c for c, a in acts.items() if a == "mode"]
    fills = {}
    if means:
        row = df.agg(*[F.avg(col(c)).alias(c) for c in means]).first()
        fills.update({c: row[c] for c in means})
    if medians:
        qs = quantiles(df, medians, [0.5], exact=exact_median)
        fills.update({c: qs[c][0] for c in medians})
    if modes:
        dts = {f.name: f.dataType for f in df.schema.fields}
        for c, (_, _, mode) in top_values(df, modes).items():
            fills[c] = python_value(dts[c], mode)
        for c in modes:
            if c not in fills and fams[c] == STRING:
                fills[c] = UNKNOWN_FILL
    for c, a in acts.items():
        if a == "constant":
            fills[c] = constant
    return ImputeFit({c: ColumnAction(c, fr[c], acts[c], fills.get(c), log) for c, log in plan_log(acts, fr)})


def plan_log(actions: dict, fractions: dict) -> list[tuple[str, str]]:
    """``(column, line)`` of planned actions; needs no fill values."""
    out = []
    for c, a in actions.items():
        f = fractions[c]
        if a == "no_action":
            log = "no_action (no nulls)" if not f else "no_action (protected)"
        elif a == "drop":
            log = f"dropped ({f:.0%} missing)"
        elif a == "skipped":
            log = "skipped (no fill of this type)"
        else:
            log = f"applied: {a} (was {f:.0%} null)"
        out.append((c, log))
    return out


def _holds(dt: T.DataType, value) -> bool:
    """Whether a constant fill can become a value of the column's type."""
    if isinstance(dt, T.NumericType):
        try:
            float(value)
        except (TypeError, ValueError):
            return False
        return True
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return isinstance(value, datetime.date)
    if isinstance(dt, T.BooleanType):
        return isinstance(value, bool)
    return isinstance(dt, T.StringType)


def _filled(c: str, value, dt: T.DataType):
    if isinstance(dt, T.NumericType):
        # a numeric column with holes is float in pandas; fills are doubles
        return F.coalesce(col(c).cast("double"), F.lit(float(value)))
    if isinstance(dt, T.StringType):
        value = str(value)
    elif isinstance(dt, T.TimestampNTZType) and value.tzinfo is None:
        # the text form carries microseconds and no zone
        return F.coalesce(col(c), F.lit(value.isoformat(sep=" ")).cast(dt))
    elif isinstance(dt, T.BooleanType):
        value = value if isinstance(value, bool) else value == "true"
    return F.coalesce(col(c), F.lit(value).cast(dt))


def apply_impute(df: DataFrame, fit: ImputeFit) -> DataFrame:
    """One projection: dropped columns leave, filled columns get ``coalesce``."""
    dts = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        a = fit.actions.get(c)
        if a is None or a.action == "no_action" or (a.action != "drop" and a.fill is None):
            out.append(col(c))
        elif a.action != "drop":
            out.append(_filled(c, a.fill, dts[c]).alias(c))
    return df.select(*out)


def strategy_log(fit: ImputeFit) -> list[tuple[str, str]]:               # D9
    return [(c, a.log) for c, a in fit.actions.items()]
