"""Column classification and small expression helpers (all JVM-side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = "numeric"
STRING = "string"
DATETIME = "datetime"
BOOLEAN = "boolean"
OTHER = "other"


def q(name: str) -> str:
    """Back-quote a column name so dots and spaces survive."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def family(dt: T.DataType) -> str:
    if isinstance(dt, T.BooleanType):
        return BOOLEAN
    if isinstance(dt, T.NumericType):
        return NUMERIC
    if isinstance(dt, T.StringType):
        return STRING
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return DATETIME
    return OTHER


def families(df: DataFrame) -> dict[str, str]:
    return {f.name: family(f.dataType) for f in df.schema.fields}


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns in schema order; booleans are not numeric (pandas parity)."""
    return [c for c, k in families(df).items() if k == NUMERIC and c not in exclude]


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas has one 'missing'; Spark has NULL and NaN.  Map NaN to NULL once."""
    exprs = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.nanvl(col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
            changed = True
        else:
            exprs.append(col(f.name))
    return df.select(*exprs) if changed else df


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """part/whole*100, rounded half-even like pandas; NULL when whole is 0."""
    return F.bround(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, digits)
