"""Feature derivation (stage "features", F1-F6).

Label encoding builds a dictionary ``(column, value, code)`` from the distinct
values, ranked with a range-partitioned, fully distributed numbering.  Small
dictionaries are broadcast to code the rows; values of large ones are looked
up in long form, all columns together.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, numeric_columns
from ..functions.heavy import summaries
from ..functions.stats import SLOTS, comparable_columns, typed_value
from ..session import ensure_checkpoint_dir

# Fixed values of the feature rules.
DATE_PARTS = ("year", "month", "day", "dayofweek", "is_weekend")
WEEKEND_FROM = 5            # Monday = 0, so Saturday = 5
POLY_COLUMNS = 3            # squares for the first three numeric columns


def date_parts(df: DataFrame, cols) -> DataFrame:                                    # F1
    extra = []
    for c in cols:
        x = col(c).cast("timestamp_ntz") if not isinstance(
            df.schema[c].dataType, (T.TimestampNTZType, T.TimestampType, T.DateType)) else col(c)
        extra += [F.year(x).alias(f"{c}_year"), F.month(x).alias(f"{c}_month"),
                  F.dayofmonth(x).alias(f"{c}_day"), F.weekday(x).alias(f"{c}_dayofweek"),
                  (F.weekday(x) >= WEEKEND_FROM).alias(f"{c}_is_weekend")]
    return df.select("*", *extra)


def _ranked(values: DataFrame, order_cols) -> DataFrame:
    """Exact 0-based dense codes per column, distributed.

    Range-partition the distinct values, number them inside each partition and
    add the count of smaller values held by earlier partitions (one row per
    partition and column).  The partitioned values are checkpointed so the
    partition ids stay fixed across the two branches that read them.
    """
    from ..session import cut_lineage
    parts = cut_lineage(values.repartitionByRange("column", *order_cols)
                        .withColumn("pid", F.spark_partition_id()))
    per = parts.groupBy("column", "pid").agg(F.count(F.lit(1)).alias("k"))
    w_off = Window.partitionBy("column").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.withColumn("offset", F.coalesce(F.sum("k").over(w_off), F.lit(0))).drop("k")
    w_in = Window.partitionBy("column", "pid").orderBy(*order_cols)
    return (parts.withColumn("r", F.row_number().over(w_in))
            .join(offsets, ["column", "pid"])
            .select("column", "value", (F.col("offset") + F.col("r") - 1).cast("int").alias("code")))


def distinct_values(df: DataFrame, cols, order_by: str | None = None) -> tuple[DataFrame, list[str]]:
    """Unranked dictionary entries ``(column, value, <order keys>)``; ``value`` is the value's text."""
    fields = {f.name: f for f in df.schema.fields}
    cells = F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value"),
                               *[typed_value(fields[c])[s].alias(s) for s in SLOTS]) for c in cols])
    if order_by is None:
        return df.select(F.inline(cells)).where(F.col("value").isNotNull()).distinct(), [*SLOTS, "value"]
    firsts = (df.select(col(order_by).alias("__o"), F.inline(cells)).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.min("__o").alias("first")))
    return firsts, ["first", "value"]


def dictionary(df: DataFrame, cols, order_by: str | None = None) -> DataFrame:      # F2 / F3
    """``(column, value, code)``: sorted categories (``cat.codes``), or with
    ``order_by`` the order of first appearance (``factorize``)."""
    vals, keys = distinct_values(df, cols, order_by)
    return _ranked(vals, keys)


#: a dictionary is broadcast up to so many entries and bytes of text
MOST_ENTRIES, MOST_BYTES = 500_000, 32_000_000
#: a larger one has the codes of its most frequent values (a share above this one, at most) beside it
HEAVY_SHARE = 0.001


@dataclass(frozen=True)
class EncodeFit:
    columns: list
    table: DataFrame | None = None                  # (column, value, code)
    large: list = field(default_factory=list)       # columns whose dictionary is not broadcast
    heavy: dict = field(default_factory=dict)       # large column -> {frequent value: code}


def fit_encode(df: DataFrame, cols, order_by: str | None = None, most_entries: int = MOST_ENTRIES,
               most_bytes: int = MOST_BYTES) -> EncodeFit:
    """The dictionary of all columns, written once, and which of its columns are large."""
    cols = list(cols)
    if not cols:
        return EncodeFit([])
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"dictionary-{uuid.uuid4().hex}")
    codes = dictionary(df, cols, order_by)
    codes.write.partitionBy("column").parquet(path)
    # one folder per column: a column's dictionary is its own files
    table = spark.read.schema(codes.schema).parquet(path)
    sizes = table.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("value")).alias("b")).collect()
    large = [c for c in cols if any(r["column"] == c and (r["n"] > most_entries or r["b"] > most_bytes) for r in sizes)]
    return EncodeFit(cols, table, large, _heavy_codes(df, large, table))


def _heavy_codes(df: DataFrame, large: list, table: DataFrame) -> dict:
    """Codes of the frequent values of large columns: 1 / ``HEAVY_SHARE`` values a column at most."""
    if not large:
        return {}
    counts = summaries(df.select(*[col(c).cast("string").alias(c) for c in large]), large)
    names = F.element_at(F.array(*map(F.lit, large)), F.col("i") + 1)
    total = counts.where("str IS NULL").select(names.alias("column"), F.col("total").alias("t"))
    found = counts.where("str IS NOT NULL").select(names.alias("column"), F.col("str").alias("value"), "n").join(
        F.broadcast(total), "column").where(F.col("n") > F.col("t") * HEAVY_SHARE)
    out = {c: {} for c in large}
    for r in table.join(F.broadcast(found), ["column", "value"]).select("column", "value", "code").collect():
        out[r["column"]][r["value"]] = r["code"]
    return out


def apply_encode(df: DataFrame, fit: EncodeFit) -> DataFrame:
    """Adds ``{c}_encoded``: the code, -1 for NULL or unseen values.

    Small dictionaries are broadcast and move no row.  Of large ones the
    codes of frequent values are literals; the other values of all large
    columns together are looked up in long form, so the table is shuffled
    once whatever their number, and never by a hot value or by NULL.
    """
    if not fit.columns:
        return df
    out = df
    for i, c in enumerate(fit.columns):
        if c not in fit.large or df.isStreaming:    # a stream cannot be grouped, and its batches are small
            t = fit.table.where(F.col("column") == c).select(F.col("value").alias(f"__v{i}"), F.col("code").alias(f"__k{i}"))
            t = t if c in fit.large else F.broadcast(t)
            out = out.join(t, col(c).cast("string") == F.col(f"__v{i}"), "left")
    large = [] if df.isStreaming else fit.large
    if large:
        out = _looked_up(out, fit, df.columns)
    code = {c: F.col("__codes")[large.index(c)] if c in large else F.col(f"__k{i}") for i, c in enumerate(fit.columns)}
    return out.select(*map(col, df.columns), *[F.coalesce(code[c], F.lit(-1)).cast("int").alias(f"{c}_encoded") for c in fit.columns])


def _looked_up(df: DataFrame, fit: EncodeFit, names: list[str]) -> DataFrame:
    """``df`` with ``__codes``, the codes of the large columns in order.

    A row's key are its values that are neither NULL nor frequent (and their
    hash, for the shuffle).  Each key is taken apart into (column, value) once,
    coded, put together again and joined; rows without such a value join
    nothing and are spread.
    """
    def literal(c):
        known = [x for v, k in fit.heavy.get(c, {}).items() for x in (F.lit(v), F.lit(k))]
        return F.create_map(*known)[col(c).cast("string")] if known else F.lit(None).cast("int")

    k = len(fit.large)
    rows = df.withColumn("__known", F.array(*[literal(c) for c in fit.large]))
    rows = rows.withColumn("__rest", F.array(*[F.when(F.col("__known")[i].isNull(), col(c).cast("string"))
                                               for i, c in enumerate(fit.large)]))
    some = F.exists("__rest", lambda x: x.isNotNull())
    # a NULL among them must count for the hash, and equal keys must be equal without NULLs
    key = F.transform("__rest", lambda x: F.concat(F.when(x.isNull(), "0").otherwise("1"), F.coalesce(x, F.lit(""))))
    rows = rows.withColumn("__key", F.when(some, key))
    cells = (rows.where(F.col("__key").isNotNull()).select("__key", "__rest").dropDuplicates(["__key"])
             .select("__key", F.posexplode("__rest").alias("i", "value")).where(F.col("value").isNotNull()))
    names_of = F.element_at(F.array(*map(F.lit, fit.large)), F.col("i") + 1)
    table = fit.table.where(F.col("column").isin(fit.large)).select("column", "value", "code")
    coded = cells.withColumn("column", names_of).join(table, ["column", "value"]).groupBy("__key").agg(
        *[F.max(F.when(F.col("i") == i, F.col("code"))).alias(f"__c{i}") for i in range(k)])
    spread = F.array(F.lit("spread"), F.pmod(F.xxhash64(*[col(c) for c in comparable_columns(df.select(*map(col, names)))]),
                                             F.lit(4096)).cast("string"))
    out = rows.withColumn("__key", F.coalesce("__key", spread)).join(coded, "__key", "left")
    return out.withColumn("__codes", F.array(*[F.coalesce(F.col("__known")[i], F.col(f"__c{i}")) for i in range(k)]))


def squares(df: DataFrame, k: int = POLY_COLUMNS) -> tuple[DataFrame, list[str]]:   # F4
    cols = numeric_columns(df)[:k]
    return df.select("*", *[(col(c).cast("double") * col(c).cast("double")).alias(f"{c}_sq") for c in cols]), cols


def interaction(df: DataFrame, cols) -> DataFrame:                                   # F5
    if len(cols) < 2:
        return df
    a, b = cols[0], cols[1]
    return df.select("*", (col(a).cast("double") * col(b).cast("double")).alias(f"{a}_x_{b}"))


@dataclass(frozen=True)
class Derived:
    """What was derived: ``count`` new columns of a ``kind`` from ``sources``."""
    kind: str
    sources: tuple
    count: int = 1


def engineer(df: DataFrame, semantic: dict, polynomial: bool = False, encode_fit: EncodeFit | None = None):
    """F1-F6: date parts, codes, then squares and a product; returns ``(df, [Derived])``."""
    dates = [c for c, s in semantic.items() if s == "datetime" and c in df.columns]
    cats = [c for c, s in semantic.items() if s == "categorical" and c in df.columns]
    out = date_parts(df, dates)
    out = apply_encode(out, encode_fit or fit_encode(out, cats))
    done = [Derived("date_parts", (c,), len(DATE_PARTS)) for c in dates] + [Derived("codes", (c,)) for c in cats]
    new = {c: [f"{c}_{p}" for p in DATE_PARTS] for c in dates} | {c: [f"{c}_encoded"] for c in cats}
    out = out.select(*map(col, df.columns), *[col(n) for c in semantic for n in new.get(c, ())])   # in type-map order
    if polynomial:
        out, squared = squares(out)
        out = interaction(out, squared)
        done += [Derived("square", (c,)) for c in squared] + ([Derived("product", tuple(squared[:2]))] if len(squared) > 1 else [])
    return out, done
