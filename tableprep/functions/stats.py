"""Distributed column statistics shared by all stages.

Design points (see README, "Scale"):

* one multi-column aggregate per question, never a Python loop of jobs;
* value counts go through a long form ``(column, num, str, n)`` built with
  ``inline`` and a ``groupBy`` with map-side partial aggregation, so a value
  that holds a third of all rows collapses to one row per task before the
  shuffle;
* distinct counts group every column by its own type, without the long form;
* exact quantiles: one mergeable sketch per column proposes an interval of
  values, exact counts prove it, and only a bounded number of (value, count)
  pairs inside reach the driver.  No task ever holds all distinct values of a
  column.
"""

from __future__ import annotations

import datetime
import decimal
import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import col, q

LONG_SCHEMA = "column string, lng bigint, num double, str string"
SLOTS = ("lng", "num", "str")
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def typed_value(f: T.StructField) -> Column:
    """``struct(lng, num, str)`` with the exact value in its type's slot, NULL for NULL.

    Integers, dates (days) and times (microseconds) are longs, floats are
    doubles, decimals keep their text beside a double that only orders them,
    everything else is text.  Struct order is value order.
    """
    c, dt = col(f.name), f.dataType
    lng, num, s = (F.lit(None).cast(t) for t in ("bigint", "double", "string"))
    if isinstance(dt, T.IntegralType):
        lng = c.cast("bigint")
    elif isinstance(dt, T.DecimalType):
        num, s = c.cast("double"), c.cast("string")
    elif isinstance(dt, T.NumericType):
        num = c.cast("double")
    elif isinstance(dt, T.DateType):
        lng = F.unix_date(c).cast("bigint")
    elif isinstance(dt, T.TimestampType):
        lng = F.unix_micros(c)
    elif isinstance(dt, T.TimestampNTZType):
        lng = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, {q(f.name)})")
    else:
        s = c.cast("string")
    return F.when(c.isNotNull(), F.struct(lng.alias("lng"), num.alias("num"), s.alias("str")))


def value_text(f: T.StructField) -> Column:
    """Text of a typed value of column ``f`` (numbers as doubles are written)."""
    dt = f.dataType
    if isinstance(dt, T.NumericType):
        return F.coalesce(F.col("str"), F.col("num").cast("string"), F.col("lng").cast("double").cast("string"))
    if isinstance(dt, T.DateType):
        return F.date_from_unix_date(F.col("lng").cast("int")).cast("string")
    if isinstance(dt, T.TimestampType):
        return F.timestamp_micros("lng").cast("string")
    if isinstance(dt, T.TimestampNTZType):
        return F.expr(f"CAST(timestampadd(MICROSECOND, lng, {_EPOCH}) AS STRING)")
    return F.col("str")


def python_value(dt: T.DataType, value):
    """The driver-side value of a typed struct (``lng``, ``num``, ``str``)."""
    if value is None:
        return None
    if isinstance(dt, T.DecimalType):
        return decimal.Decimal(value["str"])
    if isinstance(dt, T.DateType):
        return datetime.date(1970, 1, 1) + datetime.timedelta(days=value["lng"])
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        zone = datetime.timezone.utc if isinstance(dt, T.TimestampType) else None
        return datetime.datetime(1970, 1, 1, tzinfo=zone) + datetime.timedelta(microseconds=value["lng"])
    return next((value[s] for s in SLOTS if value[s] is not None), None)


def comparable_columns(df: DataFrame, cols=None) -> list[str]:
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = list(fields) if cols is None else list(cols)
    return [c for c in cols if not isinstance(fields[c], (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]


def long_values(df: DataFrame, cols=None) -> DataFrame:
    """Unpivot to ``(column, lng, num, str)``, one exact slot per type.

    NULL cells are dropped here (they are neither values nor distinct values
    in any consumer).
    """
    fields = {f.name: f for f in df.schema.fields}
    cols = comparable_columns(df, cols)
    if not cols:
        return df.sparkSession.createDataFrame([], LONG_SCHEMA)
    cells = [F.when(v.isNotNull(), F.struct(F.lit(c).alias("column"), *[v[s].alias(s) for s in SLOTS]))
             for c, v in ((c, typed_value(fields[c])) for c in cols)]
    return df.select(F.inline(F.array_compact(F.array(*cells))))


def value_counts(df: DataFrame, cols=None) -> DataFrame:
    """``(column, lng, num, str, n)``: one row per distinct non-null value per column."""
    return long_values(df, cols).groupBy("column", *SLOTS).agg(F.count(F.lit(1)).alias("n"))


def value_summary(vc: DataFrame) -> DataFrame:
    """Per column: distinct count, non-null count, top count and mode (a typed struct).

    Mode ties break to the smallest value (pandas ``mode()[0]``), using a
    ``min_by`` whose ordering key is ``(-n, value)`` -- a bounded aggregate.
    """
    key = F.struct((-F.col("n")).alias("neg_n"), *SLOTS)
    return vc.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum("n").alias("non_null"),
        F.max("n").alias("top_n"),
        F.min_by(F.struct(*SLOTS), key).alias("mode"),
    )


def distinct_counts(df: DataFrame, cols=None) -> DataFrame:
    """``(column, n_distinct)``: distinct non-null values of every comparable column.

    Every column is a branch of its own over its own type: it reads that
    column alone and shuffles its distinct values, eight bytes each for
    numbers, where the long form builds and shuffles a wide cell with the
    column's name for every value.  Types without an own slot go as text.
    """
    fields = {f.name: f for f in df.schema.fields}
    branches = []
    for c in comparable_columns(df, cols):
        own = isinstance(fields[c].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
        x = col(c) if own else col(c).cast("string")
        branches.append(df.select(x.alias("v")).where(F.col("v").isNotNull()).distinct()
                        .agg(F.count(F.lit(1)).alias("n_distinct")).select(F.lit(c).alias("column"), "n_distinct"))
    if not branches:
        return df.sparkSession.createDataFrame([], "column string, n_distinct long")
    return reduce(DataFrame.unionAll, branches)


# --------------------------------------------------------------------------
# exact quantiles
# --------------------------------------------------------------------------

#: columns of one aggregate; wider plans leave compiled code and fill a task with sketches
CHUNK = 48
NAN = float("nan")


class _Target(dict):
    """The ranks around one quantile of one column, and the open interval of values that still holds some of them.

    Its one item ``halve`` says that sketches did not narrow the interval and its middle is proposed instead.
    """

    def __init__(self, name: str, h: float, n: int):
        super().__init__(halve=False)
        self.name, self.h, self.value = name, h, {}
        self.open = sorted({math.floor(h), math.ceil(h)})
        self.lo = self.hi = self.proposal = None
        self.under, self.m = 0, n               # rows at or below lo; rows inside

    def fractions(self, eps: float) -> list[float]:
        """Where the sketch of the rows inside is asked for a value below and one above the open ranks."""
        return [max(0.0, (self.open[0] - self.under) / self.m - eps), min(1.0, (self.open[-1] - self.under + 1) / self.m + eps)]

    def counts(self, ends: np.ndarray, n: np.ndarray) -> list[int]:
        """Rows inside that are below, at, between and at the proposed values; ``n`` counts the parts of the column that
        ``ends`` make: 2j + 1 is the value ``ends[j]``, the even parts lie between two of them."""
        part = np.arange(len(n))
        lo, hi, a, b = (None if x is None else 2 * int(np.searchsorted(ends, x)) + 1 for x in (self.lo, self.hi, *self.proposal))
        inside = (part > (-1 if lo is None else lo)) & (part < (len(n) if hi is None else hi))
        return [int(n[inside & x].sum()) for x in (part < a, part == a, (part > a) & (part < b), part == b)]

    def prove(self, below: int, at_a: int, between: int, at_b: int) -> None:
        """Exact counts settle the ranks that fall on an end of the proposal; the others lie in one of three parts."""
        a, b = self.proposal
        at_b = at_b if b != a else 0
        at = self.under
        parts = []
        for ends, n in (((self.lo, a), below), (a, at_a), ((a, b), between), (b, at_b),
                        ((b, self.hi), self.m - below - at_a - between - at_b)):
            for r in [r for r in self.open if at <= r < at + n]:
                if isinstance(ends, tuple):
                    parts.append((ends, at, n))
                else:
                    self.value[r] = ends
                    self.open.remove(r)
            at += n
        before = self.m
        if parts:                               # neighbouring ranks: never in two parts, an end lies between these
            (self.lo, self.hi), self.under, self.m = parts[0]
        self["halve"] = self["halve"] or 2 * self.m > before

    def result(self) -> float:
        a, z = self.value[math.floor(self.h)], self.value[math.ceil(self.h)]
        return a + (z - a) * (self.h - math.floor(self.h)) if a != z else a


def quantiles(df: DataFrame, cols: list[str], probs: list[float], exact: bool = True,
              accuracy: int = 10000, max_local: int = 5000) -> dict:
    """``{column: [q(p) for p in probs]}`` with linear interpolation (pandas/numpy
    default, Spark ``percentile``, DuckDB ``quantile_cont``).

    ``exact=False`` returns ``percentile_approx`` (one bounded sketch per
    column).  ``exact=True``:

    1. one aggregate makes one mergeable sketch (KLL) per column and asks it
       for a value below and a value above the ranks of every quantile, as far
       off as the sketch's rank error;
    2. one aggregate counts the rows below, on, between and above these two
       values.  The counts are the proof: a rank that falls on one of the two
       is settled, the others lie in one known open interval;
    3. the (value, count) pairs of intervals with at most ``max_local`` rows
       are collected.  Wider intervals get 1 and 2 again, with a sketch of
       their own rows, which leaves a few thousandths of them; where a sketch
       misses, the interval is halved instead, so the search always ends.

    NaN counts as the largest value.  Columns go in chunks, so that neither
    the plan nor what reaches the driver at once grows with their number.
    """
    out = {}
    for at in range(0, len(cols), CHUNK):
        out.update(_chunk_quantiles(df, list(cols)[at:at + CHUNK], probs, exact, accuracy, max_local))
    return out


def _chunk_quantiles(df, cols, probs, exact, accuracy, max_local) -> dict:
    d = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    if not exact:
        row = d.agg(*[F.percentile_approx(f"c{i}", list(probs), accuracy) for i in range(len(cols))]).first()
        return {c: (list(row[i]) if row[i] is not None else [None] * len(probs)) for i, c in enumerate(cols)}

    size = min(max(accuracy, 8), 65535)
    eps = 2 * 2.296 / size ** 0.9021                    # twice the sketch's rank error (at 99 %)
    asked = [max(0.0, p - eps) for p in probs] + [min(1.0, p + eps) for p in probs]
    aggs = []
    for i in range(len(cols)):
        c = F.col(f"c{i}")
        aggs += [F.count(c), F.count_if(F.isnan(c)), _sketched(c, asked, size)]
    row = d.agg(*aggs).first()
    targets, slots = [], {}
    for i, c in enumerate(cols):
        n, nans, values = row[3 * i:3 * i + 3]
        for k, p in enumerate(probs):
            if not n:
                continue
            t = slots[c, k] = _Target(f"c{i}", (n - 1) * p, n - nans)
            for r in [r for r in t.open if r >= n - nans]:
                t.value[r] = NAN
                t.open.remove(r)
            if t.open:
                t.proposal = values[k], values[len(probs) + k]
                targets.append(t)
    _prove(d, targets)
    while wide := [t for t in targets if t.open and t.m > max_local]:
        _narrow(d, wide, eps, size)
    _collect(d, [t for t in targets if t.open])
    return {c: [slots[c, k].result() if (c, k) in slots else None for k in range(len(probs))] for c in cols}


def _values(column: pa.Array) -> np.ndarray:
    """The numbers of a column of doubles, without NULL and NaN."""
    x = column.to_numpy(zero_copy_only=False)
    return x[~np.isnan(x)]


def _prove(d: DataFrame, todo: list[_Target]) -> None:
    """One scan for all targets: every task sorts its values into the parts that the ends and proposals of their columns make."""
    if not todo:
        return
    names = list(dict.fromkeys(t.name for t in todo))
    ends = [np.unique([x for t in todo if t.name == c for x in (t.lo, t.hi, *t.proposal) if x is not None]) for c in names]

    def count(batches):
        kept = [np.zeros(2 * len(e) + 1, dtype=np.int64) for e in ends]
        for b in batches:
            for n, e, column in zip(kept, ends, b.columns):
                x = _values(column)
                n += np.bincount(np.searchsorted(e, x) + np.searchsorted(e, x, side="right"), minlength=len(n))
        i = np.repeat(np.arange(len(kept), dtype=np.int32), [len(n) for n in kept])
        part = np.concatenate([np.arange(len(n), dtype=np.int32) for n in kept])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (i, part, np.concatenate(kept))], names=["i", "part", "n"])

    found = [np.zeros(2 * len(e) + 1, dtype=np.int64) for e in ends]
    for i, part, n in (d.select(*names).mapInArrow(count, "i int, part int, n bigint")
                       .groupBy("i", "part").agg(F.sum("n").alias("n")).collect()):      # a few per column
        found[i][part] = n
    for t in todo:
        i = names.index(t.name)
        t.prove(*t.counts(ends[i], found[i]))


def _inside(d: DataFrame, todo: list[_Target]) -> DataFrame:
    """``(task, v)``: the values inside the interval of every target, numbered in order."""
    names = list(dict.fromkeys(t.name for t in todo))
    limits = [(names.index(t.name), -np.inf if t.lo is None else t.lo, np.inf if t.hi is None else t.hi,
               t.lo is None, t.hi is None) for t in todo]

    def pick(batches):
        for b in batches:
            columns = [_values(c) for c in b.columns]
            picked = []
            for i, lo, hi, from_start, to_end in limits:
                x = columns[i]
                picked.append(x[((x > lo) | from_start) & ((x < hi) | to_end)])
            task = np.repeat(np.arange(len(picked), dtype=np.int32), [len(x) for x in picked])
            yield pa.RecordBatch.from_arrays([pa.array(task), pa.array(np.concatenate(picked))], names=["task", "v"])

    return d.select(*names).mapInArrow(pick, "task int, v double")


def _narrow(d: DataFrame, wide: list[_Target], eps: float, size: int) -> None:
    """One round over wide intervals: two values inside, from a sketch or the middle, and the proof of where the ranks lie.

    Proposals are values of the column, so neighbouring ranks never lie on both sides of one without being on it.
    """
    seen = _inside(d, wide)
    rows = [F.when(F.col("task") == x, F.col("v")) for x in range(len(wide))]
    row = seen.agg(*[F.array(F.min(x), F.max(x)) if t["halve"] else _sketched(x, t.fractions(eps), size)
                  for x, t in zip(rows, wide)]).first()
    for t, (a, b) in zip(wide, row):
        t.proposal = a, b
    if halved := [(t, x) for t, x in zip(wide, rows) if t["halve"]]:
        middle = [a if math.isinf(a) else max(a, min(a / 2 + b / 2, b)) for a, b in (t.proposal for t, _ in halved)]
        for (t, _), v in zip(halved, seen.agg(*[F.max(F.when(x <= F.lit(m), x)) for (_, x), m in zip(halved, middle)]).first()):
            t.proposal = v, v
    _prove(d, wide)


def _sketched(c: Column, fractions: list[float], size: int) -> Column:
    """The values of ``c`` at rank ``fractions`` of a sketch, NULL without rows."""
    asked = F.array(*[F.lit(float(x)) for x in fractions])
    real = F.when(~F.isnan(c), c)
    return F.when(F.count(real) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(real, F.lit(size)), asked))


def _collect(d: DataFrame, todo: list[_Target]) -> None:
    """Settles the open ranks from the (value, count) pairs inside their intervals, each of bounded size."""
    if not todo:
        return
    pairs = _inside(d, todo).groupBy("task", "v").count().toArrow().sort_by([("task", "ascending"), ("v", "ascending")])
    task, v, n = (np.asarray(pairs.column(c)) for c in ("task", "v", "count"))
    for x, t in enumerate(todo):
        mine = slice(*np.searchsorted(task, [x, x + 1]))
        upto = np.cumsum(n[mine]) + t.under
        for r in t.open:
            t.value[r] = float(v[mine][np.searchsorted(upto, r, side="right")])


def group_quantile(df: DataFrame, group: str, value: str, p: float = 0.5, accuracy: int = 1000,
                   max_rows: int = 200_000) -> DataFrame:
    """``(group, q)``: exact quantile of every group, NULL group included, any number of groups.

    A table of brackets, one row per group, is narrowed by sketches until no
    bracket of distinct ends holds more than ``max_rows`` rows; every step
    counts the rows below and inside exactly, and a bracket that misses its
    ranks falls back to the side that holds them.  Rows are only compared with
    their group's bracket, never gathered by group; the final ranking sees the
    few (value, count) pairs inside the brackets.
    """
    from ..session import cut_lineage
    d = df.select(col(group).alias("g"), col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    v, r = F.col("v"), F.col("r")
    h = (F.col("n") - 1) * p
    b = cut_lineage(
        d.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .select(F.col("g").alias("bg"), h.alias("h"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("m"),
                F.lit(False).alias("halve"), F.explode(F.array_distinct(F.array(F.floor(h), F.ceil(h)))).alias("r")))

    def inside(brackets):
        return d.join(brackets, F.col("g").eqNullSafe(F.col("bg"))).where(v.between(F.col("lo"), F.col("hi")))

    def same(x, y):
        return x["bg"].eqNullSafe(y["yg"]) & (x["r"] == y["yr"])

    while b.where((F.col("m") > max_rows) & (F.col("lo") < F.col("hi"))).limit(1).count():
        wide = (F.col("m") > max_rows) & (F.col("lo") < F.col("hi"))
        grid = [i / accuracy for i in range(accuracy + 1)]
        sketch = inside(b.where(wide)).groupBy("bg", "r").agg(F.percentile_approx("v", grid, accuracy * 4).alias("s")).select(
            F.col("bg").alias("yg"), F.col("r").alias("yr"), "s")
        at = F.floor((r - F.col("below")) / F.col("m") * accuracy).cast("int")
        todo = b.where(wide)
        prop = cut_lineage(todo.join(sketch, same(todo, sketch)).select(
            *b.columns, F.when(F.col("halve"), F.col("lo")).otherwise(F.get("s", F.greatest(at - 1, F.lit(0)))).alias("a"),
            F.when(F.col("halve"), F.col("lo") + (F.col("hi") - F.col("lo")) / 2)
            .otherwise(F.get("s", F.least(at + 2, F.lit(accuracy)))).alias("z")))
        low, mid, high = v < F.col("a"), v.between(F.col("a"), F.col("z")), v > F.col("z")
        seen = inside(prop).groupBy("bg", "r").agg(
            F.count_if(low).alias("nl"), F.count_if(mid).alias("ni"), F.max(F.when(low, v)).alias("tl"),
            F.min(F.when(high, v)).alias("lh")).select(F.col("bg").alias("yg"), F.col("r").alias("yr"), "nl", "ni", "tl", "lh")
        first = F.col("below") + F.col("nl")
        last = first + F.col("ni")
        left, right = r < first, r >= last
        lo = F.when(left, F.col("lo")).when(right, F.col("lh")).otherwise(F.col("a"))
        hi = F.when(left, F.col("tl")).when(right, F.col("hi")).otherwise(F.col("z"))
        moved = prop.join(seen, same(prop, seen)).select(
            "bg", "h", lo.alias("lo"), hi.alias("hi"),
            F.when(left, F.col("below")).when(right, last).otherwise(first).alias("below"),
            F.when(left, F.col("nl")).when(right, F.col("m") - F.col("nl") - F.col("ni")).otherwise(F.col("ni")).alias("m"),
            (F.col("halve") | ((lo == F.col("lo")) & (hi == F.col("hi")))).alias("halve"), "r")
        b = cut_lineage(b.where(~wide).unionByName(moved))
    pairs = inside(b).groupBy("bg", "r", "h", "below", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.col("below") + F.sum("n").over(Window.partitionBy("bg", "r").orderBy("v"))
    at_rank = pairs.withColumn("upto", upto).where((r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    a, z = F.min("v"), F.max("v")
    return at_rank.groupBy("bg").agg((a + (z - a) * F.max(F.col("h") - F.floor("h"))).alias("q")).select(
        F.col("bg").alias(group), "q")
