"""Most frequent values by mergeable summaries (D6, J5).

A full count of values shuffles every distinct value of every column, also of
columns of unique ids.  Here every task keeps a Misra-Gries summary per
column: at most ``counters`` values with counts.  Where more values occur, the
count of the first one beyond is taken off all of them, and what was taken off
is the summary's error.  Summaries add up: a value that occurs n times in the
table has a summed count between n - error and n, and a value that no summary
holds occurs at most error times.

* A column without error has been counted exactly; nothing else is needed.
* Otherwise one scan counts the best candidates exactly.  The result is proved
  if the top count is greater than what any other value can have.
* Only columns that this does not prove, such as unique ids, are counted in
  full.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import col
from .stats import SLOTS, comparable_columns, typed_value, value_counts, value_summary

COUNTERS, CANDIDATES = 512, 16
_ARROW = {"lng": pa.int64(), "num": pa.float64(), "str": pa.string()}
TOP_SCHEMA = "column string, non_null bigint, top_n bigint, mode struct<lng: bigint, num: double, str: string>"


def _slot(dt: T.DataType) -> str:
    """The slot of ``typed_value`` that tells two values of a type apart."""
    if isinstance(dt, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "lng"
    return "num" if isinstance(dt, T.NumericType) and not isinstance(dt, T.DecimalType) else "str"


class Summary:
    """Misra-Gries over Arrow arrays: ``v`` and ``n`` hold the counters, ``error`` what was taken off."""

    def __init__(self, kind: pa.DataType, counters: int):
        self.counters, self.error, self.total, self.waiting = counters, 0, 0, []
        self.table = pa.table({"v": pa.array([], kind), "n": pa.array([], pa.int64())})

    def add(self, values: pa.Array) -> None:
        values = pc.drop_null(values)
        self.total += len(values)
        counts = pc.value_counts(values)
        self.waiting.append(pa.table({"v": counts.field(0), "n": counts.field(1)}))
        if sum(map(len, self.waiting)) > 4 * self.counters:
            self.merge()

    def merge(self) -> None:
        t = pa.concat_tables([self.table, *self.waiting]).group_by("v").aggregate([("n", "sum")])
        t, self.waiting = t.select(["v", "n_sum"]).rename_columns(["v", "n"]), []
        if len(t) > self.counters:
            off = int(np.partition(np.asarray(t["n"]), -self.counters - 1)[-self.counters - 1])
            t = t.set_column(1, "n", pc.subtract(t["n"], off)).filter(pc.greater(t["n"], off))
            self.error += off
        self.table = t


def summaries(df: DataFrame, cols: list[str], counters: int = COUNTERS) -> DataFrame:
    """``(i, lng, num, str, n, error, total)``: added up counters of column number ``i``.

    The row without a value holds the column's error and number of values.
    """
    fields = [df.schema[c] for c in cols]
    slots = [_slot(f.dataType) for f in fields]
    # 0.0 and -0.0 are one value
    typed = df.select(*[(typed_value(f)[s] + F.lit(0.0) if s == "num" else typed_value(f)[s]).alias(f"c{i}")
                        for i, (f, s) in enumerate(zip(fields, slots))])
    out = pa.schema([("i", pa.int32()), *_ARROW.items(), ("n", pa.int64()), ("error", pa.int64()), ("total", pa.int64())])

    def run(batches):
        kept = [Summary(_ARROW[s], counters) for s in slots]
        for b in batches:
            for one, values in zip(kept, b.columns):
                one.add(values.cast(one.table.schema.field("v").type))
        for i, (one, s) in enumerate(zip(kept, slots)):
            one.merge()
            k = len(one.table)
            none = {x: pa.nulls(k + 1, t) for x, t in _ARROW.items()}
            none[s] = pa.concat_arrays([one.table["v"].combine_chunks(), pa.nulls(1, _ARROW[s])])
            zeros = [0] * k
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * (k + 1), pa.int32()), *none.values(), pa.array([*one.table["n"].to_pylist(), 0], pa.int64()),
                 pa.array([*zeros, one.error], pa.int64()), pa.array([*zeros, one.total], pa.int64())], schema=out)

    rows = typed.mapInArrow(run, "i int, lng bigint, num double, str string, n bigint, error bigint, total bigint")
    return rows.groupBy("i", *SLOTS).agg(*[F.sum(c).alias(c) for c in ("n", "error", "total")])


def _key(value) -> tuple:
    return tuple(value[s] for s in SLOTS)


def _order(key: tuple) -> tuple:
    """Value order of one column's keys; NaN is the largest."""
    return tuple((x is not None, x != x, 0 if x is None or x != x else x) for x in key)


def _best(counts: dict) -> tuple:
    """``(top count, smallest value that has it)``."""
    top = max(counts.values())
    return top, min((k for k, n in counts.items() if n == top), key=_order)


def top_values(df: DataFrame, cols=None, counters: int = COUNTERS, candidates: int = CANDIDATES) -> dict:
    """``{column: (non_null, top_n, mode)}``; ties go to the smallest value; ``mode`` is a dict by slot.

    Columns without a value are left out.
    """
    cols = comparable_columns(df, cols)
    if not cols:
        return {}
    value = F.coalesce(F.col("lng").isNotNull() | F.col("num").isNotNull() | F.col("str").isNotNull(), F.lit(False))
    w = Window.partitionBy("i", value).orderBy(F.desc("n"), *SLOTS)
    rows = summaries(df, cols, counters).withColumn("r", F.row_number().over(w)).where(F.col("r") <= candidates + 1).collect()
    out, unproved, recount = {}, [], {}
    for i, c in enumerate(cols):
        mine = [r for r in rows if r["i"] == i]             # at most candidates + 2
        total, error = next((r["total"], r["error"]) for r in mine if _key(r) == (None, None, None)) if mine else (0, 0)
        held = sorted(((r["n"], _key(r)) for r in mine if _key(r) != (None, None, None)), key=lambda x: (-x[0], _order(x[1])))
        if not total:
            continue
        # what a value that is not among the candidates can have at most
        rest = error + (held[candidates][0] if len(held) > candidates else 0)
        few = dict((k, n) for n, k in held[:candidates])
        decimal = isinstance(df.schema[c].dataType, T.DecimalType)     # told apart by text, ordered by number
        if few and not decimal and not error and max(few.values()) > rest:
            out[c] = (total, *_best(few))
        elif few and not decimal and held[0][0] + error > rest:
            recount[c] = total, rest, list(few)
        else:
            unproved.append(c)
    for c, counts in _exact_counts(df, {c: x[2] for c, x in recount.items()}).items():
        total, rest, _ = recount[c]
        if max(counts.values()) > rest:
            out[c] = (total, *_best(counts))
        else:
            unproved.append(c)
    if unproved:
        for r in value_summary(value_counts(df, unproved)).collect():
            out[r["column"]] = r["non_null"], r["top_n"], _key(r["mode"])
    return {c: (n, top, dict(zip(SLOTS, mode))) for c, (n, top, mode) in ((c, out[c]) for c in cols if c in out)}


def _exact_counts(df: DataFrame, wanted: dict) -> dict:
    """``{column: {key: count}}`` of the given keys, in one scan with one small group per key."""
    if not wanted:
        return {}
    cells = []
    for c, keys in wanted.items():
        s = _slot(df.schema[c].dataType)
        v = typed_value(df.schema[c])
        same = reduce(lambda a, b: a | b, [v[s] == F.lit(k[SLOTS.index(s)]) for k in keys])
        cells.append(F.when(same, F.struct(F.lit(c).alias("column"), *[v[x].alias(x) for x in SLOTS])))
    found = df.select(F.inline(F.array_compact(F.array(*cells)))).groupBy("column", *SLOTS).count().collect()
    out = {c: dict.fromkeys(keys, 0) for c, keys in wanted.items()}
    for r in found:
        out[r["column"]][_key(r)] = r["count"]
    return out


def top_table(df: DataFrame, cols=None) -> DataFrame:
    """``top_values`` as rows ``(column, non_null, top_n, mode)``."""
    rows = [(c, n, top, tuple(mode[s] for s in SLOTS)) for c, (n, top, mode) in top_values(df, cols).items()]
    return df.sparkSession.createDataFrame(rows, TOP_SCHEMA)
