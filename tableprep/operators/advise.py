"""Advice from a user's callable (I4): any function from a row to a few values, run where the rows are.

The callable sees one row as a dict and returns a dict with the declared
columns; what it asks (a model, a service, a rule book) is its own affair.  It
runs inside Arrow batches of bounded size.  A call that raises, takes longer
than ``timeout`` seconds or returns something else than declared leaves NULLs
and its fault in ``advice_error``; the job goes on and no row is lost.
"""

from __future__ import annotations

import concurrent.futures
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from .impute import DROP_THRESHOLD, STRATEGIES

ERROR = "advice_error"
FACTS = "column string, dtype string, semantic string, null_pct double"


def _checked(answer, fields: list[pa.Field]) -> list:
    """The declared values of an answer, each fit for its column; raises what is wrong with it."""
    if not isinstance(answer, dict):
        raise TypeError(f"the answer is a {type(answer).__name__}, not a dict")
    if lost := [f.name for f in fields if f.name not in answer]:
        raise KeyError(f"the answer lacks {', '.join(lost)}")
    out = []
    for f in fields:
        try:
            out.append(pa.array([answer[f.name]], f.type)[0].as_py())
        except (pa.ArrowException, TypeError, ValueError, OverflowError) as e:
            raise TypeError(f"{f.name}: {answer[f.name]!r} is no {f.type}") from e
    return out


def advise_rows(df: DataFrame, call: Callable[[dict], dict], schema: str, batch_rows: int = 64,
                timeout: float | None = None, attempts: int = 1) -> DataFrame:
    """``df`` with the columns of ``schema`` and ``advice_error``.

    A row gets up to ``attempts`` calls.  With a ``timeout``, calls run in a
    thread beside the task; one that does not come back is given up (its
    thread ends with the worker).  ``schema`` may not name columns of ``df``.
    """
    given = StructType.fromDDL(schema)
    if twice := [f.name for f in given if f.name in df.columns] + [ERROR] * (ERROR in df.columns):
        raise ValueError(f"the table has columns {twice} already")
    st = StructType([*df.schema.fields, *given.fields, StructField(ERROR, StringType())])
    arrow = to_arrow_schema(st)
    asked = [arrow.field(f.name) for f in given]
    if batch_rows < 1 or attempts < 1:
        raise ValueError("batch_rows and attempts are 1 or more")

    def run(batches):
        pool = None

        def once(row):
            nonlocal pool
            if timeout is None:
                return _checked(call(row), asked)
            pool = pool or concurrent.futures.ThreadPoolExecutor(1)
            job = pool.submit(call, row)
            try:
                return _checked(job.result(timeout), asked)
            except concurrent.futures.TimeoutError:
                if not job.done():
                    pool.shutdown(wait=False)
                    pool = None                     # the thread is lost to the call that hangs
                    raise TimeoutError(f"no answer in {timeout} s") from None
                raise

        def answer(row):
            for left in range(attempts - 1, -1, -1):
                try:
                    return [*once(row), None]
                except Exception as e:  # noqa: BLE001
                    if not left:
                        return [None] * len(asked) + [f"{type(e).__name__}: {e}"]

        for b in batches:
            for at in range(0, b.num_rows, batch_rows):
                part = b.slice(at, batch_rows)
                cols = list(zip(*[answer(row) for row in part.to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [*[c.cast(f.type) for c, f in zip(part.columns, arrow)],
                     *[pa.array(c, f.type) for c, f in zip(cols, list(arrow)[part.num_columns:])]], schema=arrow)
        if pool:
            pool.shutdown(wait=False)

    return df.mapInArrow(run, st)


def column_facts(df: DataFrame, semantic: dict, fractions: dict, drop_threshold: float = DROP_THRESHOLD, protect=()) -> DataFrame:
    """What an adviser of columns is told: the columns that have holes and are not dropped for them."""
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [(c, kind[c], semantic.get(c, "unknown"), 100.0 * x) for c, x in fractions.items()
            if c in kind and c not in protect and x is not None and 0 < x < drop_threshold]
    return df.sparkSession.createDataFrame(rows, FACTS)


def advise_columns(facts: DataFrame, call: Callable[[dict], dict], batch_rows: int = 64, timeout: float | None = None,
                   attempts: int = 1) -> DataFrame:
    """Advice table ``(column, strategy, advice_error)`` for ``fit_impute(overrides=...)``.

    ``call`` gets ``column``, ``dtype``, ``semantic`` and ``null_pct`` and
    returns ``{"strategy": ...}``.  A call that fails gives no strategy, so
    the rule of D3 holds; a strategy that is none of ``STRATEGIES`` is passed
    on (D8 makes it the median) and noted.
    """
    out = advise_rows(facts, call, "strategy string", batch_rows, timeout, attempts)
    odd = F.col("strategy").isNotNull() & ~F.col("strategy").isin(*STRATEGIES)
    return out.select("column", "strategy", F.when(odd, F.concat(F.lit("unknown strategy "), "strategy")).otherwise(F.col(ERROR)).alias(ERROR))
