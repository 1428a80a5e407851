"""Query registry: name -> (Spark callable, DuckDB oracle SQL or None).

Each Spark callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame
over the WHOLE driver tables (via the derived views of ``fixtures``).  Each
oracle is an independent SQL statement over the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple = ()):
    """Register ``fn`` as query ``name``; ``sql`` is its oracle (or None)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql
        return fn
    return deco


def per_column(template: str, cols, sep: str = "\nUNION ALL\n") -> str:
    """Repeat a one-column SQL template (``{c}`` = name) over columns."""
    return sep.join(template.format(c=c) for c in cols)


def load_all() -> None:
    # importing the modules registers their queries
    from . import queries_prep, queries_calls, queries_gates, queries_intake  # noqa: F401
