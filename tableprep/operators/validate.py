"""Validation (stage "validate", H1-H5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col

# Fixed values of the validation rules.
EXPECTED_STEPS = ["intake", "quality_report", "type_report", "missing_report",
                  "outlier_report", "feature_report", "selector_report"]
MIN_ROWS = 10


def missing_steps(ledger: DataFrame, run_id: str | None = None) -> DataFrame:        # H1
    """Expected steps with no ledger entry (``left_anti``)."""
    spark = ledger.sparkSession
    expected = spark.createDataFrame([(s, i) for i, s in enumerate(EXPECTED_STEPS)], "step string, ord int")
    done = ledger if run_id is None else ledger.where(F.col("run_id") == run_id)
    return expected.join(done.select("step").distinct(), "step", "left_anti").select("step", "ord")


def missing_steps_of_runs(ledger: DataFrame) -> DataFrame:
    """``(run_id, step, ord)``: expected steps that a run of the ledger has not logged."""
    steps = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(i).alias("ord")) for i, s in enumerate(EXPECTED_STEPS)])
    expected = ledger.select("run_id").distinct().select("run_id", F.inline(steps))
    done = ledger.where(F.col("step").isin(EXPECTED_STEPS)).select("run_id", "step").distinct()
    return expected.join(done, ["run_id", "step"], "left_anti").select("run_id", "step", "ord")


def residual_nulls(df: DataFrame) -> DataFrame:                                      # H2
    """``(column, null_count)`` for columns that still hold NULLs -- one aggregate."""
    structs = [F.struct(F.lit(c).alias("column"), F.count_if(col(c).isNull()).alias("null_count"))
               for c in df.columns]
    if not structs:
        return df.sparkSession.createDataFrame([], "column string, null_count long")
    return df.agg(F.array(*structs).alias("a")).select(F.inline("a")).where(F.col("null_count") > 0)


def shape_and_nulls(df: DataFrame) -> tuple[int, dict]:
    """Row count and ``{column: nulls}`` for columns with NULLs -- one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return row["rows"], {c: row[f"n{i}"] for i, c in enumerate(df.columns) if row[f"n{i}"]}


def status_of(n_rows: int, n_cols: int, null_cols: dict, missing: list) -> tuple[str, list, list]:  # H3, H4
    """``(status, errors, warnings)``; findings are ``(kind, column or step, value)``."""
    warnings = [("residual_nulls", c, n) for c, n in null_cols.items()]
    warnings += [("missing_step", s, None) for s in missing]
    warnings += [("few_rows", None, n_rows)] if n_rows < MIN_ROWS else []
    errors = [("no_columns", None, 0)] if n_cols == 0 else []
    status = "FAILED" if errors else "PASSED WITH WARNINGS" if warnings else "PASSED"
    return status, errors, warnings


def status_frame(df: DataFrame, missing_count: int = 0) -> DataFrame:              # H3, H4 lazily
    """``(rows, columns, residual_null_columns, status)`` in one aggregate."""
    n_cols = len(df.columns)
    nulls = [F.when(F.count_if(col(c).isNull()) > 0, 1).otherwise(0) for c in df.columns]
    null_cols = sum(nulls[1:], nulls[0]) if nulls else F.lit(0)
    rows = F.count(F.lit(1))
    status = (F.when(F.lit(n_cols) == 0, "FAILED")
              .when((null_cols > 0) | (rows < MIN_ROWS) | F.lit(missing_count > 0), "PASSED WITH WARNINGS")
              .otherwise("PASSED"))
    return df.agg(rows.alias("rows"), F.lit(n_cols).alias("columns"),
                  null_cols.alias("residual_null_columns"), status.alias("pipeline_status"))


def stats_rollup(report: DataFrame) -> DataFrame:                                    # H5
    """Conditional aggregates over the long report table of one run."""
    m, s = F.col("metric"), F.col("stage")
    return report.groupBy("run_id").agg(
        F.max(F.when((s == "audit") & (m == "overall_quality"), F.col("value"))).alias("original_quality"),
        F.count_if((s == "features") & (m == "engineered")).alias("features_engineered"),
        F.count_if((s == "select") & (m == "removed")).alias("features_removed"),
        F.count_if((s == "select") & (m == "kept")).alias("features_kept"),
        F.coalesce(F.max(F.when((s == "outliers") & (m == "total_outlier_rows"), F.col("value"))),
                   F.lit("N/A")).alias("outlier_rows_flagged"),
    )
