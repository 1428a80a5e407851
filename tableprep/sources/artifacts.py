"""Experiment artefacts (A8, A9, A12): the call log, the summary and pivot
tables and the run report, written and read back with explicit schemas
(no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CALL_LOG_SCHEMA = (
    "run_id string, timestamp timestamp_ntz, prompt_strategy string, agent_name string, prompt_text string, "
    "output_text string, latency_ms double, token_estimate_in long, token_estimate_out long, "
    "quality_score double, silent_failure int, backtrack_triggered int, rule_llm_agree string, error string")
SUMMARY_SCHEMA = (
    "agent_name string, prompt_strategy string, avg_latency_ms double, avg_quality_score double, "
    "silent_failure_rate double, backtrack_rate double, avg_tokens_in double, avg_tokens_out double, "
    "call_count long")


def append_call_log(log: DataFrame, path: str) -> None:                 # A8
    """Append-only, partitioned by strategy; never overwritten."""
    log.write.mode("append").partitionBy("prompt_strategy").parquet(path)


def read_call_log(spark: SparkSession, path: str) -> DataFrame:          # A12
    return spark.read.schema(CALL_LOG_SCHEMA).parquet(path)


def write_table_csv(df: DataFrame, path: str) -> None:                   # A9 (summary, pivot)
    """Small result tables (one row per agent and strategy) as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_summary_csv(spark: SparkSession, path: str) -> DataFrame:       # A12
    return spark.read.schema(SUMMARY_SCHEMA).option("header", True).csv(path)


def run_report(log: DataFrame, summary: DataFrame, model: str = "") -> DataFrame:   # A9 report
    """One-row run report: totals, agents tested, overall figures and the summary table."""
    from ..operators.calllog import overall
    ov = overall(log)
    agents = summary.agg(F.sort_array(F.collect_set("agent_name")).alias("agents_tested"),
                         F.collect_list(F.struct(*summary.columns)).alias("summary_table"))
    # both sides are single-row aggregates: stack them and fold, no join
    left = ov.select(F.to_json(F.struct(*[c for c in ov.columns if c != "total_calls"])).alias("overall"),
                     "total_calls", F.lit(None).cast("array<string>").alias("agents_tested"),
                     F.lit(None).cast(agents.schema["summary_table"].dataType).alias("summary_table"))
    right = agents.select(F.lit(None).cast("string").alias("overall"), F.lit(None).cast("long").alias("total_calls"),
                          "agents_tested", "summary_table")
    one = left.unionByName(right).agg(*[F.first(c, ignorenulls=True).alias(c) for c in left.columns])
    return one.select(F.current_timestamp().alias("generated_at"), F.lit(model).alias("model"), "*")


def write_json(df: DataFrame, path: str) -> None:                        # A9
    df.coalesce(1).write.mode("overwrite").json(path)
