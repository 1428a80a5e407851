"""Call-log analytics (K8-K20).

The log is a table of model calls; detectors (``functions.text``) are
projections, and every summary is a ``groupBy`` with map-side partial
aggregation over few groups (agent x strategy), so a hot group never
concentrates rows in one task.  Small per-group results (one row per
agent and strategy) are the only inputs of the later pivots and scalings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.columns import col
from ..functions.stats import group_quantile
from ..session import cut_lineage

# Fixed values of the experiment analytics.
STRATEGIES = ["baseline", "cdp"]
CONTROL, TREATMENT = "baseline", "cdp"
PIVOT_METRICS = ["avg_quality_score", "silent_failure_rate", "avg_latency_ms", "backtrack_rate"]
DELTA_METRICS = ["avg_quality_score", "silent_failure_rate", "avg_latency_ms"]
RETRY_MULTIPLIER = 5
FAILURE_GRID = [0, 0.05, 0.10, 0.20, 0.30, 0.40, 0.50]
SCALE_METRICS = ["avg_quality_score", "avg_tokens_out", "avg_latency_ms", "avg_tokens_in", "backtrack_rate"]
SCALE_EPS = 1e-9

LOG_COLUMNS = ["run_id", "timestamp", "prompt_strategy", "agent_name", "prompt_text", "output_text",
               "latency_ms", "token_estimate_in", "token_estimate_out", "quality_score", "silent_failure",
               "backtrack_triggered", "rule_llm_agree", "error"]


def call_log(calls: DataFrame) -> DataFrame:                                     # A8 row shape
    """Detectors applied to raw calls ``(run_id, logged_at, prompt_strategy,
    agent_name, prompt_text, output_text, latency_ms)`` -> the 14-field log."""
    p, o = F.col("prompt_text"), F.col("output_text")
    # parse each reply once; the optimizer keeps this projection because the
    # parsed value is used by several expressions below
    v = F.col("__v")
    calls = calls.withColumn("__v", TX.parse_reply(o))
    return calls.select(
        "run_id", F.col("logged_at").alias("timestamp"), "prompt_strategy", "agent_name",
        TX.truncate(p).alias("prompt_text"), TX.truncate(o).alias("output_text"),
        F.round(F.col("latency_ms").cast("double"), 2).alias("latency_ms"),
        TX.token_estimate(p).alias("token_estimate_in"), TX.token_estimate(o).alias("token_estimate_out"),
        TX.quality_score(o, F.col("prompt_strategy"), v).alias("quality_score"),
        TX.silent_failure(o).cast("int").alias("silent_failure"),
        TX.backtrack(o, v).cast("int").alias("backtrack_triggered"),
        F.lit(None).cast("string").alias("rule_llm_agree"), F.lit("").alias("error"))


def group_summary(log: DataFrame) -> DataFrame:                                  # K8
    r = lambda c, a: F.round(F.avg(c), 3).alias(a)
    return log.groupBy("agent_name", "prompt_strategy").agg(
        r("latency_ms", "avg_latency_ms"), r("quality_score", "avg_quality_score"),
        r("silent_failure", "silent_failure_rate"), r("backtrack_triggered", "backtrack_rate"),
        r("token_estimate_in", "avg_tokens_in"), r("token_estimate_out", "avg_tokens_out"),
        F.count("run_id").alias("call_count"))


def pivot(summary: DataFrame, metrics=PIVOT_METRICS, strategies=None) -> DataFrame:   # K9
    """One row per agent; columns ``{metric}_{strategy}`` for every strategy of the
    summary (or those given).  Spark finds the strategy names itself and refuses
    more than ``spark.sql.pivotMaxValues`` of them rather than dropping any."""
    g = summary.groupBy("agent_name")
    p = (g.pivot("prompt_strategy", list(strategies)) if strategies is not None else g.pivot("prompt_strategy")).agg(
        F.first(metrics[0]).alias(metrics[0]), *[F.first(m).alias(m) for m in metrics[1:]], F.count(F.lit(1)).alias("__n"))
    names = [c[:-len("___n")] for c in p.columns if c.endswith("___n")]
    return p.select("agent_name", *[col(f"{s}_{m}").alias(f"{m}_{s}") for m in metrics for s in names])


def deltas(piv: DataFrame, metrics=DELTA_METRICS) -> DataFrame:                  # K10
    extra = [F.round(F.col(f"{m}_{TREATMENT}") - F.col(f"{m}_{CONTROL}"), 3).alias(f"{m}_delta")
             for m in metrics if f"{m}_{TREATMENT}" in piv.columns and f"{m}_{CONTROL}" in piv.columns]
    return piv.select("*", *extra)


def overall(log: DataFrame) -> DataFrame:                                        # K11
    s = F.col("prompt_strategy")

    def avg_for(c, strat, digits):
        return F.round(F.avg(F.when(s == strat, F.col(c))), digits)
    return log.agg(
        F.count(F.lit(1)).alias("total_calls"),
        avg_for("quality_score", CONTROL, 3).alias("avg_quality_baseline"),
        avg_for("quality_score", TREATMENT, 3).alias("avg_quality_cdp"),
        avg_for("silent_failure", CONTROL, 3).alias("silent_failure_baseline"),
        avg_for("silent_failure", TREATMENT, 3).alias("silent_failure_cdp"),
        avg_for("latency_ms", CONTROL, 1).alias("avg_latency_baseline"),
        avg_for("latency_ms", TREATMENT, 1).alias("avg_latency_cdp"),
        avg_for("backtrack_triggered", TREATMENT, 3).alias("backtrack_rate_cdp"))


def strategy_slices(summary: DataFrame, metrics=SCALE_METRICS) -> DataFrame:     # K12
    """Control and treatment rows of the summary paired by agent (equi-join)."""
    b = summary.where(F.col("prompt_strategy") == CONTROL).select(
        "agent_name", *[F.col(m).alias(f"b_{m}") for m in metrics])
    c = summary.where(F.col("prompt_strategy") == TREATMENT).select(
        "agent_name", *[F.col(m).alias(f"c_{m}") for m in metrics])
    return b.join(c, "agent_name")


def token_economy(summary: DataFrame) -> DataFrame:                             # K13
    """Mean over agents of per-agent mean tokens, per strategy side."""
    s = F.col("prompt_strategy")
    return summary.agg(
        F.avg(F.when(s == CONTROL, F.col("avg_tokens_in"))).alias("tok_in_b"),
        F.avg(F.when(s == TREATMENT, F.col("avg_tokens_in"))).alias("tok_in_c"),
        F.avg(F.when(s == CONTROL, F.col("avg_tokens_out"))).alias("tok_out_b"),
        F.avg(F.when(s == TREATMENT, F.col("avg_tokens_out"))).alias("tok_out_c"))


def output_ratio(slices: DataFrame) -> DataFrame:
    b, c = F.col("b_avg_tokens_out"), F.col("c_avg_tokens_out")
    return slices.select("agent_name", F.when(b > 0, c / b).otherwise(0.0).alias("out_ratio"))


def retry_cost(economy: DataFrame, grid=FAILURE_GRID) -> DataFrame:             # K14
    """Control cost with retries on a failure-rate grid vs the flat treatment
    cost, and the break-even rate.  The grid is exploded from a literal array
    (no join)."""
    b, c = F.col("tok_out_b"), F.col("tok_out_c")
    return (economy.select(F.explode(F.array(*[F.lit(float(x)) for x in grid])).alias("failure_rate"), b, c)
            .select("failure_rate",
                    (b * (1 + F.col("failure_rate") * RETRY_MULTIPLIER)).alias("baseline_cost"),
                    c.alias("cdp_cost"),
                    F.try_divide(c - b, b * RETRY_MULTIPLIER).alias("break_even")))


def group_medians(log: DataFrame, group: str, value: str) -> DataFrame:          # K15
    """``(group, median)``, exact, the NULL group included, for any number of groups."""
    return group_quantile(log, group, value).withColumnRenamed("q", "median")


def latency_histogram(log: DataFrame, bins: int = 10) -> DataFrame:             # K15 density
    """Binned latency counts per strategy on a shared [min, max] range."""
    rng = log.agg(F.min("latency_ms").alias("lo"), F.max("latency_ms").alias("hi")).first()
    if rng["lo"] is None:
        return log.sparkSession.createDataFrame([], "prompt_strategy string, bin int, n long")
    hi = rng["hi"] if rng["hi"] > rng["lo"] else rng["lo"] + 1
    b = F.least(F.width_bucket(F.col("latency_ms"), F.lit(rng["lo"]), F.lit(hi), F.lit(bins)), F.lit(bins))
    return log.groupBy("prompt_strategy", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def latency_delta(summary: DataFrame) -> DataFrame:                              # K16
    s = strategy_slices(summary, ["avg_latency_ms"])
    d = F.col("c_avg_latency_ms") - F.col("b_avg_latency_ms")
    return s.select("agent_name", F.round(d, 3).alias("latency_delta"), (d < 0).alias("faster"))


def stability(log: DataFrame) -> DataFrame:                                      # K17
    """Per strategy: mean over agents of the per-agent sample std of quality."""
    per = log.groupBy("prompt_strategy", "agent_name").agg(
        F.stddev_samp("quality_score").alias("sigma"), F.avg("quality_score").alias("mean_q"))
    return per.groupBy("prompt_strategy").agg(F.avg("sigma").alias("avg_sigma"),
                                              F.avg("mean_q").alias("avg_agent_mean"))


def min_max_scale(summary: DataFrame, metrics=SCALE_METRICS) -> DataFrame:      # K18
    """``(x - min) / (max - min + eps)`` per metric; min/max are fitted once
    (one aggregate row) and applied as literals."""
    row = summary.agg(*[F.min(m).alias(f"lo_{m}") for m in metrics],
                      *[F.max(m).alias(f"hi_{m}") for m in metrics]).first()
    return summary.select("agent_name", "prompt_strategy", *[
        ((F.col(m) - F.lit(row[f"lo_{m}"])) / (F.lit(row[f"hi_{m}"]) - F.lit(row[f"lo_{m}"]) + SCALE_EPS))
        .alias(f"{m}_scaled") for m in metrics])


def boundary_marks(summary: DataFrame) -> DataFrame:                             # K19
    """Rows (in agent, strategy order) whose strategy differs from the previous
    row.  The summary holds one row per agent and strategy."""
    # agents x strategies have no bound: number inside range partitions, shift by the partitions before
    rows = cut_lineage(summary.select("agent_name", "prompt_strategy").repartitionByRange("agent_name", "prompt_strategy")
                       .withColumn("pid", F.spark_partition_id()))
    order = ["agent_name", "prompt_strategy"]
    ends = rows.groupBy("pid").agg(F.count(F.lit(1)).alias("k"), F.max_by("prompt_strategy", F.struct(*order)).alias("end"))
    before = Window.orderBy("pid")                              # one row per partition
    ends = ends.select("pid", F.coalesce(F.sum("k").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("o"),
                       F.lag("end").over(before).alias("end_before"))
    w = Window.partitionBy("pid").orderBy(*order)
    inside = rows.withColumns({"r": F.row_number().over(w), "prev": F.lag("prompt_strategy").over(w)}).join(ends, "pid")
    prev = F.when(F.col("r") == 1, F.col("end_before")).otherwise(F.col("prev"))
    return inside.select(
        F.concat(F.upper("prompt_strategy"), F.lit(" | "), F.col("agent_name")).alias("label"),
        (F.col("r") + F.col("o")).cast("int").alias("position"),
        F.coalesce(prev != F.col("prompt_strategy"), F.lit(False)).alias("boundary"))


def dataset_summary(df: DataFrame) -> DataFrame:                                 # K20
    """Shape, null percents and duplicates of a table as one JSON string."""
    from .profile import column_profile, duplicate_rows
    prof = column_profile(df)
    nulls = prof.agg(F.map_from_entries(F.collect_list(F.struct("column", "null_pct"))).alias("null_pct"),
                     F.max("rows").alias("rows"))
    dups = duplicate_rows(df).select(F.lit(None).cast(nulls.schema["null_pct"].dataType).alias("null_pct"),
                                     F.lit(None).cast("long").alias("rows"), "duplicate_rows")
    one = (nulls.select("null_pct", "rows", F.lit(None).cast("long").alias("duplicate_rows"))
           .unionByName(dups)
           .agg(F.first("null_pct", ignorenulls=True).alias("null_pct"), F.max("rows").alias("rows"),
                F.max("duplicate_rows").alias("duplicate_rows")))
    return one.select(
        "rows", F.lit(len(df.columns)).alias("columns"), "duplicate_rows",
        F.to_json(F.struct(F.col("rows"), F.lit(len(df.columns)).alias("columns"),
                           F.array(*[F.lit(c) for c in df.columns]).alias("column_names"),
                           "null_pct", "duplicate_rows")).alias("summary_json"))
