"""Registered queries for call-log analytics (K) and the run ledger views (A7, A10, A11).

The call log is ``m_calls`` (every ``events`` row is one logged call).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import calllog as CL
from ..session import ensure_checkpoint_dir
from ..sources import artifacts as AR
from ..sources import store as ST
from .fixtures import m_calls, m_items, m_text
from .registry import query

# ------------------------------------------------------------------ DuckDB side of the detectors

_KIND = "CASE WHEN json_valid(output_text) THEN json_type(output_text) END"


def _has(key):
    return (f"CASE kind WHEN 'OBJECT' THEN list_contains(json_keys(output_text), '{key}') "
            f"WHEN 'ARRAY' THEN list_contains(CAST(json_extract(output_text, '$[*]') AS VARCHAR[]), '\"{key}\"') "
            f"WHEN 'VARCHAR' THEN contains(json_extract_string(output_text, '$'), '{key}') ELSE false END")


_SCORE = (f"CAST(CASE WHEN kind IN ('OBJECT', 'ARRAY', 'VARCHAR') THEN least(round_even(3.0 "
          f"+ CASE WHEN {_has('justification')} OR {_has('risk_summary')} THEN 0.5 ELSE 0.0 END "
          f"+ CASE WHEN {_has('backtrack')} THEN 0.3 ELSE 0.0 END "
          f"+ CASE WHEN {_has('risk_level')} OR {_has('risk_note')} THEN 0.4 ELSE 0.0 END "
          f"+ CASE WHEN {_has('readiness_score')} THEN 0.3 ELSE 0.0 END "
          f"+ CASE WHEN prompt_strategy = 'cdp' THEN 0.3 ELSE 0.0 END, 2), 5.0) "
          f"WHEN prompt_strategy = 'baseline' THEN 2.5 ELSE 3.5 END AS DOUBLE)")

_BT = "json_extract(output_text, '$.backtrack')"
_TRUTHY = (f"CASE WHEN {_BT} IS NULL THEN false WHEN json_type({_BT}) = 'NULL' THEN false "
           f"WHEN json_type({_BT}) = 'BOOLEAN' THEN CAST({_BT} AS VARCHAR) = 'true' "
           f"WHEN json_type({_BT}) = 'VARCHAR' THEN CAST({_BT} AS VARCHAR) <> '\"\"' "
           f"WHEN json_type({_BT}) IN ('ARRAY', 'OBJECT') THEN CAST({_BT} AS VARCHAR) NOT IN ('[]', '{{}}') "
           f"ELSE TRY_CAST(CAST({_BT} AS VARCHAR) AS DOUBLE) <> 0 END")
_BACKTRACK = f"CASE WHEN kind = 'OBJECT' THEN {_TRUTHY} ELSE contains(upper(output_text), 'BACKTRACK') END"

_SILENT = " OR ".join(f"regexp_matches(lower(output_text), '{TX.portable(p)}')" for p in TX.SILENT_FAILURE_PATTERNS)

LOG_SQL = f"""
log AS (
  SELECT run_id, logged_at AS "timestamp", prompt_strategy, agent_name,
         substring(prompt_text, 1, 800) AS prompt_text, substring(output_text, 1, 800) AS output_text,
         round(CAST(latency_ms AS DOUBLE), 2) AS latency_ms,
         CAST(length(prompt_text) // 4 AS BIGINT) AS token_estimate_in,
         CAST(length(output_text) // 4 AS BIGINT) AS token_estimate_out,
         {_SCORE} AS quality_score,
         CAST({_SILENT} AS INTEGER) AS silent_failure,
         CAST({_BACKTRACK} AS INTEGER) AS backtrack_triggered
  FROM (SELECT *, {_KIND} AS kind FROM m_calls))"""

SUMMARY_SQL = """
summary AS (
  SELECT agent_name, prompt_strategy,
         round(avg(latency_ms), 3) AS avg_latency_ms, round(avg(quality_score), 3) AS avg_quality_score,
         round(avg(silent_failure), 3) AS silent_failure_rate, round(avg(backtrack_triggered), 3) AS backtrack_rate,
         round(avg(token_estimate_in), 3) AS avg_tokens_in, round(avg(token_estimate_out), 3) AS avg_tokens_out,
         count(run_id) AS call_count
  FROM log GROUP BY agent_name, prompt_strategy)"""


def _with_log(sql, summary=False):
    ctes = LOG_SQL + ("," + SUMMARY_SQL if summary else "")
    return f"WITH {ctes}\n{sql}"


def _log(spark, sf):
    return CL.call_log(m_calls(spark, sf))


def _summary(spark, sf):
    return CL.group_summary(_log(spark, sf))


# ------------------------------------------------------------------ K1-K7 (row level)

@query("k1_tokens", "SELECT conv_id, turn, CAST(length(text) // 4 AS BIGINT) AS token_estimate FROM m_text",
       ("m_text",))
def k1_tokens(spark, sf):
    t = m_text(spark, sf)
    return t.select("conv_id", "turn", TX.token_estimate(F.col("text")).alias("token_estimate"))


@query("k2_truncate", "SELECT conv_id, turn, substring(text, 1, 800) AS text_800, CAST(length(text) AS INTEGER) AS n_chars "
       "FROM m_text",
       ("m_text",))
def k2_truncate(spark, sf):
    t = m_text(spark, sf)
    return t.select("conv_id", "turn", TX.truncate(F.col("text")).alias("text_800"),
                    F.char_length("text").alias("n_chars"))


@query("k3_silent", f"SELECT run_id, agent_name, latency_ms, {_SILENT} AS silent_failure FROM m_calls", ("m_calls",))
def k3_silent(spark, sf):
    c = m_calls(spark, sf)
    return c.select("run_id", "agent_name", "latency_ms", TX.silent_failure(F.col("output_text")).alias("silent_failure"))


@query("k4_backtrack", _with_log("SELECT run_id, agent_name, latency_ms, backtrack_triggered FROM log"), ("m_calls",))
def k4_backtrack(spark, sf):
    return _log(spark, sf).select("run_id", "agent_name", "latency_ms", "backtrack_triggered")


@query("k5_quality", _with_log("SELECT run_id, agent_name, latency_ms, quality_score FROM log"), ("m_calls",))
def k5_quality(spark, sf):
    return _log(spark, sf).select("run_id", "agent_name", "latency_ms", "quality_score")


_CLEAN = ("trim(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace("
          "regexp_replace(output_text, '^\\s+|\\s+$', '', 'g'), '^```json', ''), '```$', ''), ' \t\n\r'), "
          "'^```', ''), '```$', ''), ' \t\n\r')")


@query("k6_lenient", f"""
SELECT run_id, agent_name, latency_ms, json_valid(c) AS ok, c AS cleaned
FROM (SELECT run_id, agent_name, latency_ms, {_CLEAN} AS c FROM m_calls)""", ("m_calls",))
def k6_lenient(spark, sf):
    c = m_calls(spark, sf)
    return c.select("run_id", "agent_name", "latency_ms", TX.lenient_json(F.col("output_text")).alias("j")) \
            .select("run_id", "agent_name", "latency_ms", "j.ok", "j.cleaned")


@query("k7_reply_score", """
SELECT run_id, agent_name, latency_ms, CASE WHEN regexp_extract(output_text, '[1-5]', 0) <> ''
       THEN CAST(regexp_extract(output_text, '[1-5]', 0) AS DOUBLE) END AS score FROM m_calls""", ("m_calls",))
def k7_reply_score(spark, sf):
    c = m_calls(spark, sf)
    return c.select("run_id", "agent_name", "latency_ms", TX.score_from_reply(F.col("output_text")).alias("score"))


# ------------------------------------------------------------------ K8-K20 (aggregates)

@query("k8_summary", _with_log("SELECT * FROM summary", True), ("m_calls",))
def k8_summary(spark, sf):
    return _summary(spark, sf)


_PIVOT_COLS = ", ".join(
    f"max(CASE WHEN prompt_strategy = '{s}' THEN {m} END) AS {m}_{s}"
    for m in CL.PIVOT_METRICS for s in CL.STRATEGIES)


@query("k9_pivot", _with_log(f"SELECT agent_name, {_PIVOT_COLS} FROM summary GROUP BY agent_name", True),
       ("m_calls",))
def k9_pivot(spark, sf):
    return CL.pivot(_summary(spark, sf))


_DELTAS = ", ".join(f"round({m}_cdp - {m}_baseline, 3) AS {m}_delta" for m in CL.DELTA_METRICS)


@query("k10_deltas", _with_log(
    f"SELECT *, {_DELTAS} FROM (SELECT agent_name, {_PIVOT_COLS} FROM summary GROUP BY agent_name)", True),
       ("m_calls",))
def k10_deltas(spark, sf):
    return CL.deltas(CL.pivot(_summary(spark, sf)))


@query("k11_overall", _with_log("""
SELECT count(*) AS total_calls,
  round(avg(CASE WHEN prompt_strategy = 'baseline' THEN quality_score END), 3) AS avg_quality_baseline,
  round(avg(CASE WHEN prompt_strategy = 'cdp' THEN quality_score END), 3) AS avg_quality_cdp,
  round(avg(CASE WHEN prompt_strategy = 'baseline' THEN silent_failure END), 3) AS silent_failure_baseline,
  round(avg(CASE WHEN prompt_strategy = 'cdp' THEN silent_failure END), 3) AS silent_failure_cdp,
  round(avg(CASE WHEN prompt_strategy = 'baseline' THEN latency_ms END), 1) AS avg_latency_baseline,
  round(avg(CASE WHEN prompt_strategy = 'cdp' THEN latency_ms END), 1) AS avg_latency_cdp,
  round(avg(CASE WHEN prompt_strategy = 'cdp' THEN backtrack_triggered END), 3) AS backtrack_rate_cdp
FROM log"""), ("m_calls",))
def k11_overall(spark, sf):
    return CL.overall(_log(spark, sf))


_SLICE_COLS = ", ".join([f"b.{m} AS b_{m}" for m in CL.SCALE_METRICS] + [f"c.{m} AS c_{m}" for m in CL.SCALE_METRICS])


@query("k12_slices", _with_log(f"""
SELECT b.agent_name, {_SLICE_COLS}
FROM (SELECT * FROM summary WHERE prompt_strategy = 'baseline') b
JOIN (SELECT * FROM summary WHERE prompt_strategy = 'cdp') c ON b.agent_name = c.agent_name""", True),
       ("m_calls",))
def k12_slices(spark, sf):
    return CL.strategy_slices(_summary(spark, sf))


_ECON = """
SELECT round(avg(CASE WHEN prompt_strategy = 'baseline' THEN avg_tokens_in END), 6) AS tok_in_b,
       round(avg(CASE WHEN prompt_strategy = 'cdp' THEN avg_tokens_in END), 6) AS tok_in_c,
       round(avg(CASE WHEN prompt_strategy = 'baseline' THEN avg_tokens_out END), 6) AS tok_out_b,
       round(avg(CASE WHEN prompt_strategy = 'cdp' THEN avg_tokens_out END), 6) AS tok_out_c
FROM summary"""


@query("k13_tokens", _with_log(_ECON, True), ("m_calls",))
def k13_tokens(spark, sf):
    e = CL.token_economy(_summary(spark, sf))
    return e.select(*[F.round(c, 6).alias(c) for c in e.columns])


@query("k13_out_ratio", _with_log(f"""
SELECT b.agent_name, round(CASE WHEN b.avg_tokens_out > 0 THEN c.avg_tokens_out / b.avg_tokens_out ELSE 0 END, 6)
       AS out_ratio
FROM (SELECT * FROM summary WHERE prompt_strategy = 'baseline') b
JOIN (SELECT * FROM summary WHERE prompt_strategy = 'cdp') c ON b.agent_name = c.agent_name""", True),
       ("m_calls",))
def k13_out_ratio(spark, sf):
    r = CL.output_ratio(CL.strategy_slices(_summary(spark, sf)))
    return r.select("agent_name", F.round("out_ratio", 6).alias("out_ratio"))


_GRID = ", ".join(str(float(x)) for x in CL.FAILURE_GRID)


@query("k14_retry_cost", _with_log(f"""
SELECT fr AS failure_rate, round(tok_out_b * (1 + fr * 5), 6) AS baseline_cost, round(tok_out_c, 6) AS cdp_cost,
       round((tok_out_c - tok_out_b) / (tok_out_b * 5), 6) AS break_even
FROM ({_ECON.replace('round(', '(').replace(', 6)', ')')}) e, (SELECT CAST(unnest([{_GRID}]) AS DOUBLE) AS fr) g""", True),
       ("m_calls",))
def k14_retry_cost(spark, sf):
    r = CL.retry_cost(CL.token_economy(_summary(spark, sf)))
    return r.select("failure_rate", *[F.round(c, 6).alias(c) for c in ("baseline_cost", "cdp_cost", "break_even")])


@query("k15_latency_median", _with_log("""
SELECT prompt_strategy, round(quantile_cont(latency_ms, 0.5), 6) AS median_latency FROM log GROUP BY prompt_strategy"""),
       ("m_calls",))
def k15_latency_median(spark, sf):
    med = CL.group_medians(_log(spark, sf), "prompt_strategy", "latency_ms")
    return med.select("prompt_strategy", F.round("median", 6).alias("median_latency"))


@query("k15_latency_hist", _with_log("""
SELECT prompt_strategy, CAST(least(floor((latency_ms - lo) / (hi - lo) * 10) + 1, 10) AS INTEGER) AS bin,
       count(*) AS n
FROM log, (SELECT min(latency_ms) AS lo, max(latency_ms) AS hi FROM log) r
GROUP BY ALL"""), ("m_calls",))
def k15_latency_hist(spark, sf):
    return CL.latency_histogram(_log(spark, sf))


@query("k16_latency_delta", _with_log("""
SELECT b.agent_name, round(c.avg_latency_ms - b.avg_latency_ms, 3) AS latency_delta,
       c.avg_latency_ms - b.avg_latency_ms < 0 AS faster
FROM (SELECT * FROM summary WHERE prompt_strategy = 'baseline') b
JOIN (SELECT * FROM summary WHERE prompt_strategy = 'cdp') c ON b.agent_name = c.agent_name""", True),
       ("m_calls",))
def k16_latency_delta(spark, sf):
    return CL.latency_delta(_summary(spark, sf))


@query("k17_stability", _with_log("""
SELECT prompt_strategy, round(avg(sigma), 6) AS avg_sigma, round(avg(mean_q), 6) AS avg_agent_mean
FROM (SELECT prompt_strategy, agent_name, stddev_samp(quality_score) AS sigma, avg(quality_score) AS mean_q
      FROM log GROUP BY ALL) GROUP BY prompt_strategy"""), ("m_calls",))
def k17_stability(spark, sf):
    s = CL.stability(_log(spark, sf))
    return s.select("prompt_strategy", F.round("avg_sigma", 6).alias("avg_sigma"),
                    F.round("avg_agent_mean", 6).alias("avg_agent_mean"))


_SCALED = ", ".join(
    f"round(({m} - (SELECT min({m}) FROM summary)) / ((SELECT max({m}) FROM summary) - (SELECT min({m}) FROM summary)"
    f" + 1e-9), 6) AS {m}_scaled" for m in CL.SCALE_METRICS)


@query("k18_minmax", _with_log(f"SELECT agent_name, prompt_strategy, {_SCALED} FROM summary", True), ("m_calls",))
def k18_minmax(spark, sf):
    s = CL.min_max_scale(_summary(spark, sf))
    return s.select("agent_name", "prompt_strategy", *[F.round(f"{m}_scaled", 6).alias(f"{m}_scaled")
                                                       for m in CL.SCALE_METRICS])


@query("k19_boundaries", _with_log("""
SELECT upper(prompt_strategy) || ' | ' || agent_name AS label,
       CAST(row_number() OVER (ORDER BY agent_name, prompt_strategy) AS INTEGER) AS position,
       coalesce(lag(prompt_strategy) OVER (ORDER BY agent_name, prompt_strategy) <> prompt_strategy, false) AS boundary
FROM summary""", True), ("m_calls",))
def k19_boundaries(spark, sf):
    return CL.boundary_marks(_summary(spark, sf))


_K20_COLS = ["order_id", "part_id", "qty", "price", "discount", "mystery", "flag", "status_code", "ship_date", "item_id",
             "constant_col", "target"]


@query("k20_dataset_summary", f"""
SELECT count(*) AS "rows", 12 AS "columns",
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM m_items GROUP BY {", ".join(_K20_COLS)}))
       AS duplicate_rows,
       '[{",".join(f'"{c}"' for c in _K20_COLS)}]' AS column_names,
       {", ".join(f"round_even((count(*) - count({c})) / count(*) * 100, 2) AS null_pct_{c}" for c in _K20_COLS)}
FROM m_items""", ("m_items",))
def k20_dataset_summary(spark, sf):
    s = CL.dataset_summary(m_items(spark, sf))
    j = F.col("summary_json")
    return s.select("rows", F.col("columns").cast("int"), "duplicate_rows",
                    F.get_json_object(j, "$.column_names").alias("column_names"),
                    *[F.get_json_object(j, f"$.null_pct.{c}").cast("double").alias(f"null_pct_{c}") for c in _K20_COLS])


# ------------------------------------------------------------------ ledger views over the call log

@query("a8_call_log", _with_log("SELECT *, CAST(NULL AS VARCHAR) AS rule_llm_agree, '' AS error FROM log"), ("m_calls",))
def a8_call_log(spark, sf):
    """The call log appended to its table in three parts and read back with all its fields."""
    root = os.path.join(ensure_checkpoint_dir(spark), f"calls-{uuid.uuid4().hex}")
    log = _log(spark, sf)
    for k in range(3):
        AR.append_call_log(log.where(F.pmod(F.xxhash64("run_id", "timestamp"), F.lit(3)) == k), root)
    return AR.read_call_log(spark, root)


@query("a7_ledger", """
SELECT run_id, agent_name AS step, min(logged_at) AS at FROM m_calls GROUP BY run_id, agent_name""", ("m_calls",))
def a7_ledger(spark, sf):
    """Steps of the calls' runs appended to a ledger and read back."""
    steps = m_calls(spark, sf).groupBy("run_id", F.col("agent_name").alias("step")).agg(F.min("logged_at").alias("at"))
    root = os.path.join(ensure_checkpoint_dir(spark), f"ledger-{uuid.uuid4().hex}")
    store = ST.RunStore(spark, root)
    store.append_ledger(steps)
    return store.ledger()


@query("a10_runs", """
SELECT run_id, min(logged_at) AS created_at, max(logged_at) AS last_at, count(*) AS steps
FROM m_calls GROUP BY run_id""", ("m_calls",))
def a10_runs(spark, sf):
    ledger = m_calls(spark, sf).select("run_id", F.col("agent_name").alias("step"), F.col("logged_at").alias("at"))
    return ST.list_runs(ledger)


# the reports of a run: one row per logged call of the stage
_REPORT = """report AS (
  SELECT run_id, agent_name AS stage, prompt_strategy AS "column", 'latency_ms' AS metric,
         CAST(count(*) AS VARCHAR) AS value FROM m_calls GROUP BY run_id, agent_name, prompt_strategy)"""


def _stage_report(spark, sf):
    return m_calls(spark, sf).groupBy("run_id", F.col("agent_name").alias("stage"), F.col("prompt_strategy").alias("column")).agg(
        F.lit("latency_ms").alias("metric"), F.count(F.lit(1)).cast("string").alias("value"))


@query("a6_stage_report", f"""
WITH {_REPORT} SELECT run_id, "column", metric, value FROM report
WHERE stage = (SELECT min(stage) FROM report)""", ("m_calls",))
def a6_stage_report(spark, sf):
    rep = _stage_report(spark, sf)
    first = rep.agg(F.min("stage")).first()[0]
    return ST.stage_report(rep, first).select("run_id", "column", "metric", "value")


@query("a11_bundle", f"""
WITH {_REPORT}
SELECT run_id, stage, string_agg("column" || '.' || metric || '=' || value, ';' ORDER BY "column", metric, value) AS entries
FROM report WHERE run_id = 'run_0' GROUP BY run_id, stage""", ("m_calls",))
def a11_bundle(spark, sf):
    b = ST.run_bundle(_stage_report(spark, sf), "run_0")
    line = F.transform("entries", lambda e: F.concat(e["column"], F.lit("."), e["metric"], F.lit("="), e["value"]))
    return b.select("run_id", "stage", F.array_join(line, ";").alias("entries"))
