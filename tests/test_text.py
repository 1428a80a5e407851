"""Call-log detectors: rules exercised by replies written for this test."""

import json

from pyspark.sql import functions as F

from tableprep.functions import text as TX

# (reply, strategy, score, backtrack): score = 3 + 0.5 (justification or risk_summary) + 0.3 (backtrack)
# + 0.4 (risk_level or risk_note) + 0.3 (readiness_score) + 0.3 (treatment), worked out by hand
CASES = [
    ('{"risk_summary": [], "backtrack": null, "risk_note": 0}', "cdp", 4.5, 0),
    (' [{"justification": 1}, 4]', "cdp", 3.3, 0),
    ('["risk_level", "x"]', "baseline", 3.4, 0),
    ('{"inner": {"readiness_score": 9}, "backtrack": []}', "cdp", 3.6, 0),
    ('{}', "baseline", 3.0, 0),
    ('{"readiness_score": 50}', "baseline", 3.3, 0),
    ('"no justification"', "baseline", 3.5, 0),
    ("we Backtrack here", "baseline", 2.5, 1),
    ("12", "cdp", 3.5, 0),
    ("plain words", "cdp", 3.5, 0),
    ('{"backtrack": "no"}', "cdp", 3.6, 1),
    ('{"backtrack": -0.0}', "cdp", 3.6, 0),
    ('["backtrack"]', "baseline", 3.3, 1),
    ('{"justification": 1, "backtrack": true, "backtrack": false}', "baseline", 3.8, 0),
    ('{"backtrack": 0, "backtrack": 2, "risk_note": NaN}', "cdp", 4.0, 1),
    ('{"backtrack": NaN}', "baseline", 3.3, 1),
    ('{"backtrack": [-Infinity, 1]}', "baseline", 3.3, 1),
    ("{'backtrack': 1}", "baseline", 2.5, 1),
    ('{"a": 1} trailing', "baseline", 2.5, 0),
]


def test_cases_agree_with_a_strict_reading_of_the_rules():
    for reply, strategy, score, back in CASES:
        try:
            data = json.loads(reply)
        except ValueError:
            data = None
        if isinstance(data, (dict, list, str)):
            has = lambda *ks: any(k in data for k in ks)
            s = (3 + 0.5 * has("justification", "risk_summary") + 0.3 * has("backtrack") + 0.4 * has("risk_level", "risk_note")
                 + 0.3 * has("readiness_score") + 0.3 * (strategy == "cdp"))
            assert round(s, 2) == score, reply
        assert back == (bool(data.get("backtrack")) if isinstance(data, dict) else "BACKTRACK" in reply.upper()), reply


def test_quality_score_and_backtrack(spark):
    df = spark.createDataFrame([(t, s) for t, s, _, _ in CASES], "t string, s string")
    got = df.select(TX.quality_score(F.col("t"), F.col("s")).alias("q"), TX.backtrack(F.col("t")).alias("b")).collect()
    assert [r["q"] for r in got] == [c[2] for c in CASES]
    assert [int(r["b"]) for r in got] == [c[3] for c in CASES]


def test_silent_failure_no_newline_crossing(spark):
    df = spark.createDataFrame([("A Mean hiding FRAUD",), ("mean\nfraud",), ("a one_hot with high-cardinality",)],
                               "t string")
    assert [r[0] for r in df.select(TX.silent_failure(F.col("t"))).collect()] == [True, False, True]


def test_tokens_truncate_reply_score(spark):
    df = spark.createDataFrame([("x" * 1003, "Score: 4/5"), ("", "none")], "t string, r string")
    got = df.select(TX.token_estimate(F.col("t")), F.char_length(TX.truncate(F.col("t"))),
                    TX.score_from_reply(F.col("r"))).collect()
    assert [tuple(r) for r in got] == [(250, 800, 4.0), (0, 0, None)]


def test_lenient_json_fences(spark):
    df = spark.createDataFrame([("```json\n{\"a\": 1}\n```",), ("  nope ",)], "t string")
    got = df.select(TX.lenient_json(F.col("t")).alias("j")).select("j.ok", "j.cleaned").collect()
    assert [tuple(r) for r in got] == [(True, '{"a": 1}'), (False, "nope")]


def _summary(spark, rows):
    return spark.createDataFrame(rows, "agent_name string, prompt_strategy string, avg_latency_ms double, "
                                       "avg_quality_score double, silent_failure_rate double, backtrack_rate double, "
                                       "avg_tokens_in double, avg_tokens_out double, call_count long")


def test_pivot_and_deltas(spark):
    from tableprep.operators import calllog as CL
    rows = [("x", "baseline", 10.5, 3.0, 0.1, 0.0, 9.0, 4.0, 2), ("x", "cdp", 8.25, 3.75, 0.0, 0.5, 90.0, 12.0, 2),
            ("x", "third", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1), ("y", "cdp", 7.0, 4.0, 0.0, 0.0, 3.0, 3.0, 1)]
    d = {r["agent_name"]: r for r in CL.deltas(CL.pivot(_summary(spark, rows))).collect()}
    assert (d["x"]["avg_quality_score_delta"], d["x"]["avg_latency_ms_delta"], d["x"]["silent_failure_rate_delta"]) == (0.75, -2.25, -0.1)
    assert d["x"]["avg_latency_ms_third"] == 1.0 and d["y"]["avg_latency_ms_third"] is None
    assert d["y"]["avg_quality_score_delta"] is None


def test_boundaries_follow_the_order_of_the_summary(spark):
    from tableprep.operators import calllog as CL
    rows = [(a, s, 1.0, 1.0, 0.0, 0.0, 1.0, 1.0, 1) for a in "edcba" for s in ("baseline", "cdp")]
    got = sorted(tuple(r) for r in CL.boundary_marks(_summary(spark, rows)).select("position", "label", "boundary").collect())
    want = [(f"{s.upper()} | {a}") for a in "abcde" for s in ("baseline", "cdp")]
    assert got == [(i + 1, w, i > 0) for i, w in enumerate(want)]


# Recorded per-agent means of output tokens (seven agents) and the break-even rate they give.
RECORDED_TOKENS, RECORDED_BREAK_EVEN = (98 / 7, 572 / 7), 0.967


def test_break_even_from_recorded_means(spark):
    from tableprep.operators import calllog as CL
    r = CL.retry_cost(spark.createDataFrame([RECORDED_TOKENS], "tok_out_b double, tok_out_c double")).first()
    assert round(r["break_even"], 3) == RECORDED_BREAK_EVEN


def test_templates_fill_like_str_format(spark):
    from tableprep.plans.render import render
    df = spark.createDataFrame([("{b}", 2, None)], "a string, b int, c string")
    templates = {"one": "{{{a}}} {b}{{x}} {c}", "two": "{a} {missing}", "three": "no place"}
    got = {r["template_id"]: r["prompt"] for r in render(df, templates).collect()}
    assert got == {"one": templates["one"].format(a="{b}", b=2, c=None), "two": templates["two"], "three": "no place"}
