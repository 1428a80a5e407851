"""Sources and sinks: JSON intake, run store (snapshots, report, ledger), artefacts."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tableprep.operators import calllog as CL
from tableprep.plans.fixtures import m_calls
from tableprep.sources import artifacts as AR
from tableprep.sources.ingest import intake_profile, read_any
from tableprep.sources.store import RunStore, list_runs, run_bundle

SF = "/root/testdata/sf0.001"


def test_read_json_array_and_lines(spark):
    d = tempfile.mkdtemp(prefix="tp-json-")
    arr, lines = os.path.join(d, "a.json"), os.path.join(d, "l.jsonl")
    recs = [{"x": 1, "y": "a"}, {"x": None, "y": "b"}, {"x": 3.5, "y": None}]
    with open(arr, "w") as f:
        json.dump(recs, f, indent=1)
    with open(lines, "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    for p, as_lines in ((arr, False), (lines, True), (os.path.dirname(lines) + "/*.jsonl", True)):
        df = read_any(spark, p, "json", json_lines=as_lines)
        assert df.count() == 3 and df.where(F.col("x").isNull()).count() == 1
    prof = intake_profile(read_any(spark, arr, "json", json_lines=False), arr, "json").first()
    assert prof["rows"] == 3 and prof["columns"] == 2
    with pytest.raises(ValueError):
        read_any(spark, arr, "json", json_lines=True)


def test_csv_quotes_and_quoted_newlines(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="tp-csv-"), "q.csv")
    with open(p, "w") as f:
        f.write('a,b\n1,"say ""hi"", ok"\n2,"two\nlines"\n')
    assert [tuple(r) for r in read_any(spark, p, "csv").orderBy("a").collect()] == [(1, 'say "hi", ok'), (2, "two\nlines")]
    assert read_any(spark, os.path.dirname(p), "csv").count() == 2


def test_second_snapshot_keeps_the_first(spark):
    st = RunStore(spark, tempfile.mkdtemp(prefix="tp-store-"))
    one = st.save_snapshot(spark.range(3).toDF("x"), "r", "intake")
    two = st.save_snapshot(one.where("x > 0"), "r", "types")
    assert (one.count(), two.count(), st.load_snapshot("r").count(), st.load_snapshot("r", "intake").count()) == (3, 2, 2, 3)
    with pytest.raises(ValueError):
        st.load_snapshot("other")


def test_stage_report_and_bundle(spark):
    st = RunStore(spark, tempfile.mkdtemp(prefix="tp-store-"))
    assert st.stage_report("r", "audit").count() == 0
    st.add_report("r", "audit", [("b", "null_count", 2), ("a", "null_count", 1)])
    st.add_report("r", "types", [("a", "semantic", "id")])
    st.add_report("s", "types", [("a", "semantic", "text")])
    assert st.stage_report("r", "types").first()["value"] == "id" and st.stage_report("r", "select").count() == 0
    got = {r["stage"]: [tuple(e) for e in r["entries"]] for r in run_bundle(st.report(), "r").collect()}
    assert got == {"audit": [("a", "null_count", "1"), ("b", "null_count", "2")], "types": [("a", "semantic", "id")]}


def test_run_store_persists_report_ledger_snapshot(spark, items):
    root = tempfile.mkdtemp(prefix="tp-store-")
    st = RunStore(spark, root)
    snap = st.save_snapshot(items.select("order_id", "qty"), "r1", "intake")
    assert snap.count() == items.count()
    st.add_report("r1", "audit", [("qty", "null_count", 3), (None, "overall_quality", "FAIR")],
                  label="quality_report")
    st.add_report("r2", "audit", [(None, "overall_quality", "GOOD")], label="quality_report")
    rep = st.report()
    assert rep.where("run_id = 'r1'").count() == 2
    runs = list_runs(st.ledger()).collect()
    assert {r["run_id"] for r in runs} == {"r1", "r2"} and runs[0]["last_at"] >= runs[-1]["last_at"]
    b = run_bundle(rep, "r1").first()
    assert (b["stage"], len(b["entries"])) == ("audit", 2)
    assert st.steps("r1") == {"intake", "quality_report"}


def test_call_log_artifacts_round_trip(spark):
    root = tempfile.mkdtemp(prefix="tp-art-")
    log = CL.call_log(m_calls(spark, SF))
    AR.append_call_log(log, os.path.join(root, "log"))
    AR.append_call_log(log, os.path.join(root, "log"))          # append, never overwrite
    back = AR.read_call_log(spark, os.path.join(root, "log"))
    assert back.count() == 2 * log.count()
    summ = CL.group_summary(back)
    AR.write_table_csv(summ, os.path.join(root, "summary"))
    again = AR.read_summary_csv(spark, os.path.join(root, "summary"))
    assert again.count() == summ.count()
    rep = AR.run_report(back, summ, "mock").first()
    assert rep["total_calls"] == back.count() and len(rep["summary_table"]) == summ.count()
    AR.write_json(AR.run_report(back, summ, "mock"), os.path.join(root, "report"))
    assert spark.read.json(os.path.join(root, "report")).count() == 1


def test_a_run_commits_once_per_stage_and_compacts(spark, items):
    from tableprep.plans.prepare import prepare
    st = RunStore(spark, tempfile.mkdtemp(prefix="tp-log-"))
    done = prepare(items, "target", store=st, run_id="r")
    assert st.log.files() <= len(done.steps_completed) + 1          # one file a stage, and one for the parameters
    before = [sorted(map(str, x.collect())) for x in (st.report(), st.ledger(), list_runs(st.ledger()))]
    st.compact()
    assert st.log.files() == 1
    other = RunStore(spark, st.root)
    assert before == [sorted(map(str, x.collect())) for x in (other.report(), other.ledger(), list_runs(other.ledger()))]
    assert set(other.load_fits("r")) == set(st.load_fits("r")) >= {"run", "types", "select"}


def test_log_while_and_after_a_compaction(spark, monkeypatch):
    from tableprep.sources.log import LogTable
    log = LogTable(spark, tempfile.mkdtemp(prefix="tp-log-"), "n int")
    got = lambda: sorted(r[0] for r in log.read().collect())
    log.compact()
    assert got() == [] and log.files() == 0
    for k in range(4):
        log.append([(k,)])
    real = log._create

    def slow(number, content):                      # a commit between the new base and its manifest
        assert got() == [0, 1, 2, 3]
        log.append([(4,)])
        real(number, content)
    monkeypatch.setattr(log, "_create", slow)
    log.compact()
    assert got() == [0, 1, 2, 3, 4] and log.files() == 2 and log.vacuum() == 0
    monkeypatch.setattr(log, "_create", lambda number, content: (real(number, content), real(number, content)))
    with pytest.raises(RuntimeError, match="another compaction"):
        log.compact()
    assert got() == [0, 1, 2, 3, 4] and log.files() == 1
    old = log.read()
    assert log.vacuum() > 0 and got() == [0, 1, 2, 3, 4] and old.count() == 5
    log.append([(5,)])
    assert got() == [0, 1, 2, 3, 4, 5]


def test_a_failing_batch_leaves_nothing(spark):
    st = RunStore(spark, tempfile.mkdtemp(prefix="tp-log-"))
    with pytest.raises(ZeroDivisionError):
        with st.batch():
            st.add_report("r", "audit", [("a", "b", 1)])
            assert st.steps("r") == {"audit_report"}
            1 / 0
    assert st.steps("r") == set() and st.report().count() == 0 and st.log.files() == 0
    with st.batch():
        st.add_report("r", "audit", [("a", "b", 1)])
        st.log_step("r", "x")
    assert st.log.files() == 1 and st.steps("r") == {"audit_report", "x"}
