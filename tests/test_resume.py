"""Fitted state saved and loaded, resumed runs, and advice from a callable (A5, I2-I4)."""
import datetime
import decimal
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tableprep.operators import advise as AD
from tableprep.operators import outliers as OU
from tableprep.operators import select as SE
from tableprep.operators.impute import ColumnAction, ImputeFit
from tableprep.plans.prepare import StageError, prepare
from tableprep.sources import fits as FI
from tableprep.sources.store import RunStore
from tableprep.streaming.apply import apply_fitted


def store(spark, root=None):
    return RunStore(spark, root or tempfile.mkdtemp(prefix="tp-fits-"))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("action", ["clip", "flag", "drop"])
def test_another_driver_applies_a_saved_run(spark, items, action):
    """A second store object, as on another driver, gives the same result on the same and the same form on new rows."""
    one = store(spark)
    done = prepare(items, "target", outlier_action=action, polynomial=True, store=one, run_id="r")
    fits = RunStore(spark, one.root).load_fits("r")
    assert rows(apply_fitted(items, fits)) == rows(done.df)
    for name in ("audit", "types", "missing", "outliers", "select"):
        assert fits[name] == done.fits[name]
    new = items.where("part_id % 7 = 0").withColumn("flag", F.lit("unseen"))
    assert apply_fitted(new, fits).schema == done.df.schema
    assert set(r[0] for r in apply_fitted(new, fits).select("flag_encoded").distinct().collect()) == {-1}


@pytest.mark.parametrize("broken, left", [("select", ["select", "validate"]), ("outliers", ["outliers", "features", "select", "validate"])])
def test_a_failed_run_goes_on_where_it_failed(spark, items, monkeypatch, broken, left):
    one = store(spark)
    module, name = {"select": (SE, "fit_select"), "outliers": (OU, "fit_outliers")}[broken]
    whole = prepare(items, "target", run_id="whole", store=store(spark))

    def fail(*a, **k):
        raise RuntimeError("an executor too many")
    with monkeypatch.context() as m:
        m.setattr(module, name, fail)
        with pytest.raises(StageError) as e:
            prepare(items, "target", store=one, run_id="r")
    assert e.value.failed_at == broken
    calls = []
    for mod, fn in ((OU, "fit_outliers"), (SE, "fit_select")):
        real = getattr(mod, fn)
        monkeypatch.setattr(mod, fn, lambda *a, real=real, fn=fn, **k: calls.append(fn) or real(*a, **k))
    again = prepare(items, "target", store=RunStore(spark, one.root), run_id="r", resume=True)
    assert again.steps_resumed == [s for s in again.steps_completed if s not in (*left, "intake")]
    assert ("fit_outliers" in calls) == (broken == "outliers") and "fit_select" in calls
    assert rows(again.df) == rows(whole.df) and again.status == whole.status
    assert {k: str(v) for k, v in again.stats.items()} == {k: str(v) for k, v in whole.stats.items()}
    # the report is that of one run: no stage reported twice
    assert rows(again.report().where("stage <> 'validate'").drop("run_id")) == rows(whole.report().where("stage <> 'validate'").drop("run_id"))


def test_resume_asks_for_the_same_run(spark, items):
    one = store(spark)
    with pytest.raises(ValueError, match="saved no fits"):
        prepare(items, "target", store=one, run_id="r", resume=True)
    prepare(items, "target", store=one, run_id="r")
    with pytest.raises(ValueError, match="another outlier_action"):
        prepare(items, "target", outlier_action="drop", store=one, run_id="r", resume=True)
    with pytest.raises(ValueError, match="another columns"):
        prepare(items.drop("qty"), "target", store=one, run_id="r", resume=True)


def test_saved_form_keeps_every_type(spark):
    inf = float("inf")
    fit = ImputeFit({c: ColumnAction(c, 0.5, "constant", v, "x") for c, v in {
        "i": 1 << 60, "f": -inf, "s": "ü\n", "b": True, "n": None, "d": datetime.date(2020, 2, 29), "m": decimal.Decimal("0.10"),
        "t": datetime.datetime(2020, 1, 1, 5, tzinfo=datetime.timezone.utc), "u": datetime.datetime(2020, 1, 1, 0, 0, 0, 7),
        "y": b"\x00\xff", "l": [1, (2, None)], "e": {None: 1, 3: "x"}}.items()})
    one = store(spark)
    one.save_fit("r", "missing", fit)
    assert one.load_fits("r")["missing"] == fit == FI.unpack(FI.pack(fit))
    assert one.load_fits("other") == {}
    with pytest.raises(TypeError):
        FI.pack(object())
    one.log.append([("fit", "r", "missing", None, str(FI.VERSION + 1), "{}", datetime.datetime(2999, 1, 1))])
    with pytest.raises(FI.FitVersionError):
        one.load_fits("r")


# --- adviser

def test_advice_for_every_row_and_every_fault(spark):
    def call(row):
        k = row["k"]
        if k % 5 == 0:
            raise RuntimeError(f"no {k}")
        return [{"n": k, "why": None}, {"n": "text", "why": "x"}, {"n": k}, 7][k % 5 - 1]
    df = spark.range(0, 500).withColumnRenamed("id", "k").withColumn("x", F.array(F.col("k"))).repartition(3)
    got = AD.advise_rows(df, call, "n int, why string", batch_rows=7)
    assert got.schema.simpleString() == "struct<k:bigint,x:array<bigint>,n:int,why:string,advice_error:string>"
    out = {r["k"]: r for r in got.collect()}
    assert sorted(out) == list(range(500)) and all(r["x"] == [k] for k, r in out.items())
    for k, r in out.items():
        want = [f"RuntimeError: no {k}", None, "TypeError: n: 'text' is no int32", "KeyError: 'the answer lacks why'",
                "TypeError: the answer is a int, not a dict"][k % 5]
        assert (r["n"], r["why"], r["advice_error"]) == (k if k % 5 == 1 else None, None, want)


def test_slow_calls_are_given_up(spark):
    def call(row):
        if row["k"] == 3:
            time.sleep(30)
        return {"n": row["k"]}
    began = time.time()
    out = {r["k"]: r for r in AD.advise_rows(spark.range(0, 6).withColumnRenamed("id", "k").coalesce(1), call, "n long",
                                             timeout=0.5).collect()}
    assert time.time() - began < 20
    assert [out[k]["n"] for k in range(6)] == [0, 1, 2, None, 4, 5] and "no answer in 0.5 s" in out[3]["advice_error"]


def test_attempts_and_clashing_columns(spark):
    tries = []

    def call(row):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("busy")
        return {"n": len(tries)}
    df = spark.range(0, 1)
    assert AD.advise_rows(df, call, "n int", attempts=3).first()["n"] == 3
    assert "busy" in AD.advise_rows(df, call, "n int", attempts=2).first()["advice_error"]
    for schema in ("id int", "n int, advice_error string"):
        with pytest.raises(ValueError):
            AD.advise_rows(df.withColumn("advice_error", F.lit("x")) if "error" in schema else df, call, schema)
    assert AD.advise_rows(df.limit(0), call, "n int").collect() == []


def test_adviser_of_a_run(spark, items):
    def call(facts):
        if facts["column"] == "flag":
            raise RuntimeError("no idea")
        return {"strategy": {"qty": "mean", "discount": "magic"}.get(facts["column"], "mode")}
    done = prepare(items, "target", adviser=call, store=store(spark))
    actions = {c: a.action for c, a in done.fits["missing"].actions.items()}
    assert (actions["qty"], actions["discount"], actions["flag"], actions["mystery"]) == ("mean", "median", "mode", "drop")
    faults = {r["column"]: r["value"] for r in done.report().where("metric = 'advice_error'").collect()}
    assert faults == {"flag": "RuntimeError: no idea", "discount": "unknown strategy magic"}
    done = prepare(items, "target", adviser=call, overrides={"qty": "constant"})
    assert done.fits["missing"].actions["qty"].action == "constant"
