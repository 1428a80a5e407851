"""Per-stage edge cases on tiny literal frames."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tableprep.functions.stats import quantiles
from tableprep.operators import features as FE
from tableprep.operators import impute as IM
from tableprep.operators import outliers as OU
from tableprep.operators import profile as PR
from tableprep.operators import select as SE
from tableprep.operators import types as TY


def test_empty_frame_profile(spark):
    df = spark.createDataFrame([], "a double, b string")
    prof = {r["column"]: r for r in PR.column_profile(df).collect()}
    assert prof["a"]["null_count"] == 0 and prof["a"]["null_pct"] is None
    assert PR.duplicate_rows(df).first()["duplicate_rows"] == 0


def test_duplicates_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a long, b string")
    assert PR.duplicate_rows(df).first()["duplicate_rows"] == 1


def test_zero_variance_all_null_and_constant(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0), (None, 1.0, 2.0)], "a double, b double, c double")
    assert sorted(r["column"] for r in PR.zero_variance(df).collect()) == ["a", "b"]


def test_rating_rules(spark):
    df = spark.createDataFrame([(1.0, None)] * 3, "a double, b double")
    r = PR.overall_rating(df).first()
    # b is 100 % null (HIGH NULLS), duplicates (DUPLICATES), a and b zero variance -> 4 flags
    assert r["n_flags"] == 4 and r["overall_quality"] == "POOR"


def test_semantic_rules(spark):
    rows = [(i, float(i % 3), f"2024-01-{(i % 28) + 1:02d}", "k" if i % 2 else "j", f"t{i}", True, None)
            for i in range(100)]
    df = spark.createDataFrame(rows, "id long, num double, d string, cat string, txt string, flag boolean, "
                                     "empty string")
    sem = TY.fit_types(df, "exact").semantic
    assert sem == {"id": "id", "num": "numeric", "d": "datetime", "cat": "categorical", "txt": "text",
                   "flag": "unknown", "empty": "datetime"}


def test_mode_tie_smallest_and_median(spark):
    df = spark.createDataFrame([(1.0, "b"), (1.0, "b"), (2.0, "a"), (2.0, "a"), (None, None)], "x double, s string")
    fit = IM.fit_impute(df, {"x": "numeric", "s": "categorical"}, overrides={"x": "mode"})
    assert fit.actions["x"].fill == 1.0 and fit.actions["s"].fill == "a"
    fit2 = IM.fit_impute(df, {"x": "numeric", "s": "categorical"})
    assert fit2.actions["x"].fill == 1.5
    out = IM.apply_impute(df, fit2)
    assert out.where(F.col("x").isNull() | F.col("s").isNull()).count() == 0


def test_drop_threshold_inclusive(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), (None,), (None,), (None,), (None,), (1.0,), (2.0,), (3.0,)],
                               "x double")
    assert IM.fit_impute(df, {"x": "numeric"}).actions["x"].action == "drop"   # exactly 0.7


def test_quantiles_match_pandas(spark):
    vals = [float(v) for v in [5, 1, 9, 3, 3, 7, 2, 8, 8, 10, 4]] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"]
    exp = pd.Series(vals).quantile([0.25, 0.5, 0.75]).tolist()
    assert got == pytest.approx(exp)


def test_quantiles_refinement_large(spark):
    # more distinct values than max_local forces the bracket refinement
    df = spark.range(0, 20000).select(((F.col("id") * 7919) % 20011).cast("double").alias("x"))
    got = quantiles(df, ["x"], [0.1, 0.5, 0.9], max_local=500)["x"]
    exp = pd.Series(df.toPandas()["x"]).quantile([0.1, 0.5, 0.9]).tolist()
    assert got == pytest.approx(exp)


def test_iqr_zero_rare_target_and_clip_idempotent(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "t long")
    fit = OU.fit_outliers(df)
    assert fit.fences["t"].iqr == 0
    assert OU.total_outlier_rows(df, fit).first()["total_outlier_rows"] == 1
    once = OU.clip(df, fit)
    twice = OU.clip(once, OU.OutlierFit(fit.fences))
    assert sorted(r[0] for r in once.collect()) == sorted(r[0] for r in twice.collect())


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (100.0,), (None,)], "x double")
    out = OU.clip(df, OU.fit_outliers(df)).collect()
    assert sum(r[0] is None for r in out) == 1


def test_encode_codes_and_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "s string")
    out = FE.apply_encode(df, FE.fit_encode(df, ["s"])).collect()
    codes = {r["s"]: r["s_encoded"] for r in out}
    assert codes == {"a": 0, "b": 1, "c": 2, None: -1}


def test_date_parts_monday_zero(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-06",)], "d string")   # Monday, Saturday
    t = TY.fit_types(df)
    out = FE.date_parts(TY.apply_types(df, t), ["d"]).collect()
    assert [(r["d_dayofweek"], r["d_is_weekend"]) for r in out] == [(0, False), (5, True)]


def test_corr_constant_side_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, None), (1.0, 2.0, 5.0), (1.0, 3.0, 5.0), (2.0, 4.0, None)],
                               "a double, b double, c double")
    got = {(r["a"], r["b"]): r["r"] for r in SE.correlation_table(df).collect()}
    assert got[("b", "c")] is None          # c constant on the rows both are set
    assert got[("a", "b")] == pytest.approx(pd.Series([1, 1, 1, 2.0]).corr(pd.Series([1, 2, 3, 4.0])))


def test_corr_filter_drops_later_column(spark):
    df = spark.range(0, 200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"),
                                    F.rand(7).alias("c"), (F.col("id") % 2).alias("y"))
    fit = SE.fit_select(df, "y")
    assert fit.high_correlation == ["b"]
    assert SE.apply_select(df, fit).columns[-1] == "y"


def test_unknown_target_raises(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError):
        SE.fit_select(df, "nope")


def test_column_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1.0, None), (None, "x")], "`a.b` double, `c d` string")
    prof = {r["column"]: r["null_count"] for r in PR.column_profile(df).collect()}
    assert prof == {"a.b": 1, "c d": 1}
    fit = IM.fit_impute(df, {"a.b": "numeric", "c d": "categorical"}, drop_threshold=1.0)
    assert IM.apply_impute(df, fit).where(F.col("`a.b`").isNull()).count() == 0


def test_nan_normalised(spark):
    from tableprep.functions.columns import nan_to_null
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert nan_to_null(df).where(F.col("x").isNull()).count() == 1
    assert not any(isinstance(r[0], float) and math.isnan(r[0]) for r in nan_to_null(df).collect())


def test_advice_table_overrides_and_drop(spark):
    df = spark.createDataFrame([(1.0, None), (None, "a"), (3.0, "b")], "x double, s string")
    advice = spark.createDataFrame([("x", "mean"), ("s", "drop")], "column string, strategy string")
    fit = IM.fit_impute(df, {"x": "numeric", "s": "categorical"}, overrides=advice)
    out = IM.apply_impute(df, fit)
    assert out.columns == ["x"] and sorted(r[0] for r in out.collect()) == [1.0, 2.0, 3.0]


def test_dictionary_codes_and_first_appearance(spark):
    rows = [(f"v{i % 37:02d}", 500 - i) for i in range(500)] + [(None, 999)]
    df = spark.createDataFrame(rows, "s string, o long")
    codes = {r["s"]: r["s_encoded"] for r in FE.apply_encode(df, FE.fit_encode(df, ["s"])).collect()}
    assert codes == {None: -1, **{f"v{i:02d}": i for i in range(37)}}
    order = []
    for s, _ in sorted(rows[:-1], key=lambda r: r[1]):
        order += [s] if s not in order else []
    first = {r["s"]: r["s_encoded"] for r in FE.apply_encode(df, FE.fit_encode(df, ["s"], order_by="o")).collect()}
    assert first == {None: -1, **{s: i for i, s in enumerate(order)}}


def test_typed_values_are_exact(spark):
    import datetime as dt
    from decimal import Decimal
    big, dec = 1 << 60, 12345678901234567890123456789012345678
    t = dt.datetime(2024, 1, 1, 12, 0, 0, 500_000)
    rows = [(big + i, Decimal(dec + i), t + dt.timedelta(milliseconds=i), dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(10)]
    schema = "a long, b decimal(38,0), c timestamp_ntz, d date"
    df = spark.createDataFrame(rows, schema)
    assert {r["column"]: r["n_distinct"] for r in TY.distinct_ratio(df).collect()} == dict.fromkeys("abcd", 10)
    df = spark.createDataFrame([*rows[:3], rows[2], (None,) * 4], schema)
    fit = IM.fit_impute(df, dict.fromkeys("abcd", "categorical"))
    assert (fit.actions["a"].fill, fit.actions["b"].fill, fit.actions["c"].fill, fit.actions["d"].fill) == rows[2]
    out = IM.apply_impute(df, fit).collect()[-1]
    assert (out["c"], out["d"]) == rows[2][2:]


def test_columns_without_a_fill_are_carried_through(spark):
    import datetime as dt
    df = spark.createDataFrame([([1], {"a": 1}, dt.date(2024, 1, 1)), (None, None, None)],
                               "a array<int>, m map<string,int>, d date")
    fit = IM.fit_impute(df, {}, overrides={"d": "constant"})
    assert {c: a.action for c, a in fit.actions.items()} == dict.fromkeys("amd", "skipped")
    assert IM.apply_impute(df, fit).where("a IS NULL AND m IS NULL AND d IS NULL").count() == 1
    fit = IM.fit_impute(df, {}, overrides={"d": "constant"}, constant=dt.date(2000, 1, 1))
    assert IM.apply_impute(df, fit).where("d = DATE'2000-01-01'").count() == 1


def test_map_columns_count_for_duplicates(spark):
    rows = [({"k": i, "j": 0}, [{"x": i}]) for i in range(40)] + [({"j": 0, "k": 3}, [{"x": 3}])]
    df = spark.createDataFrame(rows, "m map<string,int>, a array<map<string,int>>")
    assert PR.duplicate_rows(df).first()["duplicate_rows"] == 1


@pytest.mark.parametrize("bits", [64, 2, 0])
@pytest.mark.parametrize("most", [1_000_000, 0])
def test_duplicates_with_colliding_digests(spark, monkeypatch, bits, most):
    """Digests cut to few bits collide all the time; NULLs in other places and empty lists are other rows."""
    real = PR.row_digest
    monkeypatch.setattr(PR, "row_digest", lambda keys: [F.shiftrightunsigned(c, 64 - bits).alias(n) if bits else F.lit(0).alias(n)
                                                        for c, n in zip(real(keys), ("d0", "d1"))] if bits < 64 else real(keys))
    rows = [(1, None, []), (None, 1, []), (1, None, [None]), (1, None, []), (None, None, None), (None, None, None)]
    rows += [(i % 40, i % 3, [i % 2]) for i in range(300)] + [(7, 7, [7])] * 200
    df = spark.createDataFrame(rows, "a int, b int, c array<int>").repartition(4)
    exp = len(rows) - len({(a, b, None if c is None else tuple(c)) for a, b, c in rows})
    assert PR.duplicate_rows(df, most).first()["duplicate_rows"] == exp
    assert PR.duplicate_rows(df.distinct(), most).first()["duplicate_rows"] == 0
    assert PR.duplicate_rows(df.limit(0), most).first()["duplicate_rows"] == 0


def test_quantile_brackets_are_proved_before_they_are_collected(spark, monkeypatch):
    from tableprep.functions import stats
    df = spark.range(0, 6000).select(F.when(F.col("id") < 3000, F.col("id") * 1e-6).otherwise(F.col("id") * 1e6).alias("x"))
    exp = pd.Series(df.toPandas()["x"]).quantile([0.1, 0.5, 0.5001]).tolist()
    assert quantiles(df, ["x"], [0.1, 0.5, 0.5001], max_local=40, accuracy=50)["x"] == pytest.approx(exp)
    real = stats._narrow

    def misled(d, wide, eps, accuracy):                     # sketches that miss: halving still closes in
        for t in wide:
            t["halve"] = True
        return real(d, wide, eps, accuracy)
    monkeypatch.setattr(stats, "_narrow", misled)
    assert quantiles(df, ["x"], [0.1, 0.5, 0.5001], max_local=200)["x"] == pytest.approx(exp)


def test_quantiles_of_heavy_values_infinities_nan_and_empty_columns(spark, monkeypatch):
    from tableprep.functions import stats
    inf, nan = float("inf"), float("nan")
    cols = {"few": [float(i % 3) for i in range(3000)], "one": [7.0] * 3000, "none": [None] * 3000,
            "ends": [-inf if i % 3 == 0 else inf if i % 3 == 1 else float(i) for i in range(3000)],
            "nan": [nan if i % 2 else float(i) for i in range(3000)], "huge": [(-1) ** i * 1.7e308 / (i + 1) for i in range(3000)],
            "tiny": [5e-324 * (i % 9) for i in range(3000)], "gap": [float(i) if i % 2 else None for i in range(3000)],
            "hot": [5.0 if i % 3 else float(i) for i in range(3000)]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    probs = [0.0, 0.2, 0.25, 0.5, 0.999, 1.0]

    def exact(values, p):
        v = sorted((x for x in values if x is not None), key=lambda x: (x != x, x))
        if not v:
            return None
        h = (len(v) - 1) * p
        a, z = v[int(h)], v[-int(-h // 1)]
        return a if a == z else a + (z - a) * (h - int(h))

    want = {c: [exact(v, p) for p in probs] for c, v in cols.items()}
    real = stats._narrow

    def halving(d, wide, eps, size):
        for t in wide:
            t["halve"] = True
        return real(d, wide, eps, size)
    for most, accuracy, narrow in ((5000, 10000, real), (5, 40, real), (5, 40, halving)):
        monkeypatch.setattr(stats, "_narrow", narrow)
        got = quantiles(df, list(cols), probs, max_local=most, accuracy=accuracy)
        for c in cols:
            assert got[c] == (want[c] if want[c][0] is None else pytest.approx(want[c], nan_ok=True, rel=1e-12)), c


def test_quantiles_of_many_columns_go_in_chunks(spark):
    from tableprep.functions import stats
    n = 2 * stats.CHUNK + 3
    df = spark.range(0, 101).select(*[(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(n)])
    assert quantiles(df, df.columns, [0.25, 0.5]) == {f"c{i}": [25.0 * (i + 1), 50.0 * (i + 1)] for i in range(n)}


def test_group_quantiles_of_any_number_of_groups(spark):
    from tableprep.functions.stats import group_quantile
    pdf = pd.DataFrame([(None if g == 7 else f"g{g}", float((i * 7919) % 1009) ** 2) for g in range(9) for i in range(5 + 60 * g)],
                       columns=["g", "v"])
    df = spark.createDataFrame([tuple(r) for r in pdf.itertuples(index=False)], "g string, v double")
    for p in (0.5, 0.37):
        exp = pdf.groupby("g", dropna=False)["v"].quantile(p)
        exp = {None if isinstance(k, float) else k: v for k, v in exp.items()}
        for most in (200_000, 40):
            got = {r["g"]: r["q"] for r in group_quantile(df, "g", "v", p, accuracy=20, max_rows=most).collect()}
            assert got == pytest.approx(exp)


def test_one_pass_selection_matches_two_pass(spark):
    df = spark.range(0, 300).select((F.col("id") * 1000.0 + 1e9).alias("a"), (F.col("id") * 2.0).alias("b"),
                                    F.rand(3).alias("c"), F.lit(5.0).alias("k"), (F.col("id") % 2).alias("y"))
    two = SE.fit_select(df, "y")
    one = SE.fit_select(df, "y", centers={"a": 1e9 + 150000.0})
    assert (one.low_variance, one.high_correlation, one.kept) == (two.low_variance, two.high_correlation, two.kept)
    assert one.high_correlation == ["b"] and "k" in one.low_variance


def test_sample_values_mixed_types(spark):
    import datetime as dt
    rows = [(3, "b", True, dt.datetime(2024, 1, 2)), (1, "a", False, dt.datetime(2024, 1, 1)),
            (1, None, None, None), (2, "c", True, dt.datetime(2024, 1, 3))]
    df = spark.createDataFrame(rows, "n long, s string, b boolean, t timestamp_ntz")
    got = {(r["column"], r["rank"]): r["value"] for r in PR.sample_values(df, 2).collect()}
    assert got == {("n", 1): "1.0", ("n", 2): "2.0", ("s", 1): "a", ("s", 2): "b",
                   ("b", 1): "false", ("b", 2): "true",
                   ("t", 1): "2024-01-01 00:00:00", ("t", 2): "2024-01-02 00:00:00"}


def test_wide_correlations_are_one_pass(spark):
    import time
    import numpy as np
    x = np.random.default_rng(0).normal(size=(10_000, 200))
    x[:, 150] = x[:, 3] * 2 + 1e-3 * x[:, 150]
    x[::7, 20] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(200)])
    df = spark.createDataFrame(pdf)
    began = time.time()
    fit = SE.fit_select(df)
    assert time.time() - began < 60 and fit.high_correlation == ["c150"]
    got = {(r["a"], r["b"]): r["r"] for r in SE.correlation_table(df, [f"c{i}" for i in range(15, 25)]).collect()}
    corr = pdf.corr()
    assert all(r == pytest.approx(corr.loc[a, b], abs=1e-9) for (a, b), r in got.items())


def test_identical_columns_of_all_types(spark):
    """Pairs by rows: text, longs beyond doubles, numbers of unequal types, dates beside numbers, NULLs, equal rows."""
    import datetime
    import decimal
    from tableprep.operators import gates as G
    big, day = 1 << 53, datetime.date(1970, 1, 3)
    rows = [(big, big + 1, 2, 2.0, decimal.Decimal("2.00"), "x", "x", day, 0.5, decimal.Decimal("0.50"), None, True),
            (big, big, 3, 3.0, decimal.Decimal("3.00"), "y", "y", day, -0.0, decimal.Decimal("0.00"), None, False)] * 2
    rows += [(1, 1, None, None, None, None, None, None, float("nan"), None, None, None)]
    df = spark.createDataFrame(rows, "a long, b long, i int, d double, m decimal(9,2), s string, t string, day date, h double, "
                                     "k decimal(9,2), n string, f boolean").repartition(3)
    cols = df.columns
    got = {r["column"]: (r["observed"], r["fired"]) for r in G.j16_identical_columns(df, cols, cols).collect()}
    same = {(x, x) for x in cols} | {(x, y) for g in (("i", "d", "m"), ("s", "t")) for x in g for y in g}
    for x in cols:
        for y in cols:
            assert got[f"{x}={y}"] == ((0.0, True) if (x, y) in same else (None, False)), (x, y)
    assert G.j16_identical_columns(df, [], cols).collect() == []
    nulls = G.j16_identical_columns(df, [], [], {"i": "a"}).collect()
    assert [(r["rule"], r["column"], r["observed"], r["fired"]) for r in nulls] == [("J16.nulls", "i<-a", 1.0, True)]


def test_identical_columns_with_equal_fingerprints_are_compared(spark, monkeypatch):
    from tableprep.operators import gates as G
    monkeypatch.setattr(G.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    df = spark.createDataFrame([(1, 1, 2), (2, 2, 2), (3, 3, 3)], "a int, b int, c int")
    got = {r["column"]: (r["observed"], r["fired"]) for r in G.j16_identical_columns(df, ["a"], ["b", "c"]).collect()}
    assert got == {"a=b": (0.0, True), "a=c": (1.0, False)}


def _encode_rows(n=3000):
    """A value at 30 %, NULLs at 30 %, rare values, and texts that look like the marks of the lookup."""
    odd = ["", "0", "1", "1x", "spread", "\0", "é"]
    return [("hot" if i % 10 < 3 else None if i % 10 < 6 else f"v{i % 700}", odd[i % 7] if i % 4 else None, f"w{i % 900}",
             None if i % 2 else "two", i % 50) for i in range(n)]


@pytest.mark.parametrize("most", [500_000, 100, 0])
def test_encoding_with_large_dictionaries(spark, most):
    """The same codes whether dictionaries are broadcast or looked up, seen and unseen values alike."""
    cols = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(_encode_rows(), "a string, b string, c string, d string, e int").repartition(5)
    fit = FE.fit_encode(df, cols, most_entries=most)
    assert fit.large == {500_000: [], 100: ["a", "c"], 0: cols}[most]
    new = df.unionByName(spark.createDataFrame([("unseen", "b", None, None, 99), ("hot", "é", "w5", "two", 7)] * 3, df.schema))
    codes = {c: {v: k for k, v in enumerate(sorted({r[c] for r in df.collect() if r[c] is not None}))} for c in cols}
    got = FE.apply_encode(new, fit)
    assert got.columns == cols + [f"{c}_encoded" for c in cols] and got.count() == new.count()
    for r in got.collect():
        assert [r[f"{c}_encoded"] for c in cols] == [codes[c].get(r[c], -1) for c in cols], r
    if most == 100:
        assert "hot" in fit.heavy["a"] and len(fit.heavy["a"]) <= 1000


def test_large_dictionaries_shuffle_the_table_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame(_encode_rows(), "a string, b string, c string, d string, e int").withColumn("wide", F.lit("x" * 50))
        fit = FE.fit_encode(df, ["a", "b", "c", "d"], most_entries=0)
        plan = FE.apply_encode(df.withColumn("wide", F.concat("wide", "c")), fit)._jdf.queryExecution().executedPlan().toString()
        whole = [x for x in plan.splitlines() if "Exchange" in x]
        # exchanges carry the columns of the node below; only one of them carries the table's other columns
        below = plan.splitlines()
        assert sum("wide" in below[k + 1] for k, x in enumerate(below[:-1]) if "Exchange" in x) == 1 <= len(whole)
        # tasks of the shuffle by key: none holds a third of the rows
        sizes = [r["count"] for r in FE.apply_encode(df, fit).groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 3000 / 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distinct_counts_group_columns_by_their_own_type(spark):
    import datetime as dt
    from decimal import Decimal
    nan = float("nan")
    t = dt.datetime(2024, 1, 1, 12)
    rows = [(i % 3, Decimal(i % 4), [0.0, -0.0, nan, 1.5][i % 4], ["a", "b", ""][i % 3], i % 2 == 0, t + dt.timedelta(days=i % 5), [i], None)
            for i in range(20)] + [(None,) * 8]
    df = spark.createDataFrame(rows, "i int, d decimal(20,2), x double, s string, b boolean, t timestamp_ntz, a array<int>, n string")
    got = {r["column"]: (r["n_distinct"], r["ratio"]) for r in TY.distinct_ratio(df).collect()}
    want = {"i": 3, "d": 4, "x": 3, "s": 3, "b": 2, "t": 5, "a": 0, "n": 0}       # a list has no distinct count
    assert got == {c: (n, n / 21) for c, n in want.items()}
    plan = TY.distinct_ratio(df.select("i", "d", "s"))._jdf.queryExecution().toString()
    assert "Generate" not in plan and "inline" not in plan          # no row per cell in long form
    assert TY.distinct_ratio(df.select("a")).collect()[0]["n_distinct"] == 0


def test_only_shapes_that_one_value_has_are_parsed(spark, monkeypatch):
    real, asked = TY.parse_ts, []
    monkeypatch.setattr(TY, "parse_ts", lambda c, fmt: asked.append(fmt) or real(c, fmt))
    rows = [("2024-01-01", "2024/01/01", "x1", None, "2024-01-01"), ("2024-02-30", "2024/02/03", "2024-01-01", None, None)]
    df = spark.createDataFrame(rows, "bad string, d string, s string, n string, h string").coalesce(1)
    fit = TY.fit_types(df)
    assert fit.formats == {"d": "yyyy/MM/dd", "n": "yyyy-MM-dd", "h": "yyyy-MM-dd"} and fit.semantic["bad"] == "text"
    assert len(asked) <= 4 and len(TY.DATETIME_FORMATS) * 5 > 4        # not every format of every text column


def test_cast_reads_times_like_their_pattern(spark):
    texts = ["0000-01-01", "0001-01-01", "2024-02-30", "2024-02-29", "9999-12-31", "2024-13-01", "2024-01-01\n", "2024-01-01 ",
             "2024-03-31 02:30:00", "2024-01-01 24:00:00", "2024-01-01 23:59:60", "2024-01-01T23:59:59", "2024-01-01 23:59:59\n",
             "1850-05-05 10:11:12", "1582-10-10", "٢٠٢٤-01-01", "", None]
    df = spark.createDataFrame([(x,) for x in texts], "s string")
    s = F.col("s")
    for fmt, shape in zip(TY.DATETIME_FORMATS, TY.DATETIME_SHAPES):
        want = F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz"))
        assert df.where(~want.eqNullSafe(TY.parse_ts(s, fmt))).count() == 0
    plan = df.select(TY.parse_ts(s, "yyyy-MM-dd").alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan.lower()


def test_quantile_scans_move_no_cell_that_no_interval_holds(spark, monkeypatch):
    from tableprep.functions import stats
    df = spark.range(0, 4000, 1, 4).select((F.col("id") % 1000).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    seen, real = [], stats._inside
    monkeypatch.setattr(stats, "_inside", lambda d, todo: seen.append(real(d, todo)) or seen[-1])
    assert quantiles(df, ["x", "y"], [0.25, 0.75], max_local=10) == {"x": [249.75, 749.25], "y": [999.75, 2999.25]}
    assert all(d.count() < 4000 for d in seen)
