"""Registered queries for the contract gates (J1-J22), all on ``m_items``.

Output of every gate: ``(rule, column, observed, limit, fired)``; observed is
rounded to 6 places on both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import gates as G
from ..operators import outliers as OU
from ..operators import select as SE
from ..operators import types as TY
from .fixtures import m_items
from .queries_prep import (_FENCE, _NULLS, _PCT, _RATIO, _SEM, ITEM_COLS, ITEM_NUMERIC, ITEM_STRING, _is_out,
                           _with_fences)
from .registry import per_column, query


def _r(df):
    return df.select("rule", "column", F.round("observed", 6).alias("observed"), "limit", "fired")


def _sel(rule, column, observed, limit, fired, src):
    return (f"SELECT '{rule}' AS rule, CAST({column} AS VARCHAR) AS \"column\", round(CAST({observed} AS DOUBLE), 6) "
            f"AS observed, CAST({limit} AS DOUBLE) AS \"limit\", {fired} AS fired FROM {src}")


def _semantic(spark, sf):
    return TY.semantic_types(m_items(spark, sf)).select("column", "semantic")


@query("j1_sparse_share", _sel("J1", "NULL", "o", 0.3, "o > 0.3",
                               f"(SELECT avg(CASE WHEN null_pct > 50 THEN 1.0 ELSE 0.0 END) AS o FROM ({_PCT}))"),
       ("m_items",))
def j1(spark, sf):
    return _r(G.j1_sparse_share(m_items(spark, sf)))


@query("j2_dedup_rows", _sel("J2", "NULL", "o", 50, "o < 50",
                             "(SELECT count(*) AS o FROM (SELECT DISTINCT * FROM m_items))"), ("m_items",))
def j2(spark, sf):
    return _r(G.j2_rows_after_dedup(m_items(spark, sf)))


_ZV = per_column("SELECT CASE WHEN min({c}) IS NOT DISTINCT FROM max({c}) THEN 1.0 ELSE 0.0 END AS z FROM m_items",
                 ITEM_NUMERIC)


@query("j3_all_zero_var", _sel("J3", "NULL", "o", 1.0, "coalesce(o = 1.0, false)", f"(SELECT avg(z) AS o FROM ({_ZV}))"),
       ("m_items",))
def j3(spark, sf):
    return _r(G.j3_all_zero_variance(m_items(spark, sf)))


@query("j4_not_good", _sel("J4", "NULL", "o", 40.0, "o > 40", f"(SELECT max(null_pct) AS o FROM ({_PCT}))"),
       ("m_items",))
def j4(spark, sf):
    return _r(G.j4_not_good(m_items(spark, sf)))


_TOP = per_column(
    "SELECT '{c}' AS c, max(n) / sum(n) AS o FROM (SELECT count(*) AS n FROM m_items WHERE {c} IS NOT NULL GROUP BY {c})",
    ITEM_COLS)


@query("j5_near_constant", _sel("J5", "c", "o", 0.95, "o > 0.95", f"({_TOP})"), ("m_items",))
def j5(spark, sf):
    return _r(G.j5_near_constant(m_items(spark, sf)))


@query("j6_untyped", _sel("J6", "NULL", "o", 0.5, "o > 0.5",
                          f"(SELECT avg(CASE WHEN semantic = 'unknown' THEN 1.0 ELSE 0.0 END) AS o FROM ({_SEM}))"),
       ("m_items",))
def j6(spark, sf):
    return _r(G.j6_untyped_share(_semantic(spark, sf)))


_J7 = per_column("SELECT '{c}' AS c, count_if(regexp_matches({c}, '(N/A|[$%])')) / count({c}) AS o FROM m_items",
                 ITEM_STRING)
# text forms of two numeric columns and one that only looks numeric in part
_TYPED = ["qty_text", "part_text", "mixed"]
_TYPED_SQL = ("(SELECT CAST(qty AS VARCHAR) AS qty_text, CAST(part_id AS VARCHAR) AS part_text, "
              "CASE WHEN part_id % 3 = 0 THEN item_id ELSE CAST(part_id AS VARCHAR) END AS mixed, item_id FROM m_items)")
_J8 = per_column("SELECT '{c}' AS c, count_if(TRY_CAST({c} AS DOUBLE) IS NULL AND {c} IS NOT NULL) / count({c}) AS o "
                 f"FROM {_TYPED_SQL}", _TYPED)


@query("j7_dirty_tokens", _sel("J7", "c", "o", 0.1, "coalesce(o > 0.1, false)", f"({_J7})"), ("m_items",))
def j7(spark, sf):
    return _r(G.j7_dirty_numeric_tokens(m_items(spark, sf)))


@query("j8_non_numeric", _sel("J8", "c", "o", 0.2, "coalesce(o > 0.2, false)", f"({_J8})"), ("m_items",))
def j8(spark, sf):
    text = m_items(spark, sf).select(
        F.col("qty").cast("string").alias("qty_text"), F.col("part_id").cast("string").alias("part_text"),
        F.when(F.col("part_id") % 3 == 0, F.col("item_id")).otherwise(F.col("part_id").cast("string")).alias("mixed"), "item_id")
    return _r(G.j8_non_numeric_strings(text, _TYPED))


_NN = per_column("SELECT '{c}' AS \"column\", count({c}) AS non_null FROM m_items", ITEM_COLS)


# the item types with one wrong entry each way, so that both ratio rules fire
_TYPES9 = (f"(SELECT \"column\", CASE \"column\" WHEN 'status_code' THEN 'text' ELSE semantic END AS semantic FROM ({_SEM}))")
_J9_SRC = (f"({_RATIO}) r JOIN {_TYPES9} s ON r.\"column\" = s.\"column\" JOIN ({_NN}) n ON r.\"column\" = n.\"column\"")


@query("j9_type_rules",
       _sel("J9.id", "r.\"column\"", "r.ratio", 0.95, "r.ratio > 0.95 AND s.semantic <> 'id'", _J9_SRC) + "\nUNION ALL\n"
       + _sel("J9.categorical", "r.\"column\"", "r.ratio", 0.05,
              "r.ratio < 0.05 AND s.semantic NOT IN ('categorical', 'datetime', 'unknown')", _J9_SRC) + "\nUNION ALL\n"
       + _sel("J9.datetime", "r.\"column\"", "n.non_null", 10, "s.semantic = 'datetime' AND n.non_null < 10", _J9_SRC),
       ("m_items",))
def j9(spark, sf):
    df = m_items(spark, sf)
    ratios = TY.distinct_ratio(df).select("column", F.round("ratio", 6).alias("ratio"))
    nn = G.column_profile(df).select("column", (F.col("rows") - F.col("null_count")).alias("non_null"))
    types = _semantic(spark, sf).withColumn(
        "semantic", F.when(F.col("column") == "status_code", "text").otherwise(F.col("semantic")))
    return _r(G.j9_type_thresholds(ratios, types, nn))


# plan over every column: default rule, overridden for price and qty (J10, J21)
_OVERRIDES = {"price": "mean", "qty": "mean"}
_PLAN_ALL = (f"(SELECT \"column\", semantic, CASE \"column\" "
             + " ".join(f"WHEN '{c}' THEN '{s}'" for c, s in _OVERRIDES.items())
             + f" ELSE CASE WHEN semantic = 'numeric' THEN 'median' ELSE 'mode' END END AS strategy FROM ({_SEM}))")


def _plan_all(spark, sf):
    s = _semantic(spark, sf)
    strategy = F.when(F.col("semantic") == "numeric", "median").otherwise("mode")
    for c, v in _OVERRIDES.items():
        strategy = F.when(F.col("column") == c, v).otherwise(strategy)
    return s.select("column", "semantic", strategy.alias("strategy"))


@query("j10_mean_misuse", _sel("J10", "\"column\"", "CASE WHEN strategy = 'mean' THEN 1.0 ELSE 0.0 END", 1.0,
                               "strategy = 'mean' AND (semantic IN ('id', 'text') OR "
                               "regexp_matches(lower(\"column\"), 'fraud|churn|default'))", _PLAN_ALL), ("m_items",))
def j10(spark, sf):
    return _r(G.j10_mean_misuse(_plan_all(spark, sf)))


_J11 = "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS c, 'numeric' AS fam, (count(*) - count({c})) / count(*) * 100 AS p, skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1)) AS sk "
     f"FROM m_items" for c in ITEM_NUMERIC]
    + [f"SELECT '{c}', 'string', (count(*) - count({c})) / count(*) * 100, NULL FROM m_items" for c in ITEM_STRING])


@query("j11_missing_advice",
       _sel("J11.drop", "c", "p", 70.0, "p > 70", f"({_J11})") + "\nUNION ALL\n"
       + _sel("J11.knn", "c", "p", 20.0, "fam = 'numeric' AND p >= 20 AND p <= 70", f"({_J11})") + "\nUNION ALL\n"
       + _sel("J11.median", "c", "coalesce(abs(sk), 0)", 1.0, "coalesce(abs(sk), 0) > 1 AND p > 0", f"({_J11})"), ("m_items",))
def j11(spark, sf):
    return _r(G.j11_missing_advice(m_items(spark, sf)))


@query("j12_synthetic", _sel("J12", "\"column\"", "null_count / n_rows", 0.3,
                             "null_count / n_rows > 0.3 OR contains(lower(\"column\"), 'target')",
                             f"({_NULLS}) WHERE null_count > 0"), ("m_items",))
def j12(spark, sf):
    return _r(G.j12_synthetic_share(m_items(spark, sf), "target"))


_OUT_PCT = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS c, round_even(count_if({_is_out(c)}) / count(*) * 100, 2) AS pct FROM m_items"
    for c in ITEM_NUMERIC)


# planned actions: order_id and price are to be dropped, qty is kept as a signal, all others clipped
_ACTIONS = {"order_id": "drop", "price": "drop", "qty": "keep_as_signal"}
_J13_SRC = (f"(SELECT c, pct, CASE c " + " ".join(f"WHEN '{c}' THEN '{a}'" for c, a in _ACTIONS.items())
            + f" ELSE 'clip' END AS act FROM (SELECT CASE c WHEN 'mystery' THEN 'anomaly_tax' ELSE c END AS c, pct FROM ({_OUT_PCT})))")


@query("j13_outlier_policy", _with_fences(
    _sel("J13.drop", "c", "pct", 5.0, "act = 'drop' AND pct > 5", _J13_SRC) + "\nUNION ALL\n"
    + _sel("J13.clip", "c", "pct", 0.0, "act = 'clip' AND regexp_matches(lower(c), 'fraud|anomaly')", _J13_SRC)
    + "\nUNION ALL\n" + _sel("J13.target", "c", "pct", 0.0, "act IN ('drop', 'clip') AND c = 'target'", _J13_SRC)),
    ("m_items",))
def j13(spark, sf):
    df = m_items(spark, sf).withColumnRenamed("mystery", "anomaly_tax")
    return _r(G.j13_outlier_policy(OU.outlier_report(df, OU.fit_outliers(df)), "target", _ACTIONS))


_ANY = " OR ".join(_is_out(c) for c in ITEM_NUMERIC)


@query("j14_outlier_backtrack", _with_fences(
    _sel("J14", "NULL", "o", 0.2, "o > 0.2", f"(SELECT count_if({_ANY}) / count(*) AS o FROM m_items)")
    + "\nUNION ALL\n" + _sel("J14", "\"column\"", "q3 - q1", 0.0, "q3 - q1 = 0", f"({_FENCE})")), ("m_items",))
def j14(spark, sf):
    df = m_items(spark, sf)
    fit = OU.fit_outliers(df)
    fences = spark.createDataFrame([(c, f.q1, f.q3) for c, f in fit.fences.items()], "column string, q1 double, q3 double")
    return _r(G.j14_outlier_backtrack(OU.total_outlier_rows(df, fit), fences))


_MINS = per_column("SELECT '{c}' AS c, CAST(min({c}) AS DOUBLE) AS vmin FROM m_items", ITEM_NUMERIC)
_NDIST = per_column("SELECT '{c}' AS c, count(DISTINCT {c}) AS nd FROM m_items", ITEM_COLS)


_J15_SRC = f"({_SEM}) s JOIN ({_NDIST}) d ON s.\"column\" = d.c LEFT JOIN ({_MINS}) m ON s.\"column\" = m.c"


@query("j15_feature_bans",
       _sel("J15.one_hot", "s.\"column\"", "d.nd", 50, "d.nd > 50", _J15_SRC) + "\nUNION ALL\n"
       + _sel("J15.log", "s.\"column\"", "m.vmin", 0.0, "coalesce(m.vmin <= 0, false)", _J15_SRC) + "\nUNION ALL\n"
       + _sel("J15.polynomial", "s.\"column\"", "CASE WHEN s.semantic IN ('id', 'text') THEN 1.0 ELSE 0.0 END", 0.0,
              "s.semantic IN ('id', 'text')", _J15_SRC), ("m_items",))
def j15(spark, sf):
    df = m_items(spark, sf)
    return _r(G.j15_feature_bans(df, _semantic(spark, sf)))


_ENC_OLD = ["order_id", "part_id", "target"]


def _codes(c):
    return (f"(SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM "
            f"(SELECT DISTINCT {c} AS v FROM m_items WHERE {c} IS NOT NULL))")


_J16_SRC = (f"(SELECT *, coalesce(a.code, -1) AS flag_encoded, coalesce(b.code, -1) AS status_code_encoded "
            f"FROM m_items LEFT JOIN {_codes('flag')} a ON flag = a.v LEFT JOIN {_codes('status_code')} b "
            f"ON status_code = b.v)")
_J16 = "\nUNION ALL\n".join(
    f"SELECT '{a}={b}' AS c, count_if(CAST({a} AS DOUBLE) IS DISTINCT FROM CAST({b} AS DOUBLE)) AS o FROM {_J16_SRC}"
    for a in ("flag_encoded", "status_code_encoded") for b in _ENC_OLD)
# copies, a text beside another text, and longs that only differ beyond the digits of a double
_J16_MORE = ("(SELECT qty, part_id, item_id, flag, status_code, part_id AS part_copy, item_id AS item_copy, "
             "9007199254740992 + part_id % 2 AS large, CAST(9007199254740992 AS BIGINT) AS even, "
             "CASE WHEN qty > 10 THEN ln(qty - 10) END AS log_qty FROM m_items)")
_J16_PAIRS = [(a, b) for a in ("part_copy", "item_copy", "large", "flag") for b in ("part_id", "item_id", "even", "status_code")]
_J16_TYPED = "\nUNION ALL\n".join(
    f"SELECT '{a}={b}' AS c, count_if(CAST({a} AS VARCHAR) IS DISTINCT FROM CAST({b} AS VARCHAR)) AS o FROM {_J16_MORE}"
    for a, b in _J16_PAIRS)


@query("j16_identical", _sel("J16.identical", "c", "CASE WHEN o = 0 THEN o END", 0.0, "o = 0", f"({_J16}\nUNION ALL\n{_J16_TYPED})")
       + "\nUNION ALL\n" + _sel("J16.nulls", "'log_qty<-qty'", "o", 0.0, "o > 0",
                                f"(SELECT count_if(log_qty IS NULL AND qty IS NOT NULL) AS o FROM {_J16_MORE})"), ("m_items",))
def j16(spark, sf):
    df = m_items(spark, sf)
    enc = FE.apply_encode(df, FE.fit_encode(df, ["flag", "status_code"]))
    # a transform that is undefined for quantities up to 10, plain copies, and longs beyond a double's digits
    more = df.select("qty", "part_id", "item_id", "flag", "status_code", F.col("part_id").alias("part_copy"),
                     F.col("item_id").alias("item_copy"), (F.lit(1 << 53) + F.col("part_id") % 2).alias("large"),
                     F.lit(1 << 53).alias("even"), F.when(F.col("qty") > 10, F.ln(F.col("qty") - 10)).alias("log_qty"))
    return _r(G.j16_identical_columns(enc, ["flag_encoded", "status_code_encoded"], _ENC_OLD).unionByName(
        G.j16_identical_columns(more, ["part_copy", "item_copy", "large", "flag"], ["part_id", "item_id", "even", "status_code"],
                                {"log_qty": "qty"})))


_LOWVAR = per_column("SELECT '{c}' AS c FROM m_items HAVING coalesce(var_samp({c}) < 0.01, false)",
                     [c for c in ITEM_NUMERIC if c != "target"])


_J17_SRC = (f"({_SEM}) s LEFT JOIN (SELECT c, 'low variance' AS why FROM ({_LOWVAR}) UNION ALL "
            f"SELECT 'flag', 'high correlation') r ON s.\"column\" = r.c")
_RM = "CASE WHEN r.c IS NULL THEN 0.0 ELSE 1.0 END"


@query("j17_selection_rules",
       _sel("J17.id", "s.\"column\"", _RM, 0.0, "s.semantic = 'id' AND r.c IS NULL", _J17_SRC) + "\nUNION ALL\n"
       + _sel("J17.target", "s.\"column\"", _RM, 0.0, "s.\"column\" = 'target' AND r.c IS NOT NULL", _J17_SRC) + "\nUNION ALL\n"
       + _sel("J17.categorical", "s.\"column\"", _RM, 0.0,
              "s.semantic = 'categorical' AND coalesce(r.why = 'high correlation', false)", _J17_SRC), ("m_items",))
def j17(spark, sf):
    df = m_items(spark, sf)
    fit = SE.fit_select(df, "target")
    # one categorical column is reported as removed by the correlation filter, which no plan may do
    removed = spark.createDataFrame([(c, "low variance") for c in fit.low_variance]
                                    + [(c, "high correlation") for c in fit.high_correlation + ["flag"]],
                                    "column string, reason string")
    return _r(G.j17_selection_rules(_semantic(spark, sf), removed, "target"))


_TCORR = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS c, CASE WHEN isnan(r) THEN NULL ELSE r END AS r FROM "
    f"(SELECT corr(CAST({c} AS DOUBLE), CAST(target AS DOUBLE)) AS r FROM m_items)"
    for c in ITEM_NUMERIC if c != "target")
_KEPT = f"(SELECT {len(ITEM_COLS) - 1} - (SELECT count(*) FROM ({_LOWVAR})) AS kept)"


@query("j18_selection_backtrack",
       _sel("J18", "NULL", "kept", 3, "kept < 3", _KEPT) + "\nUNION ALL\n"
       + _sel("J18", "c", "abs(r)", 0.9, "coalesce(abs(r) > 0.9, false)", f"({_TCORR})"), ("m_items",))
def j18(spark, sf):
    df = m_items(spark, sf)
    fit = SE.fit_select(df, "target")
    kept = df.agg(F.lit(float(len(fit.kept))).alias("kept"))
    cols = [c for c in ITEM_NUMERIC if c != "target"]
    tc = SE.correlation_table(df.select(*cols, "target"), cols + ["target"]).where(F.col("b") == "target") \
        .select(F.col("a").alias("column"), "r")
    return _r(G.j18_selection_backtrack(kept, tc))


_AFTER = "(SELECT * FROM m_items WHERE NOT (" + _ANY + "))"
_J19 = (_sel("J19", "NULL", "1.0 - a / b", 0.4, "1.0 - a / b > 0.4",
             f"(SELECT (SELECT count(*) FROM m_items) AS b, (SELECT count(*) FROM {_AFTER}) AS a)")
        + "\nUNION ALL\n" + _sel("J19", "'target'", "CASE WHEN n = 1 THEN 0 ELSE 1 END", 0.0, "n <> 1",
                                 "(SELECT count(*) AS n FROM (DESCRIBE SELECT * FROM m_items) WHERE column_name = 'target')")
        + "\nUNION ALL\n" + "\nUNION ALL\n".join(
            _sel("J19", f"'{c}'", "n", 0.0, "n > 0", f"(SELECT count(*) - count({c}) AS n FROM {_AFTER})")
            for c in ITEM_NUMERIC))


@query("j19_validation", _with_fences(_J19), ("m_items",))
def j19(spark, sf):
    df = m_items(spark, sf)
    after = OU.drop_rows(df, OU.fit_outliers(df))
    return _r(G.j19_validation(df, after, "target"))


_NULLSUM = " + ".join(f"(count(*) - count({c}))" for c in ITEM_COLS)
_FULL_ROWS = "(SELECT * FROM m_items WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in ITEM_COLS) + ")"


def _j20_case(rows, columns):
    """One routing: the rows left and how many columns there are for each of the table's twelve."""
    return _sel("J20", f"CASE WHEN n > 0 THEN 'missing' WHEN {columns} > 3 * {len(ITEM_COLS)} THEN 'features' WHEN loss > 0.4 THEN 'outliers' END",
                "loss", 0.4, f"n > 0 OR {columns} > 3 * {len(ITEM_COLS)} OR loss > 0.4",
                f"(SELECT ((SELECT count(*) FROM m_items) - count(*)) / (SELECT count(*) FROM m_items) AS loss, {_NULLSUM} AS n FROM {rows})")


@query("j20_routing", _with_fences("\nUNION ALL\n".join([
    _j20_case(_AFTER, len(ITEM_COLS)), _j20_case(_FULL_ROWS, 4 * len(ITEM_COLS)), _j20_case(_FULL_ROWS, len(ITEM_COLS)),
    _j20_case("(SELECT * REPLACE (coalesce(qty, 0) AS qty, coalesce(discount, 0) AS discount, coalesce(mystery, 0) AS mystery, "
              "coalesce(flag, '') AS flag) FROM m_items)", len(ITEM_COLS))])), ("m_items",))
def j20(spark, sf):
    """Rows with holes, a wide table, a table that lost most rows, and one that needs nothing."""
    df = m_items(spark, sf)
    after = OU.drop_rows(df, OU.fit_outliers(df))
    full = df.na.drop()
    wide = full.select("*", *[F.col(c).alias(f"{c}_{k}") for k in range(3) for c in df.columns])
    filled = df.na.fill(0.0, ["qty", "discount", "mystery"]).na.fill("", ["flag"])
    cases = [G.j20_routing(df, x) for x in (after, wide, full, filled)]
    return _r(reduce(lambda a, b: a.unionByName(b), cases))


@query("j21_mode_on_text", _sel("J21", "\"column\"", "CASE WHEN strategy = 'mode' AND semantic = 'text' THEN 1.0 "
                                "ELSE 0.0 END", 0.0, "strategy = 'mode' AND semantic = 'text'", _PLAN_ALL),
       ("m_items",))
def j21(spark, sf):
    return _r(G.j21_mode_on_text(_plan_all(spark, sf)))


@query("j22_feature_counts", _sel(
    "J22", "\"column\"", "k", 5.0, "CASE WHEN semantic = 'datetime' THEN k <> 5 ELSE k > 3 END",
    f"(SELECT \"column\", semantic, CASE semantic WHEN 'datetime' THEN 5 WHEN 'categorical' THEN 1 ELSE 0 END AS k "
    f"FROM ({_SEM}))"), ("m_items",))
def j22(spark, sf):
    df = m_items(spark, sf)
    fit = TY.fit_types(df)
    _, done = FE.engineer(TY.apply_types(df, fit), fit.semantic)
    lines = spark.createDataFrame([(c, d.count) for d in done for c in d.sources], "source string, n_features int")
    return _r(G.j22_feature_counts(lines, _semantic(spark, sf)))
