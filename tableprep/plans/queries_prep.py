"""Registered queries for the preparation stages (A, B, C, D, E, F, G, H, I).

All run on ``m_items`` (whole ``lineitem`` table plus derived mess) unless a
name says otherwise.  Oracle SQL is written independently for DuckDB.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..operators import profile as P
from ..session import ensure_checkpoint_dir
from ..sources.store import RunStore
from .fixtures import m_items
from .registry import per_column, query

ITEM_COLS = ["order_id", "part_id", "qty", "price", "discount", "mystery", "flag",
             "status_code", "ship_date", "item_id", "constant_col", "target"]
ITEM_NUMERIC = ["order_id", "part_id", "qty", "price", "discount", "mystery", "constant_col", "target"]
ITEM_STRING = ["flag", "status_code", "ship_date", "item_id"]

# ---------------------------------------------------------------- B: audit

_NULLS = per_column(
    "SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
    "count(*) AS n_rows FROM m_items", ITEM_COLS)
_PCT = ("SELECT \"column\", null_count, "
        "round_even(CAST(null_count AS DOUBLE) / n_rows * 100, 2) AS null_pct FROM ({n})").format(n=_NULLS)


@query("b1_nulls", f"SELECT \"column\", null_count FROM ({_NULLS})", ("m_items",))
def b1_nulls(spark, sf):
    return P.null_counts(m_items(spark, sf))


@query("b2_nullpct", f"SELECT \"column\", null_pct FROM ({_PCT})", ("m_items",))
def b2_nullpct(spark, sf):
    return P.null_percent(m_items(spark, sf))


_DUPS = ("SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
         "(SELECT count(*) AS n FROM m_items GROUP BY ALL_COLS)").replace("ALL_COLS", ", ".join(ITEM_COLS))


@query("b3_dups", _DUPS, ("m_items",))
def b3_dups(spark, sf):
    return P.duplicate_rows(m_items(spark, sf))


_ZERO = per_column(
    "SELECT '{c}' AS \"column\" FROM m_items HAVING min({c}) IS NOT DISTINCT FROM max({c})", ITEM_NUMERIC)


@query("b4_zero_var", _ZERO, ("m_items",))
def b4_zero_var(spark, sf):
    return P.zero_variance(m_items(spark, sf))


_FLAGS = f"""
SELECT 'HIGH NULLS' AS kind, "column", null_pct AS value FROM ({_PCT}) WHERE null_pct > 50
UNION ALL
SELECT 'DUPLICATES', NULL, CAST(duplicate_rows AS DOUBLE) FROM ({_DUPS}) WHERE duplicate_rows > 0
UNION ALL
SELECT 'ZERO VARIANCE', "column", CAST(NULL AS DOUBLE) FROM ({_ZERO})
"""


@query("b5_flags", _FLAGS, ("m_items",))
def b5_flags(spark, sf):
    return P.quality_flags(m_items(spark, sf)).select("kind", "column", "value")


_RATING = f"""
SELECT n_flags, CASE WHEN n_flags > 3 THEN 'POOR' WHEN n_flags > 0 THEN 'FAIR' ELSE 'GOOD' END AS overall_quality
FROM (SELECT count(*) AS n_flags FROM ({_FLAGS}))
"""


@query("b6_rating", _RATING, ("m_items",))
def b6_rating(spark, sf):
    return P.overall_rating(m_items(spark, sf))


_SAMPLE_NUM = per_column(
    "SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS num FROM (SELECT DISTINCT {c} FROM m_items WHERE {c} IS NOT NULL)",
    ITEM_NUMERIC)
_SAMPLE_STR = per_column(
    "SELECT '{c}' AS \"column\", {c} AS s FROM (SELECT DISTINCT {c} FROM m_items WHERE {c} IS NOT NULL)",
    ITEM_STRING)
_SAMPLE = f"""
SELECT "column", CAST(rank AS INTEGER) AS rank, CAST(num AS VARCHAR) AS value FROM (
  SELECT "column", num, row_number() OVER (PARTITION BY "column" ORDER BY num) AS rank FROM ({_SAMPLE_NUM}))
WHERE rank <= 5
UNION ALL
SELECT "column", CAST(rank AS INTEGER), s FROM (
  SELECT "column", s, row_number() OVER (PARTITION BY "column" ORDER BY s) AS rank FROM ({_SAMPLE_STR}))
WHERE rank <= 5
"""


@query("b7_sample", _SAMPLE, ("m_items",))
def b7_sample(spark, sf):
    return P.sample_values(m_items(spark, sf), 5)


_SUMMARY = per_column(
    "SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    "CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM m_items", ITEM_NUMERIC)


@query("b8_summary", _SUMMARY, ("m_items",))
def b8_summary(spark, sf):
    s = P.numeric_summary(m_items(spark, sf))
    return s.select("column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min", "max")


_DTYPES = per_column(
    "SELECT '{c}' AS \"column\", CASE lower(max(typeof({c}))) WHEN 'varchar' THEN 'string' ELSE lower(max(typeof({c}))) END "
    "AS dtype, count({c}) AS non_null FROM m_items", ITEM_COLS)


@query("b9_dtypes", _DTYPES, ("m_items",))
def b9_dtypes(spark, sf):
    """Type of every column and how many values of it the table holds."""
    df = m_items(spark, sf)
    held = P.column_profile(df).select("column", (F.col("rows") - F.col("null_count")).alias("non_null"))
    return P.dtype_map(df).join(held, "column")


_BAND = f"""
SELECT "column", null_pct,
       CASE WHEN null_pct > 50 THEN 'high' WHEN null_pct > 10 THEN 'med' ELSE 'low' END AS band
FROM ({_PCT}) WHERE null_pct > 0
"""


@query("b10_band", _BAND, ("m_items",))
def b10_band(spark, sf):
    return P.missing_band(m_items(spark, sf))


# ---------------------------------------------------------------- A: intake, ledger

@query("a4_intake", "SELECT count(*) AS \"rows\", 12 AS \"columns\", '" + ",".join(ITEM_COLS)
       + "' AS column_names FROM m_items", ("m_items",))
def a4_intake(spark, sf):
    from ..sources.ingest import intake_profile
    return intake_profile(m_items(spark, sf)).select("rows", F.col("columns").cast("int"), "column_names")


# ---------------------------------------------------------------- C: types

from ..operators import types as TY  # noqa: E402

_RATIO = per_column(
    "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, "
    "round(count(DISTINCT {c}) / greatest(count(*), 1), 6) AS ratio FROM m_items", ITEM_COLS)


@query("c1_ratio", _RATIO, ("m_items",))
def c1_ratio(spark, sf):
    r = TY.distinct_ratio(m_items(spark, sf))
    return r.select("column", "n_distinct", F.round("ratio", 6).alias("ratio"))


# DuckDB spellings of the fixed datetime formats and their shapes
_DUCK_FORMATS = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d", "%m/%d/%Y", "%d.%m.%Y"]
_DUCK_SHAPES = [r"^\d{4}-\d{2}-\d{2}$", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
                r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", r"^\d{4}/\d{2}/\d{2}$",
                r"^\d{2}/\d{2}/\d{4}$", r"^\d{2}\.\d{2}\.\d{4}$"]


def _duck_dt_any(c):
    parts = [f"count({c}) = count(CASE WHEN regexp_matches({c}, '{s}') THEN try_strptime({c}, '{f}') END)"
             for f, s in zip(_DUCK_FORMATS, _DUCK_SHAPES)]
    return " OR ".join(parts)


_SEM = (per_column("SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) / greatest(count(*), 1) > 0.95 "
                   "THEN 'id' ELSE 'numeric' END AS semantic FROM m_items", ITEM_NUMERIC)
        + "\nUNION ALL\n"
        + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", CASE WHEN {_duck_dt_any(c)} THEN 'datetime' "
            f"WHEN count(DISTINCT {c}) / greatest(count(*), 1) < 0.05 THEN 'categorical' ELSE 'text' END "
            f"FROM m_items" for c in ITEM_STRING))


@query("c2_c5_semantic", f"SELECT \"column\", semantic FROM ({_SEM})", ("m_items",))
def c2_c5_semantic(spark, sf):
    return TY.semantic_types(m_items(spark, sf)).select("column", "semantic")


@query("c6_cast", "SELECT item_id, CAST(strptime(ship_date, '%Y-%m-%d') AS TIMESTAMP) AS ship_date FROM m_items",
       ("m_items",))
def c6_cast(spark, sf):
    df = m_items(spark, sf)
    return TY.apply_types(df, TY.fit_types(df)).select("item_id", "ship_date")


def _duck_dictionary(c):
    return (f"SELECT '{c}' AS \"column\", v AS value, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
            f"FROM (SELECT DISTINCT {c} AS v FROM m_items WHERE {c} IS NOT NULL)")


@query("c7_categories", " UNION ALL ".join(f"({_duck_dictionary(c)})" for c in ("flag", "status_code")), ("m_items",))
def c7_categories(spark, sf):
    """Ordered categories of the categorical columns."""
    from ..operators.features import dictionary
    df = m_items(spark, sf)
    return dictionary(df, TY.fit_types(df).columns_of("categorical"))


@query("a5_snapshot", """
SELECT order_id, part_id, qty, CAST(strptime(ship_date, '%Y-%m-%d') AS TIMESTAMP) AS ship_date, 'types' AS label FROM m_items
UNION ALL SELECT order_id, part_id, qty, NULL, 'intake' FROM m_items""", ("m_items",))
def a5_snapshot(spark, sf):
    """Two snapshots of one run, both read back."""
    df = m_items(spark, sf)
    store = RunStore(spark, os.path.join(ensure_checkpoint_dir(spark), f"store-{uuid.uuid4().hex}"))
    one = store.save_snapshot(df, "r", "intake")
    store.save_snapshot(TY.apply_types(one, TY.fit_types(one)), "r", "types")
    last, first = store.load_snapshot("r"), store.load_snapshot("r", "intake")
    return last.select("order_id", "part_id", "qty", "ship_date", F.lit("types").alias("label")).unionByName(
        first.select("order_id", "part_id", "qty", F.lit(None).cast("timestamp_ntz").alias("ship_date"),
                     F.lit("intake").alias("label")))


@query("c8_coerce", "SELECT TRY_CAST(CAST(qty AS VARCHAR) AS DOUBLE) AS qty_text, TRY_CAST(item_id AS DOUBLE) AS item_id "
       "FROM m_items", ("m_items",))
def c8_coerce(spark, sf):
    df = m_items(spark, sf).select(F.col("qty").cast("string").alias("qty_text"), "item_id")
    return TY.coerce_numeric(df, ["qty_text", "item_id"])


_TYPEMAP = f"""
SELECT "column", semantic,
       CASE WHEN semantic = 'datetime' AND "column" IN ({", ".join(f"'{c}'" for c in ITEM_STRING)})
            THEN 'datetime'
            WHEN semantic = 'categorical' THEN 'category' END AS cast_log
FROM ({_SEM})
"""


@query("c9_typemap", _TYPEMAP, ("m_items",))
def c9_typemap(spark, sf):
    df = m_items(spark, sf)
    fit = TY.fit_types(df)
    logs = dict(TY.cast_log(fit))
    return spark.createDataFrame([(c, fit.semantic[c], logs.get(c)) for c in df.columns],
                                 "column string, semantic string, cast_log string")


_CARDS = f"""
SELECT s."column", s.semantic, coalesce(p.null_pct, 0.0) AS null_pct
FROM ({_SEM}) s LEFT JOIN ({_PCT}) p ON s."column" = p."column"
"""


@query("b11_cards", _CARDS, ("m_items",))
def b11_cards(spark, sf):
    df = m_items(spark, sf)
    types = TY.semantic_types(df)
    return P.column_cards(types, df)


# ---------------------------------------------------------------- D: missing values

from ..operators import impute as IM  # noqa: E402

_FRAC = per_column(
    "SELECT '{c}' AS \"column\", (count(*) - count({c})) / count(*) AS frac FROM m_items", ITEM_COLS)
_ACTION = ("CASE WHEN frac = 0 THEN 'no_action' WHEN frac >= 0.7 THEN 'drop' ELSE 'impute' END")


@query("d1_nullfrac", f"SELECT \"column\", round(frac, 6) AS null_fraction, {_ACTION} AS action FROM ({_FRAC})",
       ("m_items",))
def d1_nullfrac(spark, sf):
    fr = IM.null_fractions(m_items(spark, sf))
    f = F.col("null_fraction")
    return fr.select("column", F.round(f, 6).alias("null_fraction"),
                     F.when(f == 0, "no_action").when(f >= IM.DROP_THRESHOLD, "drop").otherwise("impute").alias("action"))


@query("d2_drop", f"SELECT \"column\" FROM ({_FRAC}) WHERE frac >= 0.7", ("m_items",))
def d2_drop(spark, sf):
    df = m_items(spark, sf)
    fr = {r["column"]: r["null_fraction"] for r in IM.null_fractions(df).collect()}
    return spark.createDataFrame([(c,) for c, a in IM.plan_actions(fr, {}).items() if a == "drop"], "column string")


_PLAN = f"""
SELECT f."column",
       CASE WHEN frac = 0 THEN 'no_action' WHEN frac >= 0.7 THEN 'drop'
            WHEN s.semantic = 'numeric' THEN 'median' ELSE 'mode' END AS strategy
FROM ({_FRAC}) f JOIN ({_SEM}) s ON f."column" = s."column"
"""


@query("d3_plan", _PLAN, ("m_items",))
def d3_plan(spark, sf):
    df = m_items(spark, sf)
    types = TY.fit_types(df)
    acts = IM.plan_actions(types.null_fractions, types.semantic)
    return spark.createDataFrame(list(acts.items()), "column string, strategy string")


def _filled_items(spark, sf, overrides, constant=0):
    df = m_items(spark, sf)
    types = TY.fit_types(df)       # its pass also yields the NULL shares
    fit = IM.fit_impute(df, types.semantic, overrides=overrides, constant=constant,
                        fractions=types.null_fractions)
    return IM.apply_impute(df, fit)


@query("d4_mean", """
SELECT order_id, part_id, round(coalesce(qty, avg(qty) OVER ()), 6) AS qty,
       round(coalesce(discount, avg(discount) OVER ()), 6) AS discount
FROM m_items""", ("m_items",))
def d4_mean(spark, sf):
    out = _filled_items(spark, sf, {"qty": "mean", "discount": "mean"})
    return out.select("order_id", "part_id", F.round("qty", 6).alias("qty"), F.round("discount", 6).alias("discount"))


@query("d5_median", """
SELECT order_id, part_id, coalesce(qty, (SELECT quantile_cont(qty, 0.5) FROM m_items)) AS qty,
       round(coalesce(discount, (SELECT quantile_cont(discount, 0.5) FROM m_items)), 6) AS discount FROM m_items""",
       ("m_items",))
def d5_median(spark, sf):
    out = _filled_items(spark, sf, {})
    return out.select("order_id", "part_id", "qty", F.round("discount", 6).alias("discount"))


def _duck_mode(c):
    return f"(SELECT {c} FROM m_items WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("d6_mode", f"""
SELECT order_id, part_id, coalesce(qty, {_duck_mode('qty')}) AS qty,
       coalesce(discount, {_duck_mode('discount')}) AS discount,
       coalesce(flag, {_duck_mode('flag')}) AS flag FROM m_items""", ("m_items",))
def d6_mode(spark, sf):
    out = _filled_items(spark, sf, {"qty": "mode", "discount": "mode", "flag": "mode"})
    return out.select("order_id", "part_id", "qty", "discount", "flag")


@query("d7_const", """
SELECT order_id, part_id, coalesce(qty, 0.0) AS qty, coalesce(discount, 0.0) AS discount,
       coalesce(flag, '0') AS flag FROM m_items""", ("m_items",))
def d7_const(spark, sf):
    out = _filled_items(spark, sf, {"qty": "constant", "discount": "constant", "flag": "constant"})
    return out.select("order_id", "part_id", "qty", "discount", "flag")


@query("d8_override", """
SELECT order_id, part_id, round(coalesce(qty, avg(qty) OVER ()), 6) AS qty, price,
       coalesce(flag, '0') AS flag, status_code, ship_date, item_id, constant_col, target FROM m_items""",
       ("m_items",))
def d8_override(spark, sf):
    out = _filled_items(spark, sf, {"qty": "mean", "discount": "drop", "flag": "constant"})
    return out.withColumn("qty", F.round("qty", 6))


_LOG = f"""
SELECT f."column",
       CASE WHEN frac = 0 THEN 'no_action (no nulls)'
            WHEN frac >= 0.7 THEN 'dropped (' || printf('%.0f', frac * 100) || '% missing)'
            ELSE 'applied: ' || CASE WHEN s.semantic = 'numeric' THEN 'median' ELSE 'mode' END
                 || ' (was ' || printf('%.0f', frac * 100) || '% null)' END AS log
FROM ({_FRAC}) f JOIN ({_SEM}) s ON f."column" = s."column"
"""


@query("d9_log", _LOG, ("m_items",))
def d9_log(spark, sf):
    df = m_items(spark, sf)
    types = TY.fit_types(df)
    acts = IM.plan_actions(types.null_fractions, types.semantic)
    return spark.createDataFrame(IM.plan_log(acts, types.null_fractions), "column string, log string")


# ---------------------------------------------------------------- E: outliers

from ..operators import outliers as OU  # noqa: E402

_Q = per_column(
    "SELECT '{c}' AS \"column\", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, "
    "quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM m_items", ITEM_NUMERIC)
_FENCE = f"SELECT \"column\", q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM ({_Q})"


def _fence_of(c):
    return f"(SELECT lo FROM fences WHERE \"column\" = '{c}')", f"(SELECT hi FROM fences WHERE \"column\" = '{c}')"


def _is_out(c):
    lo, hi = _fence_of(c)
    return f"coalesce(CAST({c} AS DOUBLE) < {lo} OR CAST({c} AS DOUBLE) > {hi}, false)"


def _with_fences(sql):
    return f"WITH fences AS ({_FENCE})\n{sql}"


@query("e1_fences", f"SELECT \"column\", round(q1, 6) AS q1, round(q3, 6) AS q3, round(lo, 6) AS lower_fence, "
       f"round(hi, 6) AS upper_fence FROM ({_FENCE})", ("m_items",))
def e1_fences(spark, sf):
    fit = OU.fit_outliers(m_items(spark, sf))
    rows = [(c, f.q1, f.q3, f.lower, f.upper) for c, f in fit.fences.items()]
    d = spark.createDataFrame(rows, "column string, q1 double, q3 double, lower_fence double, upper_fence double")
    return d.select("column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "lower_fence", "upper_fence")])


_COUNTS = per_column(
    "SELECT '{c}' AS \"column\", CAST(count_if(IS_OUT) AS BIGINT) AS outlier_count, "
    "round_even(LO, 4) AS lower_bound, round_even(HI, 4) AS upper_bound, "
    "round_even(count_if(IS_OUT) / count(*) * 100, 2) AS pct_outliers FROM m_items", ITEM_NUMERIC)
_COUNTS = "\nUNION ALL\n".join(
    part.replace("IS_OUT", _is_out(c)).replace("LO", _fence_of(c)[0]).replace("HI", _fence_of(c)[1])
    for part, c in zip(_COUNTS.split("\nUNION ALL\n"), ITEM_NUMERIC))


@query("e2_counts", _with_fences(_COUNTS), ("m_items",))
def e2_counts(spark, sf):
    df = m_items(spark, sf)
    return OU.outlier_report(df, OU.fit_outliers(df))


_ANY = " OR ".join(_is_out(c) for c in ITEM_NUMERIC)


@query("e3_any", _with_fences(f"SELECT CAST(count_if({_ANY}) AS BIGINT) AS total_outlier_rows, count(*) AS \"rows\" "
                              f"FROM m_items"),
       ("m_items",))
def e3_any(spark, sf):
    df = m_items(spark, sf)
    return OU.total_outlier_rows(df, OU.fit_outliers(df))


def _clip_sql(c):
    lo, hi = _fence_of(c)
    x = f"CAST({c} AS DOUBLE)"
    return f"CASE WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END AS {c}"


@query("e4_clip", _with_fences("SELECT " + ", ".join(_clip_sql(c) for c in ITEM_NUMERIC) + " FROM m_items"),
       ("m_items",))
def e4_clip(spark, sf):
    df = m_items(spark, sf)
    return OU.clip(df, OU.fit_outliers(df)).select(*ITEM_NUMERIC)


@query("e5_flag", _with_fences("SELECT order_id, part_id, " + ", ".join(f"{_is_out(c)} AS {c}_outlier"
                                                                         for c in ITEM_NUMERIC) + " FROM m_items"),
       ("m_items",))
def e5_flag(spark, sf):
    df = m_items(spark, sf)
    return OU.flag(df, OU.fit_outliers(df)).select("order_id", "part_id", *[f"{c}_outlier" for c in ITEM_NUMERIC])


@query("e6_drop", _with_fences(f"SELECT order_id, part_id, qty, price, flag FROM m_items WHERE NOT ({_ANY})"),
       ("m_items",))
def e6_drop(spark, sf):
    df = m_items(spark, sf)
    return OU.drop_rows(df, OU.fit_outliers(df)).select("order_id", "part_id", "qty", "price", "flag")


_Z = per_column(
    "SELECT '{c}' AS \"column\", CAST(count_if(abs((CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM m_items)) / "
    "(SELECT stddev_samp({c}) FROM m_items)) > 3) AS BIGINT) AS n_flagged FROM m_items",
    [c for c in ITEM_NUMERIC if c != "constant_col"])


@query("e8_zscore", _Z, ("m_items",))
def e8_zscore(spark, sf):
    cols = [c for c in ITEM_NUMERIC if c != "constant_col"]
    z = OU.zscore_flags(m_items(spark, sf), cols, 3.0)
    structs = [F.struct(F.lit(c).alias("column"), F.count_if(F.col(f"{c}_zflag")).alias("n_flagged")) for c in cols]
    return z.agg(F.array(*structs).alias("a")).select(F.inline("a"))


# ---------------------------------------------------------------- F: features

from ..operators import features as FE  # noqa: E402


@query("f1_dateparts", """
SELECT item_id, CAST(year(d) AS INTEGER) AS ship_date_year, CAST(month(d) AS INTEGER) AS ship_date_month,
       CAST(day(d) AS INTEGER) AS ship_date_day, CAST(isodow(d) - 1 AS INTEGER) AS ship_date_dayofweek,
       isodow(d) >= 6 AS ship_date_is_weekend
FROM (SELECT item_id, strptime(ship_date, '%Y-%m-%d') AS d FROM m_items)""", ("m_items",))
def f1_dateparts(spark, sf):
    df = m_items(spark, sf)
    out = FE.date_parts(TY.apply_types(df, TY.fit_types(df)), ["ship_date"])
    return out.select("item_id", *[f"ship_date_{p}" for p in FE.DATE_PARTS])


def _duck_codes(c, order="{c}"):
    return (f"(SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
            f"(SELECT DISTINCT {c} AS v FROM m_items WHERE {c} IS NOT NULL))")


@query("f2_encode", f"""
SELECT order_id, part_id, flag, coalesce(a.code, -1) AS flag_encoded, coalesce(b.code, -1) AS status_code_encoded
FROM m_items LEFT JOIN {_duck_codes('flag')} a ON flag = a.v LEFT JOIN {_duck_codes('status_code')} b
ON status_code = b.v""", ("m_items",))
def f2_encode(spark, sf):
    df = m_items(spark, sf)
    out = FE.apply_encode(df, FE.fit_encode(df, ["flag", "status_code"]))
    return out.select("order_id", "part_id", "flag", "flag_encoded", "status_code_encoded")


def _duck_first(c):
    return (f"(SELECT v, CAST(row_number() OVER (ORDER BY first, v) - 1 AS INTEGER) AS code FROM "
            f"(SELECT {c} AS v, min(order_id) AS first FROM m_items WHERE {c} IS NOT NULL GROUP BY {c}))")


@query("f3_factorize", f"""
SELECT order_id, part_id, flag, coalesce(a.code, -1) AS flag_encoded, coalesce(b.code, -1) AS status_code_encoded
FROM m_items LEFT JOIN {_duck_first('flag')} a ON flag = a.v LEFT JOIN {_duck_first('status_code')} b
ON status_code = b.v""", ("m_items",))
def f3_factorize(spark, sf):
    df = m_items(spark, sf)
    out = FE.apply_encode(df, FE.fit_encode(df, ["flag", "status_code"], order_by="order_id"))
    return out.select("order_id", "part_id", "flag", "flag_encoded", "status_code_encoded")


@query("f4_squares", """
SELECT CAST(order_id AS DOUBLE) * order_id AS order_id_sq, CAST(part_id AS DOUBLE) * part_id AS part_id_sq,
       qty * qty AS qty_sq FROM m_items""", ("m_items",))
def f4_squares(spark, sf):
    out, cols = FE.squares(m_items(spark, sf))
    return out.select(*[f"{c}_sq" for c in cols])


@query("f5_interaction", "SELECT CAST(order_id AS DOUBLE) * part_id AS order_id_x_part_id FROM m_items",
       ("m_items",))
def f5_interaction(spark, sf):
    df = m_items(spark, sf)
    _, cols = FE.squares(df)
    return FE.interaction(df, cols).select(f"{cols[0]}_x_{cols[1]}")


@query("f6_featlog", f"""
SELECT CASE WHEN semantic = 'datetime' THEN 'date_parts' ELSE 'codes' END AS kind, "column" AS source,
       CASE WHEN semantic = 'datetime' THEN 5 ELSE 1 END AS n_columns
FROM ({_SEM}) WHERE semantic IN ('datetime', 'categorical')
UNION ALL SELECT 'square', unnest(['order_id', 'part_id', 'qty']), 1
UNION ALL SELECT 'product', 'order_id,part_id', 1""", ("m_items",))
def f6_featlog(spark, sf):
    df = m_items(spark, sf)
    fit = TY.fit_types(df)
    _, done = FE.engineer(TY.apply_types(df, fit), fit.semantic, polynomial=True)
    return spark.createDataFrame([(d.kind, ",".join(d.sources), d.count) for d in done], "kind string, source string, n_columns int")


# ---------------------------------------------------------------- G: selection

from ..operators import select as SE  # noqa: E402

_SEL_NUM = [c for c in ITEM_NUMERIC if c != "target"]
_VAR = per_column(
    "SELECT '{c}' AS \"column\", coalesce(var_samp({c}) < 0.01, false) AS low_variance FROM m_items", _SEL_NUM)


@query("g1_var", _VAR, ("m_items",))
def g1_var(spark, sf):
    df = m_items(spark, sf)
    var = SE.variances(df, _SEL_NUM)
    return spark.createDataFrame([(c, v is not None and v < SE.VARIANCE_THRESHOLD) for c, v in var.items()],
                                 "column string, low_variance boolean")


def _duck_corr(a, b, src="m_items"):
    return (f"SELECT '{a}' AS a, '{b}' AS b, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS r "
            f"FROM (SELECT corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM {src})")


@query("g2_corr", "\nUNION ALL\n".join(_duck_corr(_SEL_NUM[i], _SEL_NUM[j])
                                       for j in range(len(_SEL_NUM)) for i in range(j)), ("m_items",))
def g2_corr(spark, sf):
    t = SE.correlation_table(m_items(spark, sf), _SEL_NUM)
    return t.select("a", "b", F.round("r", 6).alias("r"))


_SQ_COLS = _SEL_NUM + ["order_id_sq", "part_id_sq", "qty_sq"]
_SQ_SRC = ("(SELECT *, CAST(order_id AS DOUBLE) * order_id AS order_id_sq, CAST(part_id AS DOUBLE) * part_id "
           "AS part_id_sq, qty * qty AS qty_sq FROM m_items)")
def _g3_sql():
    var_rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS c, {i} AS o, coalesce(var_samp({c}) < 0.01, false) AS low FROM {_SQ_SRC}"
        for i, c in enumerate(_SQ_COLS))
    pairs = "\nUNION ALL\n".join(_duck_corr(_SQ_COLS[i], _SQ_COLS[j], _SQ_SRC)
                                 for j in range(len(_SQ_COLS)) for i in range(j))
    return f"""
WITH v AS ({var_rows}), p AS ({pairs})
SELECT DISTINCT p.b AS "column" FROM p JOIN v va ON p.a = va.c JOIN v vb ON p.b = vb.c
WHERE NOT va.low AND NOT vb.low AND abs(p.r) > 0.95"""


@query("g3_corrfilter", _g3_sql(), ("m_items",))
def g3_corrfilter(spark, sf):
    df, _ = FE.squares(m_items(spark, sf))
    fit = SE.fit_select(df, "target")
    return spark.createDataFrame([(c,) for c in fit.high_correlation], "column string")


_ORD = " UNION ALL ".join(f"SELECT '{c}' AS c, {i} AS o" for i, c in enumerate(ITEM_COLS))


def _g4_sql():
    return f"""
WITH cols AS ({_ORD}), v AS ({_VAR}),
p AS ({" UNION ALL ".join(_duck_corr(_SEL_NUM[i], _SEL_NUM[j]) for j in range(len(_SEL_NUM)) for i in range(j))}),
hi AS (SELECT DISTINCT p.b AS c FROM p JOIN v va ON p.a = va."column" JOIN v vb ON p.b = vb."column"
       WHERE NOT va.low_variance AND NOT vb.low_variance AND abs(p.r) > 0.95),
kept AS (SELECT c, o FROM cols WHERE c <> 'target'
         AND c NOT IN (SELECT "column" FROM v WHERE low_variance) AND c NOT IN (SELECT c FROM hi))
SELECT CAST(row_number() OVER (ORDER BY o) AS INTEGER) AS position, c AS "column" FROM kept
UNION ALL
SELECT CAST((SELECT count(*) FROM kept) + 1 AS INTEGER), 'target'"""


@query("g4_target", _g4_sql(), ("m_items",))
def g4_target(spark, sf):
    df = m_items(spark, sf)
    out = SE.apply_select(df, SE.fit_select(df, "target"))
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(out.columns)], "position int, column string")


@query("g5_removed", f"SELECT \"column\" AS feature, 'low variance' AS reason FROM ({_VAR}) WHERE low_variance",
       ("m_items",))
def g5_removed(spark, sf):
    df = m_items(spark, sf)
    fit = SE.fit_select(df, "target")
    rows = [(c, "low variance") for c in fit.low_variance] + [(c, "high correlation") for c in fit.high_correlation]
    return spark.createDataFrame(rows, "feature string, reason string")


# ---------------------------------------------------------------- H: validation

from ..operators import validate as VA  # noqa: E402


@query("h2_residual", f"SELECT \"column\", null_count FROM ({_NULLS}) WHERE null_count > 0", ("m_items",))
def h2_residual(spark, sf):
    return VA.residual_nulls(m_items(spark, sf))


_NULL_COLS = " + ".join(f"CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END" for c in ITEM_COLS)


@query("h3_h4_status", f"""
SELECT n AS "rows", 12 AS "columns", k AS residual_null_columns,
       CASE WHEN k > 0 OR n < 10 THEN 'PASSED WITH WARNINGS' ELSE 'PASSED' END AS pipeline_status
FROM (SELECT count(*) AS n, {_NULL_COLS} AS k FROM m_items)""", ("m_items",))
def h3_h4_status(spark, sf):
    return VA.status_frame(m_items(spark, sf)).select(
        "rows", F.col("columns").cast("int"), F.col("residual_null_columns").cast("int"), "pipeline_status")


# ---------------------------------------------------------------- H1, H5, I1, I5 (composition)

from .prepare import prepare  # noqa: E402
from .render import render  # noqa: E402


# the run's rules cell by cell: types, fills, fences of the filled columns, codes, date parts; the constant column and
# discount (variance below the limit) go, the target stays as it is
_RUN_NUMERIC = ["order_id", "part_id", "qty", "price", "discount", "constant_col"]
_MEDIAN = "(SELECT quantile_cont({c}, 0.5) FROM m_items)"
_FILLED = f"""
SELECT order_id, part_id, coalesce(qty, {_MEDIAN.format(c='qty')}) AS qty, price, coalesce(discount, {_MEDIAN.format(c='discount')}) AS discount,
       coalesce(flag, {_duck_mode('flag')}) AS flag, status_code, CAST(strptime(ship_date, '%Y-%m-%d') AS TIMESTAMP) AS ship_date,
       item_id, constant_col, target
FROM m_items"""
_RUN_FENCES = per_column(
    "SELECT '{c}' AS c, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM filled",
    _RUN_NUMERIC)
_LOW, _HIGH = "(SELECT q1 - 1.5 * (q3 - q1) FROM fences WHERE c = '{c}')", "(SELECT q3 + 1.5 * (q3 - q1) FROM fences WHERE c = '{c}')"
_PARTS = """CAST(dense_rank() OVER (ORDER BY flag) - 1 AS INTEGER) AS flag_encoded,
       CAST(dense_rank() OVER (ORDER BY status_code) - 1 AS INTEGER) AS status_code_encoded,
       CAST(year(ship_date) AS INTEGER) AS ship_date_year, CAST(month(ship_date) AS INTEGER) AS ship_date_month,
       CAST(day(ship_date) AS INTEGER) AS ship_date_day, CAST(isodow(ship_date) - 1 AS INTEGER) AS ship_date_dayofweek,
       isodow(ship_date) >= 6 AS ship_date_is_weekend"""
_PREPARED = f"""
WITH filled AS MATERIALIZED ({_FILLED}), fences AS MATERIALIZED ({_RUN_FENCES})
SELECT """ + ", ".join(f"least(greatest(CAST({c} AS DOUBLE), {_LOW.format(c=c)}), {_HIGH.format(c=c)}) AS {c}"
                       for c in _RUN_NUMERIC[:4]) + f""",
       flag, status_code, ship_date, item_id, {_PARTS}, target
FROM filled"""


@query("i1_prepare", _PREPARED, ("m_items",))
def i1_prepare(spark, sf):
    """Flagship: the fully prepared item table (target protected and last)."""
    return prepare(m_items(spark, sf), target="target").df


@query("i3_saved_run", _PREPARED, ("m_items",))
def i3_saved_run(spark, sf):
    """A run's fits, saved by one store and applied to the table by what another store loads."""
    from ..streaming.apply import apply_fitted
    root = os.path.join(ensure_checkpoint_dir(spark), f"runs-{uuid.uuid4().hex}")
    df = m_items(spark, sf)
    prepare(df, target="target", store=RunStore(spark, root), run_id="r")
    return apply_fitted(df, RunStore(spark, root).load_fits("r"))


def _rule_book(facts: dict) -> dict:
    """An adviser of columns: what it does not know it refuses."""
    if facts["semantic"] not in ("numeric", "categorical"):
        raise LookupError(f"no rule for {facts['semantic']}")
    return {"strategy": "mean" if facts["null_pct"] < 10 else "constant" if facts["semantic"] == "numeric" else "guess"}


@query("i4_column_advice", f"""
SELECT f."column", CASE WHEN frac < 0.1 AND s.semantic IN ('numeric', 'categorical') THEN 'mean'
                        WHEN s.semantic = 'numeric' THEN 'constant' WHEN s.semantic = 'categorical' THEN 'guess' END AS strategy,
       CASE WHEN s.semantic NOT IN ('numeric', 'categorical') THEN 'LookupError: no rule for ' || s.semantic
            WHEN frac >= 0.1 AND s.semantic = 'categorical' THEN 'unknown strategy guess' END AS advice_error
FROM ({_FRAC}) f JOIN ({_SEM}) s ON f."column" = s."column" WHERE frac > 0 AND frac < 0.7""", ("m_items",))
def i4_column_advice(spark, sf):
    """Strategies that a callable advises for the columns with holes."""
    from ..operators import advise as AD
    df = m_items(spark, sf)
    types = TY.fit_types(df)
    return AD.advise_columns(AD.column_facts(df, types.semantic, types.null_fractions), _rule_book)


def _grade(row: dict) -> dict:
    """An adviser of rows: a grade of the discount, refused where there is none, and no number for the largest lots."""
    if row["discount"] is None:
        raise LookupError("no discount")
    grade = "none" if row["discount"] == 0 else "low" if row["discount"] < 0.05 else "high"
    return {"grade": grade, "rest": "many" if (row["qty"] or 0) >= 50 else row["qty"]}


@query("i4_row_advice", """
SELECT order_id, part_id, CASE WHEN fault IS NULL THEN CASE WHEN discount = 0 THEN 'none' WHEN discount < 0.05 THEN 'low' ELSE 'high' END
       END AS grade, CASE WHEN fault IS NULL THEN qty END AS rest, fault AS advice_error
FROM (SELECT *, CASE WHEN discount IS NULL THEN 'LookupError: no discount'
                     WHEN qty >= 50 THEN 'TypeError: rest: ''many'' is no double' END AS fault FROM m_items)""", ("m_items",))
def i4_row_advice(spark, sf):
    """A callable over every row: its answers, and its faults where it has none."""
    from ..operators import advise as AD
    return AD.advise_rows(m_items(spark, sf).select("order_id", "part_id", "qty", "discount"), _grade,
                          "grade string, rest double", batch_rows=1000).drop("qty", "discount")


# a ledger of runs (day and a part of it) whose events name the steps they logged
_STEP = ("CASE user_id % 9 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(VA.EXPECTED_STEPS)) + " ELSE 'other' END")
_LEDGER_SQL = (f"SELECT CONCAT('day-', CAST(CAST(ts AS DATE) AS STRING), '-', CAST(event_id % 101 AS STRING)) AS run_id, "
               f"{_STEP} AS step, ts AS at FROM events")


@query("h1_steps", f"""
WITH ledger AS ({_LEDGER_SQL.replace('STRING', 'VARCHAR')}),
     expected AS ({" UNION ALL ".join(f"SELECT '{s}' AS step, {i} AS ord" for i, s in enumerate(VA.EXPECTED_STEPS))}),
     runs AS (SELECT DISTINCT run_id FROM ledger)
SELECT r.run_id, e.step, CAST(e.ord AS INTEGER) AS ord FROM runs r, expected e
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.run_id = r.run_id AND l.step = e.step)""")
def h1_steps(spark, sf):
    """Expected steps that the runs of a ledger have not logged."""
    from ..session import read_table
    read_table(spark, sf, "events").createOrReplaceTempView("events")
    return VA.missing_steps_of_runs(spark.sql(_LEDGER_SQL))


_REPORT_SQL = f"""
SELECT 'audit' AS stage, "column", 'null_count' AS metric, CAST(null_count AS VARCHAR) AS value FROM ({_NULLS})
UNION ALL SELECT 'audit', NULL, 'duplicate_rows', CAST(duplicate_rows AS VARCHAR) FROM ({_DUPS})
UNION ALL SELECT 'audit', NULL, 'overall_quality', overall_quality FROM ({_RATING})
UNION ALL SELECT 'audit', "column", 'zero_variance', 'True' FROM ({_ZERO})
UNION ALL SELECT 'types', "column", 'semantic', semantic FROM ({_SEM})
UNION ALL SELECT 'missing', "column", 'strategy', strategy FROM ({_PLAN})
"""


@query("i1_report", _REPORT_SQL, ("m_items",))
def i1_report(spark, sf):
    """Stage metrics of the full run: audit, types and the missing-value plan."""
    rep = prepare(m_items(spark, sf), target="target").report()
    return rep.where("metric IN ('null_count', 'duplicate_rows', 'overall_quality', 'zero_variance', 'semantic', 'strategy')"
                     ).select("stage", "column", "metric", "value")


# features: five date parts are one line, codes one each.  Columns of the flagging run: ten, a flag for each numeric one,
# two codes and five date parts; numeric ones go by variance, then by correlation with an earlier one
_RUN_SELECT = _RUN_NUMERIC + ["flag_encoded", "status_code_encoded", "ship_date_year", "ship_date_month", "ship_date_day",
                              "ship_date_dayofweek"]
_RUN_VARS = "\nUNION ALL\n".join(
    f"SELECT {i} AS i, coalesce(var_samp({c}) < 0.01, false) AS low FROM flagged" for i, c in enumerate(_RUN_SELECT))
_RUN_PAIRS = "\nUNION ALL\n".join(
    f"SELECT {i} AS a, {j} AS b, corr({x}, {y}) AS r FROM flagged"
    for i, x in enumerate(_RUN_SELECT) for j, y in enumerate(_RUN_SELECT) if i < j)
_RUN_OUT = " OR ".join(f"CAST({c} AS DOUBLE) < {_LOW.format(c=c)} OR CAST({c} AS DOUBLE) > {_HIGH.format(c=c)}" for c in _RUN_NUMERIC)
_H5 = f"""
WITH s AS MATERIALIZED ({_SEM}), r AS MATERIALIZED ({_RATING}), filled AS MATERIALIZED ({_FILLED}),
     fences AS MATERIALIZED ({_RUN_FENCES}), flagged AS MATERIALIZED (SELECT *, {_PARTS} FROM filled),
     low AS MATERIALIZED ({_RUN_VARS}), pairs AS MATERIALIZED ({_RUN_PAIRS}),
     gone AS MATERIALIZED (SELECT i FROM low WHERE low UNION
         SELECT b FROM pairs WHERE abs(r) > 0.95 AND a NOT IN (SELECT i FROM low WHERE low) AND b NOT IN (SELECT i FROM low WHERE low))
SELECT (SELECT overall_quality FROM r) AS original_quality,
       (SELECT count(*) FROM s WHERE semantic IN ('datetime', 'categorical')) AS features_engineered,
       (SELECT count(*) FROM gone) AS features_removed, (SELECT 23 - count(*) FROM gone) AS features_kept,
       CAST((SELECT count_if({_RUN_OUT}) FROM filled) AS VARCHAR) AS outlier_rows_flagged
"""


@query("h5_rollup", _H5, ("m_items",))
def h5_rollup(spark, sf):
    """All five figures of the roll-up of a run that flags outliers."""
    res = prepare(m_items(spark, sf), target="target", outlier_action="flag")
    return VA.stats_rollup(res.report()).drop("run_id")


_TEMPLATES = {
    "card": "{{{col_name}}} is held as {col_type}; {missing_pct} of 100 cells are empty",
    "unfilled": "{col_name} by {no_such_column}",
}


@query("i5_render", f"""
SELECT s."column" AS col_name, 'card' AS template_id,
       '{{{{' || s."column" || '}}}} is held as ' || s.semantic || '; ' || CAST(coalesce(p.null_pct, 0.0) AS VARCHAR)
       || ' of 100 cells are empty' AS prompt
FROM ({_SEM}) s LEFT JOIN ({_PCT}) p ON s."column" = p."column"
UNION ALL
SELECT "column", 'unfilled', '{{col_name}} by {{no_such_column}}' FROM ({_SEM})""".replace("{{{{", "{{").replace("}}}}", "}}")
       .replace("{{", "{").replace("}}", "}"), ("m_items",))
def i5_render(spark, sf):
    df = m_items(spark, sf)
    cards = P.column_cards(TY.semantic_types(df), df).select(
        F.col("column").alias("col_name"), F.col("semantic").alias("col_type"), F.col("null_pct").alias("missing_pct"))
    return render(cards, _TEMPLATES, keep=["col_name"])
