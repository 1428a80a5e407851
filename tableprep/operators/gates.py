"""Contract gates (J1-J22): the reference's prose rules as computed checks.

Every gate returns ``(rule, column, observed, limit, fired)``.  Gates are
projections over the per-column statistics of the other stages (one
aggregate each); a few (J7, J8, J16) scan the table once more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC, STRING, col, families, family
from ..functions.heavy import top_table
from ..functions.stats import comparable_columns, distinct_counts, typed_value
from .profile import column_profile, duplicate_rows

# Thresholds stated by the rules.
LIMITS = {
    "J1": 0.30, "J1_col": 50.0, "J2": 50, "J4": 40.0, "J5": 0.95, "J6": 0.5, "J7": 0.10, "J8": 0.20,
    "J9_id": 0.95, "J9_cat": 0.05, "J9_dt": 10, "J11_drop": 70.0, "J11_knn": 20.0, "J11_skew": 1.0,
    "J12": 0.30, "J13": 5.0, "J14_rows": 0.20, "J15_onehot": 50, "J18_min": 3, "J18_corr": 0.9,
    "J19_loss": 0.40, "J20_growth": 3.0,
}
RISKY_NAMES = "fraud|churn|default"
ANOMALY_NAMES = "fraud|anomaly"
TOKEN_PATTERN = r"(N/A|[$%])"
GATE_SCHEMA = "rule string, column string, observed double, limit double, fired boolean"


def _gate(df: DataFrame, rule: str, column, observed, limit, fired) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), (column if column is not None else F.lit(None)).cast("string")
                     .alias("column"), observed.cast("double").alias("observed"),
                     F.lit(limit).cast("double").alias("limit"), fired.alias("fired"))


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def j1_sparse_share(df):
    p = column_profile(df).agg(F.avg(F.when(F.col("null_pct") > LIMITS["J1_col"], 1.0).otherwise(0.0)).alias("o"))
    return _gate(p, "J1", None, F.col("o"), LIMITS["J1"], F.col("o") > LIMITS["J1"])


def j2_rows_after_dedup(df):
    """Rows left after removing duplicates = rows - duplicate rows (fingerprint count)."""
    g = _pair(df.agg(F.count(F.lit(1)).alias("rows")), duplicate_rows(df), "rows", "duplicate_rows")
    o = F.col("rows") - F.col("duplicate_rows")
    return _gate(g, "J2", None, o, LIMITS["J2"], o < LIMITS["J2"])


def j3_all_zero_variance(df):
    p = column_profile(df).where(F.col("family") == NUMERIC).agg(
        F.avg(F.col("zero_var").cast("double")).alias("o"))
    return _gate(p, "J3", None, F.col("o"), 1.0, F.coalesce(F.col("o") == 1.0, F.lit(False)))


def j4_not_good(df):
    p = column_profile(df).agg(F.max("null_pct").alias("o"))
    return _gate(p, "J4", None, F.col("o"), LIMITS["J4"], F.col("o") > LIMITS["J4"])


def j5_near_constant(df, threshold=LIMITS["J5"]):
    s = top_table(df).select("column", F.try_divide("top_n", "non_null").alias("o"))
    return _gate(s, "J5", F.col("column"), F.col("o"), threshold, F.col("o") > threshold)


def j6_untyped_share(semantic: DataFrame):
    s = semantic.agg(F.avg(F.when(F.col("semantic") == "unknown", 1.0).otherwise(0.0)).alias("o"))
    return _gate(s, "J6", None, F.col("o"), LIMITS["J6"], F.col("o") > LIMITS["J6"])


def _per_string(df, rule, expr, limit):
    cols = [c for c, f in families(df).items() if f == STRING]
    structs = [F.struct(F.lit(c).alias("column"), F.try_divide(expr(col(c)), F.count(col(c)).cast("double")).alias("o"))
               for c in cols]
    if not structs:
        return df.sparkSession.createDataFrame([], GATE_SCHEMA)
    a = df.agg(F.array(*structs).alias("a")).select(F.inline("a"))
    return _gate(a, rule, F.col("column"), F.col("o"), limit, F.coalesce(F.col("o") > limit, F.lit(False)))


def j7_dirty_numeric_tokens(df):
    return _per_string(df, "J7", lambda x: F.count_if(x.rlike(TOKEN_PATTERN)).cast("double"), LIMITS["J7"])


def j8_non_numeric_strings(df, typed_numeric):
    """Share of values that are no number, in text columns that a type map calls numeric."""
    cols = [c for c, f in families(df).items() if f == STRING and c in set(typed_numeric)]
    return _per_string(df.select(*map(col, cols)), "J8",
                       lambda x: F.count_if(x.try_cast("double").isNull() & x.isNotNull()).cast("double"), LIMITS["J8"])


def j9_type_thresholds(ratios: DataFrame, semantic: DataFrame, nonnull: DataFrame):
    """One row per column and rule: ``J9.id`` fires where a ratio above 0.95 is not typed id, ``J9.categorical``
    where a ratio below 0.05 of a text column is not typed categorical, ``J9.datetime`` on a datetime of < 10 samples."""
    j = ratios.join(semantic, "column").join(nonnull, "column")
    r, k = F.col("ratio"), F.col("semantic")
    c = F.col("column")
    return _union([
        _gate(j, "J9.id", c, r, LIMITS["J9_id"], (r > LIMITS["J9_id"]) & (k != "id")),
        _gate(j, "J9.categorical", c, r, LIMITS["J9_cat"], (r < LIMITS["J9_cat"]) & ~k.isin("categorical", "datetime", "unknown")),
        _gate(j, "J9.datetime", c, F.col("non_null"), LIMITS["J9_dt"],
              (k == "datetime") & (F.col("non_null") < LIMITS["J9_dt"]))])


def j10_mean_misuse(plan: DataFrame):
    """plan ``(column, semantic, strategy)``: mean on id/text or on a risky name fires."""
    mean = F.col("strategy") == "mean"
    bad = mean & (F.col("semantic").isin("id", "text") | F.lower(F.col("column")).rlike(RISKY_NAMES))
    return _gate(plan, "J10", F.col("column"), mean.cast("double"), 1.0, bad)


def j11_missing_advice(df):
    """One row per column and rule: ``J11.drop`` above 70 % NULL, ``J11.knn`` for numeric columns of 20 to 70 %,
    ``J11.median`` where |skewness| > 1 and NULLs are to be filled."""
    fams = families(df)
    structs = []
    for c, f in fams.items():
        sk = F.skewness(col(c)) if f == NUMERIC else F.lit(None).cast("double")
        pct = F.try_divide(F.count_if(col(c).isNull()), F.count(F.lit(1))) * 100
        structs.append(F.struct(F.lit(c).alias("column"), F.lit(f).alias("family"), pct.alias("pct"), sk.alias("skew")))
    a = df.agg(F.array(*structs).alias("a")).select(F.inline("a"))
    p, sk, c = F.coalesce("pct", F.lit(0.0)), F.coalesce(F.abs("skew"), F.lit(0.0)), F.col("column")
    knn = (F.col("family") == NUMERIC) & p.between(LIMITS["J11_knn"], LIMITS["J11_drop"])
    return _union([_gate(a, "J11.drop", c, p, LIMITS["J11_drop"], p > LIMITS["J11_drop"]),
                   _gate(a, "J11.knn", c, p, LIMITS["J11_knn"], knn),
                   _gate(a, "J11.median", c, sk, LIMITS["J11_skew"], (sk > LIMITS["J11_skew"]) & (p > 0))])


def j12_synthetic_share(df, target: str | None = None):
    p = column_profile(df).where((F.col("null_count") > 0))
    o = F.try_divide("null_count", "rows")
    near_target = F.lit(False) if not target else F.lower(F.col("column")).contains(target.lower())
    return _gate(p, "J12", F.col("column"), o, LIMITS["J12"], (o > LIMITS["J12"]) | near_target)


def j13_outlier_policy(report: DataFrame, target: str | None = None, actions: dict | None = None):
    """report ``(column, pct_outliers, ...)`` and the planned action of each column (default ``clip``):
    ``J13.drop`` fires where drop is planned above 5 %, ``J13.clip`` where clip is planned on an
    anomaly name, ``J13.target`` where the target is touched at all."""
    pct, c = F.col("pct_outliers"), F.col("column")
    action = F.lit("clip")
    for name, a in (actions or {}).items():
        action = F.when(c == name, a).otherwise(action)
    j = report.select("column", "pct_outliers", action.alias("action"))
    act = F.col("action")
    return _union([
        _gate(j, "J13.drop", c, pct, LIMITS["J13"], (act == "drop") & (pct > LIMITS["J13"])),
        _gate(j, "J13.clip", c, pct, 0.0, (act == "clip") & F.lower(c).rlike(ANOMALY_NAMES)),
        _gate(j, "J13.target", c, pct, 0.0, act.isin("drop", "clip") & c.eqNullSafe(F.lit(target)))])


def j14_outlier_backtrack(total: DataFrame, fences: DataFrame):
    """total ``(total_outlier_rows, rows)``; fences ``(column, q1, q3)`` -> IQR = 0 fires."""
    share = total.select(F.coalesce(F.try_divide("total_outlier_rows", "rows"), F.lit(0.0)).alias("o"))
    a = _gate(share, "J14", None, F.col("o"), LIMITS["J14_rows"], F.col("o") > LIMITS["J14_rows"])
    iqr = F.col("q3") - F.col("q1")
    b = _gate(fences, "J14", F.col("column"), iqr, 0.0, F.coalesce(iqr == 0, F.lit(False)))
    return a.unionByName(b)


#: kinds of transform a plan may name for J15
TRANSFORMS = ("one_hot", "log", "polynomial")


def j15_feature_bans(df, semantic: DataFrame, transforms: dict | None = None):
    """One row per column and planned transform (default: all three): ``J15.one_hot`` fires above 50 distinct values,
    ``J15.log`` where the minimum is not positive, ``J15.polynomial`` on id and text columns."""
    s = distinct_counts(df)
    mins = column_profile(df).select("column", "vmin")
    j = semantic.join(s, "column", "left").join(mins, "column", "left")
    n, c = F.coalesce(F.col("n_distinct"), F.lit(0)), F.col("column")
    bad = F.col("semantic").isin("id", "text")
    rules = {"one_hot": (n, LIMITS["J15_onehot"], n > LIMITS["J15_onehot"]),
             "log": (F.col("vmin"), 0.0, F.coalesce(F.col("vmin") <= 0, F.lit(False))),
             "polynomial": (bad.cast("double"), 0.0, bad)}
    out = []
    for t in TRANSFORMS:
        names = None if transforms is None else [x for x, kinds in transforms.items() if t in kinds]
        out.append(_gate(j if names is None else j.where(c.isin(names)), f"J15.{t}", c, *rules[t]))
    return _union(out)


def _same_value(f: T.StructField):
    """One comparable form per value: whole numbers as longs whatever their type, other numbers as doubles (decimals
    with their digits where a double cannot hold them), dates, times and text apart from numbers."""
    x, dt = col(f.name), f.dataType
    none = {s: F.lit(None).cast(t) for s, t in (("lng", "bigint"), ("num", "double"), ("str", "string"))}
    if not isinstance(dt, T.NumericType):
        v = typed_value(f)
        return F.when(x.isNotNull(), F.struct(F.lit(families_of(dt)).alias("kind"), *[v[s].alias(s) for s in none]))
    double = x.cast("double")
    whole = F.coalesce((F.abs(double) < 2.0 ** 63) & (x == F.floor(x)), F.lit(False))
    if isinstance(dt, T.IntegralType):
        none["lng"] = x.cast("bigint")
    else:
        none["lng"] = F.when(whole, x.try_cast("bigint"))
        none["num"] = F.when(~whole, double)
        if isinstance(dt, T.DecimalType):
            none["str"] = F.when(~whole & ~F.coalesce(double.try_cast(dt) == x, F.lit(False)), x.cast("string"))
    return F.when(x.isNotNull(), F.struct(F.lit(NUMERIC).alias("kind"), *[c.alias(s) for s, c in none.items()]))


def families_of(dt: T.DataType) -> str:
    """Family of a type, dates and times apart."""
    return dt.simpleString() if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)) else family(dt)


def j16_identical_columns(df, new_cols, old_cols, derived: dict | None = None):
    """``J16.identical``: a derived column equal to an existing one; ``J16.nulls``: a transform (``derived``: new
    column -> its source) that adds NULLs.

    Columns get fingerprints first: per column one order-free aggregate of its
    values' hashes, each mixed with the hash of its row.  Different
    fingerprints prove different columns (``observed`` NULL); only pairs with
    equal ones are compared row by row (``observed``: the rows that differ).
    """
    pairs = [(a, b) for a in new_cols for b in old_cols]
    names = list(dict.fromkeys(x for p in pairs for x in p))
    same = []
    if pairs:
        row = F.xxhash64(*map(col, comparable_columns(df)))
        seen = [F.xxhash64(F.lit(0), row, _same_value(df.schema[c]).isNull(), _same_value(df.schema[c])) for c in names]
        # sums of 20 bits cannot overflow; equal rows would cancel out in a bit sum alone
        got = df.agg(*[F.struct(F.bit_xor(h), F.sum(h.bitwiseAND(0xFFFFF))) for h in seen]).first()
        of = dict(zip(names, map(tuple, got)))
        same = [(a, b) for a, b in pairs if of[a] == of[b]]
    structs = [F.struct(F.lit(f"{a}={b}").alias("column"),
                        F.count_if(~_same_value(df.schema[a]).eqNullSafe(_same_value(df.schema[b]))).alias("o")) for a, b in same]
    added = [F.struct(F.lit(f"{a}<-{b}").alias("column"),
                      F.count_if(col(a).isNull() & col(b).isNotNull()).alias("o")) for a, b in (derived or {}).items()]
    out = []
    for rule, cells, fired in (("J16.identical", structs, F.col("o") == 0), ("J16.nulls", added, F.col("o") > 0)):
        if cells:
            x = df.agg(F.array(*cells).alias("a")).select(F.inline("a"))
            out.append(_gate(x, rule, F.col("column"), F.col("o"), 0.0, fired))
    rest = [(f"{a}={b}",) for a, b in pairs if (a, b) not in same]
    if rest:
        x = df.sparkSession.createDataFrame(rest, "column string")
        out.append(_gate(x, "J16.identical", F.col("column"), F.lit(None), 0.0, F.lit(False)))
    return _union(out) if out else df.sparkSession.createDataFrame([], GATE_SCHEMA)


def j17_selection_rules(semantic: DataFrame, removed: DataFrame, target: str | None):
    """``removed(column[, reason])``: ``J17.id`` asks to flag id columns, ``J17.target`` fires if the target went,
    ``J17.categorical`` if the correlation filter removed a categorical column."""
    reason = F.col("reason") if "reason" in removed.columns else F.lit(None).cast("string")
    j = semantic.join(removed.select("column", reason.alias("reason"), F.lit(1.0).alias("rm")), "column", "left")
    rm, c = F.coalesce(F.col("rm"), F.lit(0.0)), F.col("column")
    corr = F.coalesce(F.col("reason") == "high correlation", F.lit(False))
    return _union([
        _gate(j, "J17.id", c, rm, 0.0, (F.col("semantic") == "id") & (rm == 0)),
        _gate(j, "J17.target", c, rm, 0.0, c.eqNullSafe(F.lit(target)) & (rm == 1)),
        _gate(j, "J17.categorical", c, rm, 0.0, (F.col("semantic") == "categorical") & corr)])


def j18_selection_backtrack(kept_count: DataFrame, target_corr: DataFrame):
    a = _gate(kept_count, "J18", None, F.col("kept"), LIMITS["J18_min"], F.col("kept") < LIMITS["J18_min"])
    r = F.abs(F.col("r"))
    b = _gate(target_corr, "J18", F.col("column"), r, LIMITS["J18_corr"],
              F.coalesce(r > LIMITS["J18_corr"], F.lit(False)))
    return a.unionByName(b)


def j19_validation(before: DataFrame, after: DataFrame, target: str | None):
    """Residual numeric nulls, row loss > 40 %, missing target."""
    nums = [c for c, f in families(after).items() if f == NUMERIC]
    n_before = before.agg(F.count(F.lit(1)).alias("b"))
    agg = after.agg(F.count(F.lit(1)).alias("a"),
                    *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(nums)])
    lost = F.coalesce(F.lit(1.0) - F.try_divide("a", "b"), F.lit(0.0))
    loss = _gate(_pair(n_before, agg, "b", "a"), "J19", None, lost, LIMITS["J19_loss"], lost > LIMITS["J19_loss"])
    nulls = [_gate(agg, "J19", F.lit(c), F.col(f"n{i}"), 0.0, F.col(f"n{i}") > 0) for i, c in enumerate(nums)]
    has_t = target in after.columns if target else True
    miss = _gate(agg, "J19", F.lit(target), F.lit(0.0 if has_t else 1.0), 0.0, F.lit(not has_t))
    return _union([loss, miss] + nulls)


def _pair(one: DataFrame, two: DataFrame, a: str, b: str) -> DataFrame:
    """Put two one-row aggregates side by side without a join."""
    u = one.select(F.col(a).alias("x"), F.lit(None).cast("double").alias("y")).unionByName(
        two.select(F.lit(None).cast("double").alias("x"), F.col(b).cast("double").alias("y")))
    return u.agg(F.max("x").alias(a), F.max("y").alias(b))


def j20_routing(before: DataFrame, after: DataFrame):
    """nulls -> missing, columns > 3x original -> features, row loss -> outliers."""
    rows = _pair(before.agg(F.count(F.lit(1)).alias("b")), after.agg(F.count(F.lit(1)).alias("a")), "b", "a")
    nulls = after.agg(reduce(lambda x, y: x + y, [F.count_if(col(c).isNull()) for c in after.columns]).alias("n"))
    growth = len(after.columns) / max(len(before.columns), 1)
    route = _pair(rows.select(F.coalesce(F.try_divide(F.col("b") - F.col("a"), "b"), F.lit(0.0)).alias("loss")), nulls, "loss", "n")
    r = F.when(F.col("n") > 0, "missing").when(F.lit(growth > LIMITS["J20_growth"]), "features") \
        .when(F.col("loss") > LIMITS["J19_loss"], "outliers")
    return _gate(route, "J20", r, F.col("loss"), LIMITS["J19_loss"], r.isNotNull())


def j21_mode_on_text(plan: DataFrame):
    bad = (F.col("strategy") == "mode") & (F.col("semantic") == "text")
    return _gate(plan, "J21", F.col("column"), bad.cast("double"), 0.0, bad)


def j22_feature_counts(lines: DataFrame, semantic: DataFrame):
    """Per source column: datetime must yield exactly 5 parts; others 0-3 features."""
    per = lines.groupBy("source").agg(F.sum("n_features").alias("k"))
    j = semantic.join(per, semantic["column"] == per["source"], "left")
    k = F.coalesce(F.col("k"), F.lit(0))
    fired = F.when(F.col("semantic") == "datetime", k != 5).otherwise(k > 3)
    return _gate(j, "J22", F.col("column"), k, 5.0, fired)
