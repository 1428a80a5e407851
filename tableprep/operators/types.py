"""Semantic types (stage "types", C1-C9).

Rules (order-free version of the reference's):
* numeric   -> ``id`` when distinct/rows > 0.95, else ``numeric``;
* string    -> ``datetime`` when every non-null value parses under ONE format
               of ``DATETIME_FORMATS`` (an all-null column counts), else
               ``categorical`` when distinct/rows < 0.05, else ``text``;
* timestamp/date -> ``datetime``; anything else (boolean, arrays, ...) -> ``unknown``.

``fit_types(method="auto")`` first estimates distinct counts with HLL
(``approx_count_distinct``, one pass, bounded state), looks again with a finer
HLL where an estimate lies near a threshold, and computes exact distinct
counts only where that one is near, too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import DATETIME, NUMERIC, STRING, col, families
from ..functions.stats import distinct_counts

# Fixed values of the type rules.
ID_RATIO = 0.95
CATEGORICAL_RATIO = 0.05
DATETIME_FORMATS = [
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd.MM.yyyy",
]
# Shape of each format: a cheap regex guard so failing values never reach the parser.
DATETIME_SHAPES = [
    r"^\d{4}-\d{2}-\d{2}$",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$",
    r"^\d{4}/\d{2}/\d{2}$",
    r"^\d{2}/\d{2}/\d{4}$",
    r"^\d{2}\.\d{2}\.\d{4}$",
]
#: formats that a cast reads like their pattern, several times as fast, and the length of their texts
CAST_LENGTHS = {"yyyy-MM-dd": 10, "yyyy-MM-dd HH:mm:ss": 19, "yyyy-MM-dd'T'HH:mm:ss": 19}
APPROX_RSD = 0.05      # HLL++ relative std error (rsd 0.01 is ~20x slower)
NEAR_THRESHOLD = 0.2    # relative band (4 sigma) around a threshold that a finer estimate looks at
FINE_LOG2 = 14          # HLL sketch of 2^14 registers: relative std error below 0.01
FINE_THRESHOLD = 0.03   # relative band (3 sigma of the finer estimate) that is counted exactly


def parse_ts(c, fmt: str):
    """Parse text to a zone-free timestamp, NULL on failure (never raises)."""
    shape = DATETIME_SHAPES[DATETIME_FORMATS.index(fmt)]
    digit_first = F.substring(c, 1, 1).between("0", "9")     # every format starts with a digit
    if fmt in CAST_LENGTHS:     # a cast skips white space at the end, where the shape lets a line break pass
        return F.when(digit_first & (F.length(c) == CAST_LENGTHS[fmt]) & c.rlike(shape), c.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(digit_first & c.rlike(shape), F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz"))


def distinct_ratio(df: DataFrame) -> DataFrame:                        # C1
    """``(column, n_distinct, ratio)``; NULLs are not values but count as rows."""
    rows = df.count()
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")
    summ = distinct_counts(df)
    n = F.coalesce("n_distinct", F.lit(0))
    return (names.join(F.broadcast(summ), "column", "left")    # one row per column: bounded
            .select("column", n.alias("n_distinct"), (n / F.lit(max(rows, 1))).alias("ratio")))


def _datetime_probe_exprs(df: DataFrame):
    """Per text column its non-null values and any one of them: a format that one value lacks is not the format of all."""
    exprs = []
    for c, fam in families(df).items():
        if fam == STRING:
            exprs += [F.count(col(c)).alias(f"n::{c}"), F.first(col(c), ignorenulls=True).alias(f"w::{c}")]
    return exprs


def _format_counts(df: DataFrame, row: dict) -> dict:
    """``{text column: values that parse, per format}``; only formats of the shape of the column's one known value are
    parsed, the others cannot parse all and count 0."""
    texts = [c for c, fam in families(df).items() if fam == STRING]
    asked = [(c, i) for c in texts for i, shape in enumerate(DATETIME_SHAPES)
             if row[f"w::{c}"] is not None and re.search(shape, row[f"w::{c}"], re.ASCII)]
    out = {c: [0] * len(DATETIME_FORMATS) for c in texts}
    if asked:
        for (c, i), n in zip(asked, df.agg(*[F.count(parse_ts(col(c), DATETIME_FORMATS[i])) for c, i in asked]).first()):
            out[c][i] = n
    return out


def _decide(fam: str, ratio, n_nonnull, fmt_counts) -> tuple[str, str | None]:
    if fam == NUMERIC:
        return ("id" if ratio > ID_RATIO else "numeric"), None
    if fam == STRING:
        for i, k in enumerate(fmt_counts):
            if k == n_nonnull:
                return "datetime", DATETIME_FORMATS[i]
        return ("categorical" if ratio < CATEGORICAL_RATIO else "text"), None
    if fam == DATETIME:
        return "datetime", None
    return "unknown", None


@dataclass(frozen=True)
class TypesFit:
    dtypes: dict        # column -> Spark simpleString
    semantic: dict      # column -> id|numeric|datetime|categorical|text|unknown
    formats: dict       # column -> datetime format for string columns parsed as datetime
    ratios: dict        # column -> distinct ratio used for the decision
    null_fractions: dict | None = None   # column -> NULL share (same pass, reusable by imputation)

    def columns_of(self, kind: str) -> list[str]:
        return [c for c, s in self.semantic.items() if s == kind]


def probe_exprs(df: DataFrame) -> list:
    """The aggregate expressions ``fit_types`` begins with (row count, HLL, one value of every text column)."""
    approx = [F.approx_count_distinct(col(c), APPROX_RSD).alias(f"a::{c}") for c in df.columns]
    nulls = [F.count_if(col(c).isNull()).alias(f"z::{c}") for c in df.columns]
    return [F.count(F.lit(1)).alias("rows"), *approx, *nulls, *_datetime_probe_exprs(df)]


def fit_types(df: DataFrame, method: str = "auto", probes: dict | None = None) -> TypesFit:
    """One aggregate (HLL estimates), one that parses the text columns that can be times, then finer estimates
    and exact distinct counts only where needed (``method='exact'`` forces them everywhere).
    ``probes`` is the row of ``probe_exprs`` when it was computed in an
    earlier pass over the same rows."""
    fams = families(df)
    row = probes if probes is not None else df.agg(*probe_exprs(df)).first().asDict()
    rows = row["rows"]
    denom = max(rows, 1)
    ratios = {c: row[f"a::{c}"] / denom for c in df.columns}

    def near(r, band):
        return any(abs(r - t) <= band * t for t in (ID_RATIO, CATEGORICAL_RATIO))

    asked = [c for c in df.columns if fams[c] in (NUMERIC, STRING)]
    need = asked if method == "exact" else [c for c in asked if near(ratios[c], NEAR_THRESHOLD)]
    if need and method != "exact":              # a unique column is far enough from 0.95 for the finer estimate
        fine = df.agg(*[F.hll_sketch_estimate(F.hll_sketch_agg(F.when(col(c).isNotNull(), F.xxhash64(col(c))), F.lit(FINE_LOG2)))
                        for c in need]).first()
        ratios.update({c: (fine[i] or 0) / denom for i, c in enumerate(need)})
        need = [c for c in need if near(ratios[c], FINE_THRESHOLD)]
    if need:
        got = {r["column"]: r["n_distinct"] for r in distinct_counts(df, need).collect()}
        for c in need:
            ratios[c] = got.get(c, 0) / denom
    semantic, formats, parsed = {}, {}, _format_counts(df, row)
    for c, fam in fams.items():
        s, fmt = _decide(fam, ratios[c], row.get(f"n::{c}"), parsed.get(c, []))
        semantic[c] = s
        if fmt:
            formats[c] = fmt
    dtypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    fractions = None
    if df.columns and f"z::{df.columns[0]}" in row:
        fractions = {c: (row[f"z::{c}"] / rows if rows else None) for c in df.columns}
    return TypesFit(dtypes, semantic, formats, ratios, fractions)


def semantic_types(df: DataFrame, method: str = "auto") -> DataFrame:   # C2-C5
    fit = fit_types(df, method)
    return df.sparkSession.createDataFrame(
        [(c, fit.dtypes[c], fit.semantic[c]) for c in df.columns], "column string, dtype string, semantic string")


def apply_types(df: DataFrame, fit: TypesFit) -> DataFrame:            # C6
    """Cast datetime-looking text to timestamps; categoricals stay strings
    (their dictionary is built by the encoder)."""
    out = []
    for c in df.columns:
        if c in fit.formats:
            out.append(parse_ts(col(c), fit.formats[c]).alias(c))
        else:
            out.append(col(c))
    return df.select(*out)


def coerce_numeric(df: DataFrame, cols) -> DataFrame:                   # C8
    """``to_numeric(errors='coerce')``: unparsable text becomes NULL."""
    cols = set(cols)
    return df.select(*[col(c).try_cast("double").alias(c) if c in cols else col(c) for c in df.columns])


def cast_log(fit: TypesFit) -> list[tuple[str, str]]:                   # C9
    """``(column, type it becomes)`` of the columns whose type changes."""
    to = {c: "datetime" for c in fit.formats}
    to.update({c: "category" for c in fit.columns_of("categorical")})
    return [(c, to[c]) for c in fit.semantic if c in to]
