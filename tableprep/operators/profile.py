"""Quality profile (stage "audit", B1-B11).

Every per-column number comes from ONE aggregate over the table, returned as a
long ``(column, ...)`` DataFrame through ``inline`` of an array of structs.
Duplicates are counted by row digests first and by whole rows where a digest
repeats.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NUMERIC, col, families, pct
from ..functions.stats import typed_value, value_text
from ..session import cut_lineage

# Fixed values of the audit rules.
HIGH_NULL_PCT = 50          # flag when a column is more than this % missing
POOR_FLAG_COUNT = 3         # POOR when more flags than this, FAIR when any
BAND_HIGH, BAND_MED = 50, 10


def column_profile(df: DataFrame) -> DataFrame:
    """Per-column profile rows (see ``profile_structs``) from one aggregate."""
    structs = profile_structs(df)
    if not structs:
        return df.sparkSession.createDataFrame(
            [], "column string, family string, rows long, null_count long, null_pct double, vmin double, "
                "vmax double, mean double, std double, zero_var boolean")
    return df.agg(F.array(*structs).alias("p")).select(F.inline("p"))


def profile_structs(df: DataFrame, moments: bool = True) -> list:
    """``(column, family, rows, null_count, null_pct, vmin, vmax, mean, std, zero_var)``, without ``moments`` no mean and std.

    ``zero_var`` (numeric only) is ``min <=> max``: true for a constant or an
    all-null column, the same truth as ``nunique() <= 1`` without a distinct.
    """
    fams = families(df)
    rows = F.count(F.lit(1))
    structs = []
    for c, fam in fams.items():
        x = col(c)
        isnum = fam == NUMERIC
        xd = x.cast("double") if isnum else F.lit(None).cast("double")
        nulls = F.count_if(x.isNull())
        structs.append(F.struct(
            F.lit(c).alias("column"), F.lit(fam).alias("family"),
            rows.alias("rows"), nulls.alias("null_count"),
            pct(nulls, rows).alias("null_pct"),
            F.min(xd).alias("vmin"), F.max(xd).alias("vmax"),
            *([F.avg(xd).alias("mean"), F.stddev_samp(xd).alias("std")] if moments else []),
            (F.min(xd).eqNullSafe(F.max(xd)) if isnum else F.lit(None).cast("boolean")).alias("zero_var"),
        ))
    return structs


def null_counts(df: DataFrame) -> DataFrame:                       # B1
    return column_profile(df).select("column", "null_count")


def null_percent(df: DataFrame) -> DataFrame:                      # B2
    return column_profile(df).select("column", "null_pct")


def _holds_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return True
    if isinstance(dt, T.ArrayType):
        return _holds_map(dt.elementType)
    return isinstance(dt, T.StructType) and any(_holds_map(f.dataType) for f in dt.fields)


def group_key(f: T.StructField):
    """The column as a grouping key: maps become their sorted entries (or JSON, if nested)."""
    x = col(f.name)
    if isinstance(f.dataType, T.MapType) and not _holds_map(f.dataType.valueType):
        return F.sort_array(F.map_entries(x))
    return F.to_json(x) if _holds_map(f.dataType) else x


def row_digest(keys: list[str]):
    """Two 64-bit hashes of the key columns with different starts; NULL has a mark of its own, as hashes pass over it."""
    marked = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    return [F.xxhash64(F.lit(start), *marked).alias(name) for start, name in ((0, "d0"), (1, "d1"))]


def duplicate_rows(df: DataFrame, most_broadcast: int = 1_000_000) -> DataFrame:  # B3
    """Rows minus first occurrences; NULL equals NULL (groupBy semantics).

    Two phases.  Digests of 128 bits are counted first, which shuffles 24
    bytes a row instead of whole rows (and one digest per task for a set of
    copies).  Only rows whose digest repeats are then compared whole: equal
    digests prove nothing, different ones do.  Up to ``most_broadcast``
    repeated digests (16 MB) are broadcast to find these rows, more are joined.
    """
    if not df.columns:
        return df.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("duplicate_rows"))
    keyed = df.select(*[group_key(f).alias(f"k{i}") for i, f in enumerate(df.schema.fields)])
    keys = keyed.columns
    digests = keyed.select("*", *row_digest(keys))
    repeated = cut_lineage(digests.groupBy("d0", "d1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d0", "d1"))
    side = F.broadcast(repeated) if repeated.count() <= most_broadcast else repeated
    groups = digests.join(side, ["d0", "d1"], "left_semi").groupBy("d0", "d1", *keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def zero_variance(df: DataFrame) -> DataFrame:                     # B4
    return column_profile(df).where(F.col("zero_var")).select("column")


def quality_flags(df: DataFrame) -> DataFrame:                     # B5
    """``(kind, column, value)`` -- one row per flag."""
    prof = column_profile(df)
    high = prof.where(F.col("null_pct") > HIGH_NULL_PCT).select(
        F.lit("HIGH NULLS").alias("kind"), "column", F.col("null_pct").alias("value"))
    dups = duplicate_rows(df).where(F.col("duplicate_rows") > 0).select(
        F.lit("DUPLICATES").alias("kind"), F.lit(None).cast("string").alias("column"),
        F.col("duplicate_rows").cast("double").alias("value"))
    zero = prof.where(F.col("zero_var")).select(
        F.lit("ZERO VARIANCE").alias("kind"), "column", F.lit(None).cast("double").alias("value"))
    return high.unionByName(dups).unionByName(zero)


def rating_expr(n_flags):
    return (F.when(n_flags > POOR_FLAG_COUNT, "POOR").when(n_flags > 0, "FAIR").otherwise("GOOD"))


def overall_rating(df: DataFrame) -> DataFrame:                    # B6
    flags = quality_flags(df)
    return flags.agg(F.count(F.lit(1)).alias("n_flags")).select(
        "n_flags", rating_expr(F.col("n_flags")).alias("overall_quality"))


def sample_values(df: DataFrame, k: int = 5) -> DataFrame:         # B7
    """The k smallest distinct non-null values per column, as text.

    (Order-free replacement of "first k non-null values".)  One scan: every
    task keeps its k smallest distinct values of each column (Arrow batches),
    so at most k x columns rows per task reach the final ranking.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [f.name for f in df.schema.fields
             if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    if not names or not k:
        return df.sparkSession.createDataFrame([], "column string, rank int, value string")
    typed = df.select(*[typed_value(f).alias(f"c{i}") for i, f in enumerate(df.select(*map(col, names)).schema.fields)])
    slots = ("lng", "num", "str")
    out = pa.schema([("column", pa.string()), ("lng", pa.int64()), ("num", pa.float64()), ("str", pa.string())])

    def smallest(batches):
        kept = [pa.array([], pa.struct(list(out)[1:])) for _ in names]
        for b in batches:
            for i in range(len(names)):
                new = pc.drop_null(b.column(i)) if b.column(i).null_count else b.column(i)
                t = pa.Table.from_batches([pa.RecordBatch.from_struct_array(x) for x in (kept[i], new.cast(kept[i].type))])
                t = t.group_by(list(slots)).aggregate([])
                t = t.take(pc.sort_indices(t, [(s, "ascending") for s in slots])[:k])
                kept[i] = t.combine_chunks().to_struct_array().combine_chunks() if t.num_rows else kept[i]
        for n, x in zip(names, kept):
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array([n] * len(x)), *x.flatten()], schema=out)

    found = typed.mapInArrow(smallest, "column string, lng bigint, num double, str string").distinct()
    w = Window.partitionBy("column").orderBy(*slots)
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    fields = {f.name: f for f in df.schema.fields}
    text = F.coalesce(*[F.when(F.col("column") == n, value_text(fields[n])) for n in names])
    return ranked.select("column", F.col("rank").cast("int").alias("rank"), text.alias("value"))


def numeric_summary(df: DataFrame) -> DataFrame:                   # B8
    return (column_profile(df).where(F.col("family") == NUMERIC)
            .select("column", "mean", "std", F.col("vmin").alias("min"), F.col("vmax").alias("max")))


def dtype_map(df: DataFrame) -> DataFrame:                         # B9
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, dtype string")


def missing_band(df: DataFrame) -> DataFrame:                      # B10
    p = F.col("null_pct")
    return (column_profile(df).where(p > 0)
            .select("column", "null_pct",
                    F.when(p > BAND_HIGH, "high").when(p > BAND_MED, "med").otherwise("low").alias("band")))


def column_cards(types: DataFrame, df: DataFrame) -> DataFrame:   # B11
    """Type map joined with null percent; a column absent from the null table shows 0."""
    nulls = null_percent(df)
    return (types.join(nulls, "column", "left")
            .select("column", "semantic", F.coalesce(F.col("null_pct"), F.lit(0.0)).alias("null_pct")))


@dataclass(frozen=True)
class AuditFit:
    rows: int
    columns: int
    duplicate_rows: int
    null_counts: dict
    null_pct: dict
    zero_variance: list
    flags: list = field(default_factory=list)
    overall_quality: str = "GOOD"


def audit(df: DataFrame, extra=()) -> AuditFit | tuple:
    """Driver-side summary (per-column scalars only) for the pipeline report.

    ``extra`` aggregate expressions (e.g. the type probes) ride along in the
    same pass; their row is returned next to the fit."""
    structs = profile_structs(df, moments=False)
    if structs:
        row = df.agg(F.array(*structs).alias("p"), F.count(F.lit(1)).alias("__rows"), *extra).first()
        prof, rows = row["p"], row["__rows"]
    else:
        row, prof, rows = None, [], df.count()
    dups = duplicate_rows(df).first()["duplicate_rows"]
    nulls = {r["column"]: r["null_count"] for r in prof}
    pcts = {r["column"]: r["null_pct"] for r in prof}
    zero = [r["column"] for r in prof if r["zero_var"]]
    flags = [("HIGH NULLS", c, p) for c, p in pcts.items() if p is not None and p > HIGH_NULL_PCT]
    flags += [("DUPLICATES", None, dups)] if dups > 0 else []
    flags += [("ZERO VARIANCE", c, None) for c in zero]
    rating = "POOR" if len(flags) > POOR_FLAG_COUNT else "FAIR" if flags else "GOOD"
    fit = AuditFit(rows, len(df.columns), dups, nulls, pcts, zero, flags, rating)
    return (fit, row.asDict() if row is not None else {}) if extra else fit

