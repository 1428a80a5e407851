"""Hard-negative mining by angular triangle filtering.

Vectors become whole numbers, ``floor(scale * x)``, and are stored once with
their norm and their angles to a few reference directions.  For an anchor a
and a row v the triangle inequality on the sphere bounds their angle from both
sides by every reference r::

    |angle(a, r) - angle(v, r)| <= angle(a, v) <= angle(a, r) + angle(v, r)

so the cosine lies in an interval, which both norms turn into bounds on the
inner product.  Only rows whose bounds reach a score window that still lacks a
row get their exact integer product.  First pass: the best ``positives`` rows
of an anchor's own label.  Second pass: for each positive the best
``negatives`` rows of other labels inside the window of scores that the
positive's score opens.

Anchors are a stated query set.  They are taken in blocks of bounded size, and
each block is one broadcast against a scan of all stored rows; a task keeps
the few best rows per anchor, so its memory is a block and one slice of rows.
The reference directions come from a bounded sample of rows; they only decide
how much is skipped.

Rounding: an angle is off by at most ``sqrt(2 (d + 8) 2^-52)`` plus the error
of its stored 32-bit form; this and the error of 32-bit products is added to
every bound, so no row inside a window is skipped.

Defined results: rows with a NULL id, label, vector or component, or with a
component that is not finite (or beyond 1e100 in size), take no part.  Vectors of different lengths are
compared as if the shorter went on with zeros; empty and zero vectors score 0.
An anchor with fewer candidates gets all of them, a positive without a
negative gets no row.  Equal rows of the table are one anchor but each a
candidate; rows with the anchor's own id are not its positives.  Scores beyond
64 bits are worked out exactly and reported as the nearest 64-bit number.  An
empty table gives no rows.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import cut_table

STORED = "vec_id long, label long, q array<double>, norm double, angles array<float>"
#: fixed values of the windows: a negative's score is 50 to 95 hundredths of the positive's
LOW, HIGH = 50, 95
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def usable(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """``(vec_id, label, q)`` of the rows that take part; ``q`` are whole numbers."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e100))
    # floor() of a double is a long in SQL and would saturate, so the fraction is taken off instead
    down = lambda x: F.when(F.abs(x) < 2.0 ** 52, F.floor(x).cast("double")).otherwise(x)
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(finite) \
        .select("vec_id", "label", F.transform("v", lambda x: down(x * float(scale))).alias("q"))


def matrix(vectors, width: int | None = None) -> np.ndarray:
    """Rows of a list-of-double Arrow column as a matrix, shorter ones filled with zeros."""
    v = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    size = np.diff(np.asarray(v.offsets, dtype=np.int64))
    flat = np.asarray(v.flatten(), dtype=np.float64)
    width = max(int(size.max(initial=0)), width or 0)
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def widen(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: floats while every partial sum is a whole number below 2^53, else Python integers."""
    width = max(a.shape[1], b.shape[1])
    a, b = widen(a, width), widen(b, width)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) < 2.0 ** 53:
        return a @ b.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(a) @ whole(b).T


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def unit(x: np.ndarray) -> np.ndarray:
    n = norms(x)
    return x / np.where(n > 0, n, 1.0)[:, None]


def reference_directions(sample: np.ndarray, references: int, rounds: int = 8) -> np.ndarray:
    """Unit directions: spherical k-means of the sample from starts that lie far apart."""
    x = unit(sample[norms(sample) > 0])
    if not len(x):
        return np.zeros((0, sample.shape[1]))
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(references, len(x)) and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    centre = x[chosen]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre = np.where(norms(total)[:, None] > 0, unit(total), centre)
    return centre


def store(rows: DataFrame, centre: np.ndarray) -> DataFrame:
    """``rows`` with norms and angles, written once."""
    def run(batches):
        for b in batches:
            x = matrix(b.column("q"))
            with np.errstate(over="ignore"):
                n = norms(x)
                u, c = unit(x), widen(centre, x.shape[1])
            angles = np.arccos(np.clip(widen(u, c.shape[1]) @ c.T, -1, 1)).astype(np.float32)
            flat = pa.array(angles.ravel())
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * angles.shape[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n), pa.ListArray.from_arrays(at, flat)],
                                             names=["vec_id", "label", "q", "norm", "angles"])
    return cut_table(rows.mapInArrow(run, STORED))


class Side:
    """Vectors of one side in the form the bounds need."""

    def __init__(self, table: pa.Table):
        self.ids, self.labels = (np.asarray(table.column(c), dtype=np.int64) for c in ("vec_id", "label"))
        self.q = matrix(table.column("q"))
        self.norm = np.asarray(table.column("norm"))
        angles = matrix(table.column("angles"))
        self.cos, self.sin = (f(angles).astype(np.float32).T.copy() for f in (np.cos, np.sin))

    def __len__(self):
        return len(self.ids)


def bounds(anchors: Side, part: slice, rows: Side, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which (anchor, row) pairs can have a product between ``least`` and ``most`` of the anchor (floats)."""
    norm = anchors.norm[part]
    if not len(anchors.cos):
        return np.ones((len(norm), len(rows)), dtype=bool)
    low = high = None
    for ca, sa, cv, sv in zip(anchors.cos[:, part], anchors.sin[:, part], rows.cos, rows.sin):
        p, q = np.multiply.outer(ca, cv), np.multiply.outer(sa, sv)
        high = p + q if high is None else np.minimum(high, p + q, out=high)
        low = p - q if low is None else np.maximum(low, p - q, out=low)
    width = max(anchors.q.shape[1], rows.q.shape[1])
    slack = np.float32(2 * (np.sqrt(2 * (width + 8) * 2.0 ** -52) + 4e-7) + 2e-6)
    # cosines are compared with score / norms; the quotients are moved outwards by more than their rounding
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        scale = norm[:, None] * rows.norm
        under = (least[:, None] - 1) / scale
        over = (most[:, None] + 1) / scale
        return ~((high + slack < under) | (low - slack > over)) | ~(scale > 0)


def outward(whole: int, end: float) -> float:
    """``whole`` as a float, moved towards ``end`` where floats round it."""
    return float(whole) if abs(whole) < 1 << 53 else float(np.nextafter(float(whole), end))


class Best:
    """The ``k`` best (score, smallest id) of each of ``n`` lists."""

    def __init__(self, n: int, k: int):
        self.k, self.lists, self.last = k, [[] for _ in range(n)], np.full(n, -np.inf)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """``scores`` and ``allowed`` have a row for each list in ``at``."""
        if not allowed.any():
            return
        allowed = allowed & (scores >= self.last[at][:, None])
        if scores.dtype != object and np.count_nonzero(allowed) > 8 * self.k * len(at):
            held = np.where(allowed, scores, -np.inf)
            if held.shape[1] > self.k:
                allowed &= held >= np.partition(held, -self.k, axis=1)[:, -self.k, None]
        rows, cols = np.nonzero(allowed)
        for i, s, v in zip(rows.tolist(), scores[rows, cols].tolist(), ids[cols].tolist()):
            self.lists[at[i]].append((-int(s), v))
        for i in np.unique(rows).tolist():
            one = self.lists[at[i]]
            one.sort()
            del one[self.k:]
            if len(one) == self.k:
                self.last[at[i]] = outward(-one[-1][0], -np.inf)


def _tables(batches, rows: int):
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            whole = pa.Table.from_batches(held)
            for at in range(0, len(whole), rows):
                yield whole.slice(at, rows)
            held, n = [], 0
    if n:
        yield from (pa.Table.from_batches(held).slice(at, rows) for at in range(0, n, rows))


def _clip(score: int) -> int:
    return min(max(score, LEAST), MOST)


def _search(stored: DataFrame, shared, k: int, windows: bool, tile: int = 256, slice_rows: int = 4096) -> DataFrame:
    """``(list, score, text, vec_id)``: the ``k`` best rows of each list, per task.

    ``shared`` broadcasts ``(anchors, scores)``.  Without ``windows`` an anchor
    has one list, of its own label; with them one per positive score, of other
    labels.
    """
    def run(batches):
        table, positive = shared.value
        anchors = Side(table)
        per = max((len(p) for p in positive), default=0) if windows else 1
        best = Best(len(anchors) * per, k)
        low = np.full((len(anchors), per), -np.inf)
        high = np.full((len(anchors), per), np.inf)
        exact = [[] for _ in range(len(anchors))]
        if windows:
            low[:], high[:] = np.inf, -np.inf
            for i, scores in enumerate(positive):
                for j, s in enumerate(scores):
                    least, most = -(-LOW * s // 100), HIGH * s // 100
                    exact[i].append((least, most))
                    if least <= most:
                        low[i, j], high[i, j] = outward(least, -np.inf), outward(most, np.inf)
        for t in _tables(batches, slice_rows):
            rows = Side(t)
            for at in range(0, len(anchors), tile):
                part = slice(at, min(at + tile, len(anchors)))
                # a full list wants only rows at its last score or above
                lists = np.arange(part.start * per, part.stop * per).reshape(-1, per)
                wanted = np.maximum(low[part], best.last[lists])
                same = anchors.labels[part, None] == rows.labels
                allowed = same & (anchors.ids[part, None] != rows.ids) if not windows else ~same
                open_ = wanted <= high[part]
                allowed &= bounds(anchors, part, rows, np.where(open_, wanted, np.inf).min(axis=1, initial=np.inf),
                                  np.where(open_, high[part], -np.inf).max(axis=1, initial=-np.inf))
                some = np.flatnonzero(allowed.any(axis=0))
                if not len(some):
                    continue
                scores = products(anchors.q[part], rows.q[some])
                allowed, ids = allowed[:, some], rows.ids[some]
                if not windows:
                    best.add(lists[:, 0], scores, ids, allowed)
                    continue
                for j in range(per):
                    if scores.dtype == object:
                        ends = [exact[i][j] if j < len(exact[i]) else (1, 0) for i in range(part.start, part.stop)]
                        least, most = (np.array(e, dtype=object)[:, None] for e in zip(*ends))
                    else:
                        least, most = low[part, j, None], high[part, j, None]
                    best.add(lists[:, j], scores, ids, allowed & (scores >= least) & (scores <= most))
        found = [(i, _clip(-s), None if LEAST < -s < MOST else str(-s), v)
                 for i, one in enumerate(best.lists) for s, v in one]
        for at in range(0, len(found), 10_000):
            cols = list(zip(*found[at:at + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.int64(), pa.string(), pa.int64()))], names=["list", "score", "exact", "vec_id"])

    tasks = stored.mapInArrow(run, "list long, score long, exact string, vec_id long")
    # tasks' lists are short; Spark keeps the first k of each before and after the shuffle.  Digits of numbers beyond
    # 64 bits order those that share a clipped score.
    number = F.expr("""row_number() OVER (PARTITION BY list ORDER BY score DESC,
        if(score > 0, 1, -1) * length(exact) DESC, if(score > 0, exact, NULL) DESC, exact, vec_id)""")
    return tasks.withColumn("rank", number).where(F.col("rank") <= k)


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label: Column | None = None, scale: int = 256, positives: int = 5, negatives: int = 3,
         references: int = 8, sample_rows: int = 4096, block_bytes: int = 32_000_000) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the id column; ``label`` defaults to the
    column ``label``.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col, F.col("label") if label is None else label, scale)
    some = rows.select("q").orderBy(F.xxhash64("vec_id", "q")).limit(sample_rows).toArrow()
    sample = matrix(some.column("q"))
    stored = store(rows, reference_directions(sample, references))
    queries = stored.where(F.coalesce(is_anchor, F.lit(False))).dropDuplicates(["vec_id", "label", "q"])
    size = queries.select(F.sum(F.size("q") + 16).cast("long")).first()[0] or 0
    blocks = max(1, -(-8 * size // block_bytes))
    queries = cut_table(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks)))
                        .repartition(blocks, "block").sortWithinPartitions("block"))
    path = os.path.join(ensure_checkpoint_dir(spark), f"negatives-{uuid.uuid4().hex}")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    written = False
    for b in range(blocks):
        anchors = queries.where(F.col("block") == b).drop("block").sort("vec_id", "label", "q").toArrow()
        shared = spark.sparkContext.broadcast((anchors, None))
        found = _search(stored, shared, positives, False).sort("list", "rank").collect()   # anchors x positives
        shared.destroy()
        scores, ids = [[] for _ in range(len(anchors))], [[] for _ in range(len(anchors))]
        for r in found:
            scores[r["list"]].append(int(r["exact"] or r["score"]))
            ids[r["list"]].append(r["vec_id"])
        per = max(map(len, scores), default=0)
        if not per:
            continue
        own = anchors.column("vec_id").to_pylist()
        pairs = [(i * per + j, own[i], v, _clip(s)) for i in range(len(own))
                 for j, (v, s) in enumerate(zip(ids[i], scores[i]))]
        pairs = spark.createDataFrame(pa.Table.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*pairs)], names=["list", "anchor_id", "positive_id", "positive_score"]))
        shared = spark.sparkContext.broadcast((anchors, scores))
        _search(stored, shared, negatives, True).join(F.broadcast(pairs), "list").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
        shared.destroy()
        written = True
    return spark.read.schema(schema).parquet(path) if written else spark.createDataFrame([], schema)
