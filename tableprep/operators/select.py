"""Feature selection (stage "select", G1-G5).

All pairs of k numeric columns come from one pass: every task turns its Arrow
batches into k x k matrices of pairwise-complete sums (numpy cross-products),
and one group-by adds the matrices up.  What reaches the driver is k x k
entries, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, numeric_columns

# Fixed values of the selection rules.
VARIANCE_THRESHOLD = 0.01
CORRELATION_THRESHOLD = 0.95


def variances(df: DataFrame, cols) -> dict:                                          # G1
    if not cols:
        return {}
    row = df.agg(*[F.var_samp(col(c)) for c in cols]).first()
    return dict(zip(cols, row))


@dataclass(frozen=True)
class Moments:
    """k x k matrices over the rows where columns i and j are both set, values shifted by ``centers``:
    ``n`` rows, ``s`` sums of i, ``q`` sums of i squared, ``p`` sums of products, ``low`` and ``high`` of i."""
    cols: list
    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    p: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def varies(self) -> np.ndarray:
        """Whether i has two values on the pair's rows (exactly, not by a variance near 0)."""
        return self.low < self.high

    def variances(self) -> dict:
        d = np.arange(len(self.cols))
        n, s, q = self.n[d, d], self.s[d, d], self.q[d, d]
        out = {}
        for i, c in enumerate(self.cols):
            flat = not self.varies()[i, i]
            out[c] = None if n[i] < 2 else 0.0 if flat else max(q[i] - s[i] ** 2 / n[i], 0.0) / (n[i] - 1)
        return out

    def correlations(self) -> list[tuple[str, str, float | None]]:
        """Upper triangle ``(a, b, r)``; r is None where a side is constant."""
        with np.errstate(all="ignore"):
            cov = self.p - self.s * self.s.T / self.n
            v = self.q - self.s ** 2 / self.n
            r = cov / np.sqrt(v * v.T)
        ok = self.varies() & self.varies().T & (v > 0) & (v.T > 0) & (self.n > 0)
        return [(self.cols[i], self.cols[j], float(r[i, j]) if ok[i, j] else None)
                for j in range(len(self.cols)) for i in range(j)]


def pair_moments(df: DataFrame, cols, centers: dict) -> Moments:
    """Moments of all pairs of ``cols`` in one pass; ``centers`` near the means keep the sums exact."""
    cols, k = list(cols), len(cols)
    z = df.select(*[F.nanvl(col(c).cast("double") - F.lit(float(centers.get(c) or 0.0)), F.lit(None)).alias(f"z{i}")
                    for i, c in enumerate(cols)])
    schema = "i int, j int, n double, s double, q double, p double, low double, high double"
    arrow = pa.schema([("i", pa.int32()), ("j", pa.int32())] + [(x, pa.float64()) for x in ("n", "s", "q", "p", "low", "high")])

    def sums(batches):
        n, s, q, p = (np.zeros((k, k)) for _ in range(4))
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])
            there = ~np.isnan(x)
            m, x0 = there.astype(float), np.where(there, x, 0.0)
            n += m.T @ m
            s += x0.T @ m
            q += (x0 * x0).T @ m
            p += x0.T @ x0
            lo, hi = np.where(there, x, np.inf), np.where(there, x, -np.inf)
            low_all, high_all = lo.min(axis=0), hi.max(axis=0)
            full = there.all(axis=0)
            low[:, full] = np.minimum(low[:, full], low_all[:, None])
            high[:, full] = np.maximum(high[:, full], high_all[:, None])
            for j in np.flatnonzero(~full):                     # rows where column j is set
                rows = there[:, j]
                if rows.any():
                    low[:, j] = np.minimum(low[:, j], lo[rows].min(axis=0))
                    high[:, j] = np.maximum(high[:, j], hi[rows].max(axis=0))
        i, j = np.indices((k, k), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(a.ravel()) for a in (i, j, n, s, q, p, low, high)], schema=arrow)

    rows = z.mapInArrow(sums, schema).groupBy("i", "j").agg(
        *[F.sum(x).alias(x) for x in ("n", "s", "q", "p")], F.min("low").alias("low"), F.max("high").alias("high")).collect()
    out = [np.zeros((k, k)) for _ in range(4)] + [np.full((k, k), np.inf), np.full((k, k), -np.inf)]
    for r in rows:
        for m, v in zip(out, r[2:]):
            m[r["i"], r["j"]] = v
    return Moments(cols, *out)


def column_means(df: DataFrame, cols) -> dict:
    row = df.agg(*[F.avg(F.nanvl(col(c).cast("double"), F.lit(None))) for c in cols]).first()
    return {c: row[i] or 0.0 for i, c in enumerate(cols)}


def correlation_table(df: DataFrame, cols=None) -> DataFrame:
    """Upper-triangle ``(a, b, r)``, pairwise-complete, NULL for a constant side.

    Two passes: the column means, then the pair moments centred by them."""
    cols = numeric_columns(df) if cols is None else list(cols)
    pairs = pair_moments(df, cols, column_means(df, cols)).correlations() if len(cols) > 1 else []
    return df.sparkSession.createDataFrame(pairs, "a string, b string, r double")


def high_corr_drops(pairs, threshold=CORRELATION_THRESHOLD) -> list[str]:            # G3
    """Drop column b when any EARLIER column a has |r| > threshold (even if a
    itself is dropped); NULL r never drops."""
    drop = []
    for a, b, r in pairs:
        if r is not None and abs(r) > threshold and b not in drop:
            drop.append(b)
    return drop


@dataclass(frozen=True)
class SelectFit:
    target: str | None
    low_variance: list
    high_correlation: list
    kept: list
    removed: list


def fit_select(df: DataFrame, target: str | None = None, variance_threshold: float = VARIANCE_THRESHOLD,
               correlation_threshold: float = CORRELATION_THRESHOLD, strict_target: bool = True,
               centers: dict | None = None) -> SelectFit:
    """``centers`` (column -> a value near its mean, e.g. IQR midpoints) save the
    pass that finds the means; variances and correlations share one pass."""
    if target is not None and target not in df.columns:
        if strict_target:
            raise ValueError(f"target column {target!r} not in table")
        target = None
    nums = numeric_columns(df, exclude=(target,) if target else ())
    if not nums:
        return _decide(df, target, nums, [], [], [], correlation_threshold)
    moments = pair_moments(df, nums, column_means(df, nums) if centers is None else centers)
    var = moments.variances()
    low = [c for c in nums if var[c] is not None and var[c] < variance_threshold]
    rest = [c for c in nums if c not in low]
    keep = set(rest)
    pairs = [p for p in moments.correlations() if p[0] in keep and p[1] in keep]
    return _decide(df, target, nums, low, rest, pairs, correlation_threshold)


def _decide(df, target, nums, low, rest, pairs, correlation_threshold) -> SelectFit:
    order = {c: i for i, c in enumerate(rest)}
    pairs = sorted(pairs, key=lambda p: (order[p[1]], order[p[0]]))
    high = [c for c in rest if c in set(high_corr_drops(pairs, correlation_threshold))]
    kept = [c for c in df.columns if c not in low and c not in high and c != target]
    removed = [(c, "low variance") for c in low] + [(c, "high correlation") for c in high]
    return SelectFit(target, low, high, kept, removed)


def apply_select(df: DataFrame, fit: SelectFit) -> DataFrame:                       # G4
    """Kept columns in order, the target re-attached LAST."""
    cols = list(fit.kept) + ([fit.target] if fit.target else [])
    return df.select(*[col(c) for c in cols])
