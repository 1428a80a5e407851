"""SimHash near-duplicates: fingerprints, pigeonring candidates, components.

A 64-bit fingerprint is cut into a ring of ``m`` segments.  If two
fingerprints differ in at most ``t`` bits, some start segment exists from
which every chain of l consecutive segments holds at most floor(l * t / m)
differing bits (the pigeonring principle).  Where that budget is 0 the
segments must be equal, where it is 1 one half of the following segments must
be: both give the join key of a start.  Within a key the full chain condition
is tested from short to long chains; its last step is the Hamming check.

Links are found between distinct fingerprints only, so copies never form
pairs; per key only a spanning forest of the links leaves the task.  Keys with
more than ``hot_rows`` fingerprints are extended by more equal bits (four
blocks of which at least one must be equal for t <= 3; t + 1 blocks in
general) before they are searched, so no task holds a group without bound.

Defined results: NULL, empty and wordless texts have fingerprint zero and are
linked like any other; rows are kept one for one; NULL ids never name a
component unless the whole component has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, cut, cut_table, map_slices, with_fields

SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text as an unsigned 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    rows = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    h = np.fromiter((digest(b" ".join(r), SEED) for r in rows), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        part = np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3, keep=("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``fingerprint`` (long) and ``row_id``, written once so that row ids stay."""
    keep = list(keep)
    df = docs.select(*keep) if text_col in keep else docs.select(*keep, text_col)
    at = df.columns.index(text_col)

    def make():
        def f(*cols):
            rest = cols if text_col in keep else cols[:-1]
            return *rest, np.array([fingerprint(t, shingle) for t in cols[at]], dtype=np.uint64).view(np.int64).tolist()
        return f

    out = map_slices(df, make, with_fields(docs.select(*keep).schema.fields, "fingerprint bigint"))
    return cut_table(out.withColumn("row_id", F.monotonically_increasing_id()))


# --------------------------------------------------------------------------
# candidates
# --------------------------------------------------------------------------

def ring_layout(distance: int, segments: int) -> tuple[int, int, int]:
    """``(bits of a segment, segments of a start that must be equal, segments with budget 1 after them)``."""
    width = 64 // segments
    budget = [length * distance // segments for length in range(1, segments + 1)]
    equal = sum(b == 0 for b in budget)
    return width, equal, sum(b == 1 for b in budget)


def _rotated(fp: Column, by: int) -> Column:
    return fp if by == 0 else F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, 64 - by))


def ring_keys(fps: DataFrame, distance: int, segments: int = 8) -> DataFrame:
    """``(start, key, fingerprint)``: fingerprints that may link share a key."""
    width, equal, one = ring_layout(distance, segments)
    if not equal:
        raise ValueError("too many bits for this number of segments")
    fp, entries = F.col("fingerprint"), []
    half = one * width // 2
    for start in range(segments):
        rot = _rotated(fp, start * width)
        low = rot.bitwiseAND(F.lit((1 << equal * width) - 1))
        for side in range(2 if half else 1):
            bits = one * width - half if side else half
            more = F.shiftrightunsigned(rot, equal * width + side * half).bitwiseAND(F.lit((1 << bits) - 1))
            entries.append(F.struct(F.lit(start).alias("start"), F.xxhash64(F.lit(start), F.lit(side), low, more).alias("key")))
    return fps.select("fingerprint", F.inline(F.array(*entries)))


def _block_masks(level: int, blocks: int) -> list[int]:
    """Bits 0..63 dealt to blocks: contiguous, by remainder, by remainder of quotient."""
    of = [lambda b: b * blocks // 64, lambda b: b % blocks, lambda b: b // blocks % blocks][level]
    masks = [sum(1 << b for b in range(64) if of(b) == k) for k in range(blocks)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def extend_hot_keys(keys: DataFrame, distance: int, hot_rows: int) -> DataFrame:
    """Rows of keys with more than ``hot_rows`` fingerprints get longer keys; no pair within the distance is lost."""
    for level in range(3):
        hot = cut(keys.groupBy("key").count().where(F.col("count") > hot_rows).select("key"))
        if hot.isEmpty():
            break
        masks = _block_masks(level, distance + 1)
        longer = F.explode(F.array(*[F.xxhash64("key", F.lit(k), F.col("fingerprint").bitwiseAND(F.lit(m)))
                                     for k, m in enumerate(masks)]))
        keys = keys.join(hot, "key", "left_anti").unionByName(
            keys.join(hot, "key", "left_semi").select("start", "fingerprint", longer.alias("key")))
    return keys


def _linked(x: np.ndarray, start: int, distance: int, segments: int) -> np.ndarray:
    """Chain condition of differences ``x`` from segment ``start``, short chains first."""
    width = 64 // segments
    by = np.uint64(start * width)
    rot = (x >> by) | (x << (np.uint64(64) - by)) if start else x
    alive = np.arange(len(rot))
    for length in range(1, segments + 1):
        mask = np.uint64((1 << length * width) - 1)
        ok = np.bitwise_count(rot[alive] & mask) <= length * distance // segments
        alive = alive[ok]
        if not len(alive):
            break
    return alive


def _forest(fps: np.ndarray, start: int, distance: int, segments: int):
    """Spanning forest of the links among distinct ``fps`` of one key."""
    left, edges = fps, []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            u = frontier.pop()
            near = _linked(left ^ u, start, distance, segments)
            if len(near):
                found = left[near]
                edges += [(u, v) for v in found]
                frontier += list(found)
                left = np.delete(left, near)
    return edges


def links(fps: DataFrame, distance: int = 3, segments: int = 8, hot_rows: int = 20_000) -> DataFrame:
    """``(a, b)``: enough links among distinct ``fingerprint`` values to connect all that are linked."""
    keys = extend_hot_keys(ring_keys(fps, distance, segments), distance, hot_rows)
    dealt = keys.select("key", "start", "fingerprint").repartition("key").sortWithinPartitions("key", "start", "fingerprint")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def batch(a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, dtype=np.uint64).view(np.int64)) for x in (a, b)], schema=schema)

    def search(batches):
        rest = None                                  # the last key's rows so far
        for rb in _with_end(batches):
            if rb is not None and not rb.num_rows:
                continue
            if rb is None:
                if rest is None:
                    return
                key, start, fp, last = *rest, True
            else:
                key, start = (np.asarray(c) for c in rb.columns[:2])
                fp = np.asarray(rb.columns[2]).view(np.uint64)
                if rest is not None:
                    key, start, fp = (np.concatenate(x) for x in zip(rest, (key, start, fp)))
                last = False
            change = (key[1:] != key[:-1]) | (start[1:] != start[:-1])
            bounds = np.concatenate([[0], np.flatnonzero(change) + 1, [len(key)]])
            if not last:                             # keep the open run for the next batch
                cut_at = bounds[-2]
                rest = key[cut_at:], start[cut_at:], fp[cut_at:]
                bounds = bounds[:-1]
            sizes = np.diff(bounds)
            two = bounds[:-1][sizes == 2]
            a, b = [], []
            for s in np.unique(start[two]):
                at = two[start[two] == s]
                ok = _linked(fp[at] ^ fp[at + 1], int(s), distance, segments)
                a += list(fp[at[ok]])
                b += list(fp[at[ok] + 1])
            for k in np.flatnonzero(sizes > 2):
                lo, hi = bounds[k], bounds[k + 1]
                for u, v in _forest(fp[lo:hi], int(start[lo]), distance, segments):
                    a.append(u)
                    b.append(v)
            if a:
                yield batch(a, b)
            if last:
                return

    return dealt.mapInArrow(search, "a bigint, b bigint").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _with_end(batches):
    yield from batches
    yield None


# --------------------------------------------------------------------------
# components
# --------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``: root is the smallest node reachable.

    Alternating large and small stars: every round is a minimum per node and a
    join, so a hub with any number of neighbours is summed before the shuffle;
    lineage is cut every round.
    """
    edges = cut(edges.where("a <> b").distinct())
    before = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = cut(small.select(F.col("v").alias("b"), F.col("m").alias("a")).unionByName(
            low.select(F.col("u").alias("b"), F.col("m").alias("a"))).where("a <> b").select("a", "b").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def group_near_duplicates(table: DataFrame, id_col: str = "doc_id", distance: int = 3, segments: int = 8,
                          hot_rows: int = 20_000) -> DataFrame:
    """``table`` (of ``with_fingerprints``) with ``root`` (the group's smallest fingerprint) and ``component_id``."""
    fps = cut(table.groupBy("fingerprint").agg(F.min(id_col).alias("first_id")))
    roots = components(links(fps.select("fingerprint"), distance, segments, hot_rows))
    named = fps.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    named = cut(named)
    # written, so that both sides of the join are dealt anew and a large group's root can be split
    smallest = cut(named.groupBy("root").agg(F.min("first_id").alias("component_id")))
    labels = cut(named.select("fingerprint", "root").join(smallest, "root"))
    return table.join(labels, "fingerprint", "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every document; the fingerprint as 16 lowercase hex digits."""
    grouped = group_near_duplicates(with_fingerprints(docs, text_col, shingle, (id_col,)), id_col, distance)
    return grouped.select(id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             distance: int = 3) -> DataFrame:
    """The rows of ``docs`` with one row of each group: its smallest id, the first row of that id."""
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]            # columns may be called like those added here
    table = with_fingerprints(docs.toDF(*inner), inner[names.index(text_col)], shingle, inner)
    key = inner[names.index(id_col)]
    grouped = group_near_duplicates(table.select(key, "fingerprint", "row_id"), key, distance)
    best = grouped.groupBy("root").agg(F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("i"), "row_id")).alias("m"))
    kept = table.join(best.select(F.col("m.row_id").alias("row_id")), "row_id", "left_semi")
    return kept.select(*inner).toDF(*names)
