"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The alphabet is words: each benchmark window (``window`` consecutive words of
an item, or all of a shorter item) is a pattern.  Per pattern length a shift
table over blocks of two words tells how far the search may jump; where the
shift is zero, the bucket of patterns that end in this block is looked up by
the pattern's first word as prefix and the words are compared directly.

Defined results: NULL or empty texts have no words and no hits; items without
words have no window; items with a NULL id mark hits but are not named;
repeated items count once; documents rows are kept one for one.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_LOWER, cut_table, map_slices

#: blocks of the benchmark that are searched in one stage
BLOCKS = 4

#: words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing: digits, a-z and all bytes of other characters
_WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in ASCII_LOWER)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of pairs of word numbers."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class WuManber:
    """Search tables of one pattern length ``m`` (in words).

    Patterns are places in ``tokens``, the word numbers of all items in a row.
    The shift table is indexed by a hash of a block of two words and holds the
    smallest shift of all blocks of its slot; pattern places are sorted by a
    hash of their last block and first word, so a bucket is a range.
    """

    def __init__(self, m: int, tokens: np.ndarray, starts: np.ndarray, item_of: np.ndarray):
        self.m, self.block, self.tokens = m, min(2, m), tokens
        self.default = m - self.block + 1
        self.mask = np.uint64((1 << max(10, int(4 * len(starts)).bit_length())) - 1)
        self.shift = np.full(int(self.mask) + 1, self.default, dtype=np.uint8 if m < 256 else np.int32)
        for j in range(self.block, m + 1):              # shifts fall, so the smallest one of a slot is the last
            self.shift[self._slot(tokens, starts + j - 1)] = m - j
        keys = self._key(tokens, starts + m - 1)
        order = np.argsort(keys, kind="stable")
        self.keys, self.starts, self.item_of = keys[order], starts[order], item_of[order]

    def _block(self, ids: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed(ids[end - self.block + 1], ids[end])

    def _slot(self, ids: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self._block(ids, end) & self.mask).astype(np.int64)

    def _key(self, ids: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed(self._block(ids, end), ids[end - self.m + 1])

    def search(self, ids: np.ndarray):
        """Yields ``(start, numbers of items)`` of every occurrence; ``ids`` are word numbers, -1 for words of no item."""
        m, n = self.m, len(ids)
        if n < m:
            return
        at = np.arange(self.block - 1, n)
        jumps = np.where((ids[at] < 0) | (ids[at - self.block + 1] < 0), self.default, self.shift[self._slot(ids, at)])
        if jumps[m - self.block:].all():
            return
        jumps, end, near = [self.default] * (self.block - 1) + jumps.tolist(), m - 1, []
        while end < n:
            if jump := jumps[end]:
                end += jump
            else:
                near.append(end)
                end += 1
        keys = self._key(ids, np.array(near, dtype=np.int64)) if near else np.zeros(0, dtype=np.uint64)
        for end, lo, hi in zip(near, np.searchsorted(self.keys, keys).tolist(),
                               np.searchsorted(self.keys, keys, side="right").tolist()):
            if lo < hi:
                here = ids[end - m + 1:end + 1]
                same = (self.tokens[self.starts[lo:hi, None] + np.arange(m)] == here).all(axis=1)
                if same.any():
                    yield end - m + 1, self.item_of[lo:hi][same]


class Tables:
    """Search tables of ``(item_id, text)`` rows, one per pattern length, over numbered words."""

    def __init__(self, items: list[tuple], window: int = 10):
        self.items, self.number = [i for i, _ in items], {}
        tokens, places = [], {}
        at, number = 0, self.number
        for k, (_, text) in enumerate(items):
            words = words_of(text)
            m = min(window, len(words))
            if m:
                tokens.append(np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int32, count=len(words)))
                places.setdefault(m, []).append((at, at + len(words) - m + 1, k))
                at += len(words)
        tokens = np.concatenate(tokens) if tokens else np.zeros(0, dtype=np.int32)
        self.searches = []
        for m, some in sorted(places.items()):
            starts = np.concatenate([np.arange(a, b) for a, b, _ in some])
            self.searches.append(WuManber(m, tokens, starts, np.repeat(np.array([k for *_, k in some], dtype=np.int32),
                                                                       [b - a for a, b, _ in some])))


#: tables of the last blocks that a worker process was given; its tasks share them
_KEPT: dict[str, Tables] = {}


def kept_tables(name: str, items: list[tuple], window: int, most: int = 4) -> Tables:
    if name not in _KEPT:
        while len(_KEPT) >= most:
            del _KEPT[next(iter(_KEPT))]
        _KEPT[name] = Tables(items, window)
    return _KEPT[name]


def find_hits(text: str | None, tables: Tables) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, merged hit spans ``[start, end)`` in words, ids of items that occur."""
    words = words_of(text)
    number = tables.number
    ids = np.fromiter((number.get(w, -1) for w in words), dtype=np.int32, count=len(words))
    spans, items = [], set()
    for t in tables.searches:
        for start, found in t.search(ids):
            spans.append((start, start + t.m))
            items.update(found.tolist())
    return len(words), merge_spans(spans), {tables.items[k] for k in items}


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Number of blocks, and the blocks one after another: about ``block_bytes`` of benchmark text each, so
    that neither a broadcast nor the driver grows with the benchmark."""
    b = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull()).distinct()
    total = b.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    b = b.withColumn("k", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    return n, ([(r[0], r[1]) for r in b.where(F.col("k") == k).select("item", "text").collect()] for k in range(n))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                  block_bytes: int = 16_000_000, keep: list[str] | None = None) -> DataFrame:
    """Per document the ``keep`` columns (default: the id) and ``n_words``, ``spans`` (hit word spans),
    ``items`` (ids as strings of the items that occur); ``keep`` may not use these three names.

    The benchmark is searched block by block (``block_bytes`` of item text
    each, broadcast); every block is one more pass over the task's rows, and
    the spans and items of all blocks are merged.  ``BLOCKS`` passes make a
    stage, whose rows are written before the next, so a worker holds no more
    tables than these, some ten bytes per byte of text, whatever the
    benchmark's size.
    """
    spark = docs.sparkSession
    keep = [id_col] if keep is None else list(keep)
    df = docs.select(*keep) if text_col in keep else docs.select(*keep, text_col)
    df = df.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<struct<a:long,b:long>>"),
                         "items": F.array().cast("array<string>")})
    names = df.columns
    at, n_keep = names.index(text_col), len(names) - 3
    n_blocks, blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_bytes)
    name = uuid.uuid4().hex
    for k, block in enumerate(blocks):
        if k and k % BLOCKS == 0:
            df = cut_table(df)
        sent = spark.sparkContext.broadcast(block)
        out = [f for f in df.schema if k < n_blocks - 1 or f.name in keep or f.name in names[n_keep:]]

        def make(sent=sent, drop=len(out) < len(names), name=f"{name}-{k}"):
            tables = kept_tables(name, sent.value, window, BLOCKS)

            def f(*cols):
                rows, (_, spans, items) = cols[:n_keep], cols[n_keep:]
                found = [find_hits(t, tables) for t in cols[at]]
                rows = [c for i, c in enumerate(rows) if not (drop and i == at)]
                return (*rows, [x[0] for x in found],
                        [[{"a": a, "b": b} for a, b in merge_spans([(s["a"], s["b"]) for s in old] + x[1])]
                         for x, old in zip(found, spans)],
                        [sorted({*old, *(i for i in x[2] if i is not None)}) for x, old in zip(found, items)])
            return f

        df = map_slices(df, make, T.StructType(out))
    return df


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from ``contamination``'s rows."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["b"] - x["a"]))
    return found.select(
        F.col(id_col), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))
