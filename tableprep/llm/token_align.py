"""Alignment of two tokenizers by whitespace-token anchors.

Every text is tokenised whole by a byte-level BPE (A) and a sentence-piece
model (B).  Both token rows spell the same bytes, so an offset where a
space-marked token starts in both is a verified shared end of the tokens
before it.  These anchors split a document into windows of token ids; what a
window's groups and links are depends on its ids alone, so it is worked out
once per pair of id tuples among the windows of a slice of documents (about a
thousand, less where they are long) and remembered for all that are equal.

Inside a window the offsets where A and B tokens both end cut the tokens into
groups, and the two tokens that end there are linked.  How often an (A id, B
id) pair is linked is counted over all documents.  Links of the most frequent
pairs, a list of bounded length, are looked up in a broadcast; links of all
others travel as (document, pair, times) rows and are joined with the counts.
The list only decides which way a link goes.

Defined results: NULL and empty texts, and texts whose tokens do not spell
space + text (a text with U+2581, say), have no tokens: zeros and an empty
digest.  Rows are kept one for one, also repeated ids and NULL ids; an empty
table gives no rows.  Texts are never cut; a text without spaces is one
window, which is not remembered beyond ``memo_tokens`` tokens.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import byte_alphabet, cut_table, map_slices, with_fields

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: fixed value: the word pattern of byte-level vocabularies
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FIGURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class Aligner:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        with open(path_a, encoding="utf-8") as f:
            given = json.load(f)
        # ids of a byte-level vocabulary are in the order of its merges, so they are the merges' ranks; the added
        # tokens are left out, which makes their strings plain text
        added = {t["content"] for t in given["added_tokens"]}
        of = byte_alphabet()
        ranks = {bytes(map(of.get, t)): i for t, i in given["model"]["vocab"].items() if t not in added}
        self.a = tiktoken.Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.path_a, self.slow_a = path_a, None
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.size_a, self.size_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.space_a, self.space_b = (np.array([x[:1] == b" " for x in t]) for t in (self.bytes_a, self.bytes_b))
        random = np.random.default_rng(0)       # for hashes that only gather equal windows
        self.mix, self.odd = random.integers(0, 1 << 64, 2 * 65536, dtype=np.uint64), random.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
        digits = [f"{i}," for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.digits = np.frombuffer("".join(digits).encode(), dtype=np.uint8)
        self.digit_ends = np.cumsum([0, *map(len, digits)])

    def tokenize_a(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.a.encode_to_numpy(text, disallowed_special=()), dtype="<u4")
        except ValueError:                      # its expressions run out of stack on millions of blanks in a row
            if self.slow_a is None:
                from tokenizers import Tokenizer
                self.slow_a = Tokenizer.from_file(self.path_a)
                self.slow_a.encode_special_tokens = True
            return np.array(self.slow_a.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def tokenize(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        return [self.tokenize_a(" " + t) for t in texts], [np.array(e, dtype="<u4") for e in self.b.encode(texts, num_threads=1)]

    def spells(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether the tokens' bytes are space + text; A's merges start from these bytes, so their number tells."""
        raw = (" " + text).encode()
        return (int(self.size_a[a].sum()) == len(raw)
                and b"".join(map(self.bytes_b.__getitem__, b.tolist())) == raw)

    def align_windows(self, a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[list, list]:
        """Groups as text and links as 64-bit pairs of windows in a row, which end before ``stop_``.

        A group ends at every shared end.
        """
        # both sides of a window have the same bytes, so ends may be counted on over all windows
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[at] == ends_a)
        last_b = at[last_a]
        of_a, of_b = (np.searchsorted(last, np.arange(len(x))) for last, x in ((last_a, a), (last_b, b)))     # groups
        # a group's A tokens, then its B tokens, each followed by its separator
        place_a, place_b = np.arange(len(a)) + np.append(0, last_b + 1)[of_a], np.arange(len(b)) + last_a[of_b] + 1
        ids, after = np.empty(len(a) + len(b), dtype=np.int64), np.full(len(a) + len(b), ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = a, b
        after[place_a[last_a]], after[place_b[last_b]] = ord("|"), ord(";")
        size = self.digit_ends[ids + 1] - self.digit_ends[ids]
        ends = np.cumsum(size)
        text = self.digits[np.repeat(self.digit_ends[ids] - ends + size, size) + np.arange(ends[-1])]
        text[ends - 1] = after
        text, links = text.tobytes(), ((a[last_a].astype("<i8") << 32) | b[last_b]).tobytes()
        groups = (8 * (of_a[stop_a - 1] + 1)).tolist()
        texts = ends[stop_a + stop_b - 1].tolist()
        return ([text[s:e - 1] for s, e in zip([0, *texts], texts)], [links[g:h] for g, h in zip([0, *groups], groups)])

    def windows(self, a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray):
        """Aligned windows of documents in a row (each starts at ``first_``).

        ``(found, of, first)``: the alignment of every kind of window, each worked out once, every window's kind, and
        every document's first window.
        """
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        mark_a, mark_b = self.space_a[a], self.space_b[b]
        mark_a[first_a], mark_b[first_b] = True, True
        at_a, at_b = np.flatnonzero(mark_a), np.flatnonzero(mark_b)
        start_a, start_b = ends_a[at_a] - self.size_a[a[at_a]], ends_b[at_b] - self.size_b[b[at_b]]
        anchors, i, j = np.intersect1d(start_a, start_b, assume_unique=True, return_indices=True)
        cut_a, cut_b = np.append(at_a[i], len(a)), np.append(at_b[j], len(b))
        one, of = self.equal_windows(a, cut_a, b, cut_b)
        kinds = [(c[:-1][one], np.diff(c)[one]) for c in (cut_a, cut_b)]
        stops = [np.cumsum(n) for _, n in kinds]
        tokens = [x[np.repeat(first - stop + n, n) + np.arange(stop[-1])] for x, (first, n), stop in zip((a, b), kinds, stops)]
        return self.align_windows(*tokens, *stops), of, np.searchsorted(anchors, ends_a[first_a] - self.size_a[a[first_a]])

    def equal_windows(self, a: np.ndarray, cut_a: np.ndarray, b: np.ndarray, cut_b: np.ndarray):
        """``(one, of)``: the number of one window of each kind, and every window's kind by its place in ``one``.

        Windows are told apart by a 64-bit hash, and then every token is compared with that of its kind's window.
        """
        sizes, starts = [np.diff(c) for c in (cut_a, cut_b)], [c[:-1] for c in (cut_a, cut_b)]
        place = [np.arange(len(x)) - np.repeat(s, n) for x, s, n in zip((a, b), starts, sizes)]
        mixed = [self.mix[x + 65536 * side] * self.odd[np.minimum(p, len(self.odd) - 1)]
                 for side, (x, p) in enumerate(zip((a, b), place))]
        _, one, of = np.unique(np.add.reduceat(mixed[0], starts[0]) + np.add.reduceat(mixed[1], starts[1]),
                               return_index=True, return_inverse=True)
        same = (sizes[0] == sizes[0][one[of]]) & (sizes[1] == sizes[1][one[of]])
        if same.all():
            same = all((x == x[np.repeat(s[one[of]], n) + p]).all() for x, s, n, p in zip((a, b), starts, sizes, place))
        if not np.all(same):                    # two kinds share a hash: every window for itself
            one = of = np.arange(len(starts[0]))
        return one, of

    def align(self, texts: list[str | None]) -> list[tuple | None]:
        """``(n_a, n_b, groups as text, links)`` of each text, None without tokens."""
        out: list[tuple | None] = [None] * len(texts)
        some = [k for k, t in enumerate(texts) if t]
        tokens = zip(some, *self.tokenize([texts[k] for k in some]))
        some = [(k, a, b) for k, a, b in tokens if self.spells(texts[k], a, b)]
        if not some:
            return out
        size_a, size_b = (np.array([len(x[c]) for x in some]) for c in (1, 2))
        found, of, first = self.windows(np.concatenate([x[1] for x in some]), np.concatenate([x[2] for x in some]),
                                    np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b)
        cuts, of = [*first.tolist(), len(of)], of.tolist()
        groups, links = found
        for (k, a, b), s, e in zip(some, cuts, cuts[1:]):
            out[k] = (len(a), len(b), b";".join([groups[x] for x in of[s:e]]),
                      np.frombuffer(b"".join([links[x] for x in of[s:e]]), dtype="<i8"))
        return out


@functools.cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process, for all tasks that it runs."""
    return Aligner(path_a, path_b)


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                    path_b: str | None = None, with_groups: bool = False) -> DataFrame:
    """One row per document: ``row`` (a number of its own), the id, the figures, and its linked pairs with their times.

    A pair is ``A id * 2^32 + B id``.  ``with_groups`` adds the groups as text.
    """
    df = docs.select(id_col, text_col)
    schema = with_fields(df.schema.fields[:1], FIGURES + ", row long, pairs array<long>, times array<int>"
                         + (", groups string" if with_groups else ""))

    def make():
        known = aligner(path_a or tokenizer_path(BYTE_BPE), path_b or tokenizer_path(PIECES))
        numbers = iter(range(TaskContext.get().partitionId() << 40, 1 << 62))

        def f(ids, texts):
            out = []
            for i, one in zip(ids, known.align(texts)):
                n_a, n_b, groups, links = one or (0, 0, b"", np.empty(0, dtype="<i8"))
                pairs, times = np.unique(links, return_counts=True)
                # tokens are never empty, so one A and one B token end where a group ends: one link per group
                out.append((i, n_a, n_b, len(links), len(links), hashlib.sha256(groups).hexdigest() if one else "",
                            next(numbers), pairs, times.astype(np.int32), groups.decode())[:len(schema)])
            return list(zip(*out))
        return f

    return map_slices(df, make, schema, rows=1024, most_bytes=8_000_000)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: links per pair over all documents; ``best`` where no A id is linked to the B id more often."""
    counts = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")) \
        .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    of_b = Window.partitionBy(F.expr("pair & 4294967295"))         # at most one row per A id
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_b)).alias("best"))


def link_figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
                 path_b: str | None = None, listed: int = 100_000) -> DataFrame:
    """The contract's columns; ``listed`` bounds the broadcast list of frequent pairs."""
    aligned = cut_table(align_documents(docs, id_col, text_col, path_a, path_b))
    counts = cut_table(pair_counts(aligned))
    top = counts.orderBy(F.desc("n"), "pair").limit(listed).sort("pair").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(
        (np.asarray(top.column("pair")), np.asarray(top.column("n")), top.column("best").to_numpy()))
    keep = [aligned.columns[0], "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row"]
    schema = with_fields([aligned.schema[c] for c in keep],
                         "sum_listed long, best_listed long, pairs array<long>, times array<int>")
    arrow = to_arrow_schema(schema)

    def run(batches):
        pair, n, best = shared.value

        def lists(c, some, row, rows):
            ends = np.searchsorted(row[some], np.arange(rows + 1))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c[some]))

        for b in batches:
            column = dict(zip(b.schema.names, b.columns))
            sizes = np.diff(np.asarray(column["pairs"].offsets))
            row = np.repeat(np.arange(b.num_rows), sizes)
            code, times = (np.asarray(column[c].flatten()) for c in ("pairs", "times"))
            at = np.minimum(np.searchsorted(pair, code), max(len(pair) - 1, 0))
            known = pair[at] == code if len(pair) else np.zeros(len(code), dtype=bool)
            total, good = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows, dtype=np.int64)
            np.add.at(total, row[known], n[at[known]] * times[known])
            np.add.at(good, row[known], best[at[known]] * times[known])
            yield pa.RecordBatch.from_arrays(
                [*(column[c] for c in keep), pa.array(total), pa.array(good), lists(code, ~known, row, b.num_rows),
                 lists(times, ~known, row, b.num_rows)], schema=arrow)

    rows = cut_table(aligned.select(*keep, "pairs", "times").mapInArrow(run, schema))
    others = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")) \
        .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    others = others.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("sum_others"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_others"))
    whole = lambda c: F.col(f"{c}_listed") + F.coalesce(F.col(f"{c}_others"), F.lit(0))      # noqa: E731
    return rows.drop("pairs", "times").join(others, "row", "left").select(
        keep[0], "n_a", "n_b", "n_groups", "n_links", whole("best").alias("n_best"), whole("sum").alias("count_sum"),
        "groups_sha256")
