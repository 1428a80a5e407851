"""Best-fit packing by sums of squares.

Documents become token ids, ids longer than a sequence are cut, and pieces are
packed into sequences of ``capacity`` tokens: with N(g) open sequences of gap
g, a piece goes where the sum of N(g)^2 becomes smallest (ties: the smallest
gap).  Pieces come longest first, so the rule levels gaps while pieces are
long and closes them while pieces are short.

Packing is by groups of about ``group_pieces`` pieces dealt round robin, so
hot ids or copies do not gather, memory of a task is bounded, and each group
leaves only its last few sequences part-filled.

Defined results: NULL or empty texts are the end id alone; rows are kept one
for one (repeated rows are packed each); an empty table gives no pieces.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
import zlib

import numpy as np
import regex
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import byte_alphabet, cut_table, map_slices, with_fields

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0


class ChunkEncoder:
    """Ids of texts: plain Latin texts in one call each, others through a cache of their blank-separated chunks.

    A plain text is lowered and cut into the tokenizer's words here; the merges
    of all its words are one call of a byte-level encoder.  For it a word's
    end is a byte of its own, NUL, which joins the last letter before any other
    merge, as the ids of a letter at a word's end come before those of merges.

    In other texts the tokenizer drops white space and never joins what it
    separates, so their ids are those of their chunks in a row.  Chunks of
    plain Latin letters are cut into words first; many new words are then
    encoded in one call, told apart by their word-end ids.
    """

    #: fixed value: the word pattern of the vocabulary file
    WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    #: characters whose lower-case and composed forms do not depend on their neighbours
    PLAIN = regex.compile(r"[\x21-\x7e\xa1-įı-ſ]+")

    #: the same of whole texts, with their blanks
    PLAIN_TEXT = regex.compile(r"[\x09-\x0d\x20-\x7e\x85\xa0-įı-ſ]*")

    def __init__(self, path: str, entries: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.entries, self.chunks, self.words = entries, {}, {}
        of, ranks = byte_alphabet(), {}
        for t, i in vocab.items():
            word = t.removesuffix("</w>")
            ranks[bytes(map(of.get, word)) + (b"\0" if word != t else b"")] = i
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        # the word pattern for letters and digits of plain texts, which the standard library reads faster
        letter, digit = ("".join(re.escape(c) for c in map(chr, range(0x21, 0x180)) if unicodedata.category(c)[0] == k) for k in "LN")
        self.plain_words = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{letter}]+|[{digit}]|[^\\s{letter}{digit}]+")

    def _plain(self, text: str) -> bytes:
        words = self.plain_words.findall(text.lower())
        return self.merges.encode_to_numpy("\0".join(words) + "\0", disallowed_special=()).astype("<u4").tobytes() if words else b""

    def _one(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_words(self, new: list[str]) -> None:
        ids = np.array(self.tokenizer.encode(" ".join(new), add_special_tokens=False).ids, dtype="<u4")
        last = np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)])
        if len(last) != len(new):                       # not one word each: one by one
            self.words.update((w, self._one(w)) for w in new)
            return
        raw, at = ids.tobytes(), 0
        for w, e in zip(new, ((last + 1) * 4).tolist()):
            self.words[w] = raw[at:e]
            at = e

    def _learn(self, chunks: set[str], plain: bool) -> None:
        cut = {}
        for c in chunks:
            if plain or self.PLAIN.fullmatch(c):
                if c.isalpha():
                    cut[c] = c.lower()
                    continue
                if "<|" not in c:
                    cut[c] = self.WORDS.findall(c.lower())
                    continue
            self.chunks[c] = self._one(c)
        new = set()
        for w in cut.values():
            new.add(w) if w.__class__ is str else new.update(w)
        new = sorted(new.difference(self.words))
        for i in range(0, len(new), 8192):
            self._learn_words(new[i:i + 8192])
        words, known = self.words, self.chunks
        for c, w in cut.items():
            known[c] = words[w] if w.__class__ is str else b"".join([words[x] for x in w])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out, rows, plain, other = [b""] * len(texts), {}, set(), set()
        for k, t in enumerate(texts):
            if not t:
                continue
            if "<|" not in t and self.PLAIN_TEXT.fullmatch(t):
                out[k] = self._plain(t)
                continue
            if any(c in t for c in "\x1c\x1d\x1e\x1f"):         # blanks for Python, not for the tokenizer
                rows[k] = [x for x in regex.split(r"[ \t\r\n]+", t) if x]
                other.update(rows[k])
                continue
            rows[k] = t.split()
            try:
                t.encode("latin-1")
                plain.update(rows[k])
            except UnicodeEncodeError:
                other.update(rows[k])
        if len(self.chunks) > self.entries or len(self.words) > self.entries:
            self.chunks, self.words = {}, {}
        self._learn(plain.difference(self.chunks), True)
        self._learn(other.difference(self.chunks), False)
        known = self.chunks.__getitem__
        for k, r in rows.items():
            out[k] = b"".join(map(known, r))
        return out


@functools.cache
def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process; its cache serves all tasks that the process runs."""
    return ChunkEncoder(path)


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document's ids plus the end id; ``ids`` on request."""
    df = docs.select(id_col, text_col)
    schema = with_fields(df.schema.fields[:1], "piece int, start long, length long, ids_crc32 long"
                         + (", ids array<int>" if with_ids else ""))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def make():
        known = encoder(vocabulary or tokenizer_path())

        def f(ids, texts):
            out = [[] for _ in schema]
            for i, raw in zip(ids, known.encode(texts)):
                raw += end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    row = (i, k, at // 4, len(part) // 4, zlib.crc32(part))
                    if with_ids:
                        row += (np.frombuffer(part, dtype="<u4").astype(np.int32).tolist(),)
                    for c, v in zip(out, row):
                        c.append(v)
            return out
        return f

    return map_slices(df, make, schema)


def pack(lengths, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of each length, in the order given, by the sum-of-squares rule.

    Among the gaps that hold the piece, the one is taken that makes the sum of
    N(g)^2 smallest; a new sequence is opened only where no gap holds it.
    """
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    count = np.zeros(capacity + 1, dtype=np.int64)          # open sequences per gap
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = 0
    for k, s in enumerate(map(int, lengths)):
        if s > capacity:
            raise ValueError("a piece is longer than a sequence")
        gaps = np.flatnonzero(count[s:]) if s else ()
        if len(gaps):
            # N(g)^2 falls by 2 N(g) - 1; N(g - s)^2 rises by 2 N(g - s) + 1, but a closed sequence counts no more
            gaps = gaps + s
            change = np.where(gaps > s, 2 * count[gaps - s] + 1, 0) - 2 * count[gaps] + 1
            gap = int(gaps[change.argmin()])
            b = open_[gap].pop()
            count[gap] -= 1
        else:
            b, gap, n = n, capacity, n + 1
        sequence[k], offset[k] = b, capacity - gap
        if gap > s:
            open_[gap - s].append(b)
            count[gap - s] += 1
    return sequence, offset


def pack_pieces(pieces_: DataFrame, capacity: int = CAPACITY, group_pieces: int = 50_000) -> DataFrame:
    """``pieces_`` (with a ``length``) and the ``sequence_id`` and ``offset`` of each row.

    ``pieces_`` is written once, so that a lost executor's group is packed
    again from the same rows; ids are group * 2^40 + number in the group.
    """
    table = cut_table(pieces_)
    groups = max(1, -(-table.count() // group_pieces))
    at = table.columns.index("length")
    schema = with_fields(table.schema.fields, "sequence_id long, offset long")

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        length = np.asarray(t.column(at))
        order = np.argsort(-length, kind="stable")
        sequence, offset = np.empty_like(length), np.empty_like(length)
        sequence[order], offset[order] = pack(length[order], capacity)
        first = TaskContext.get().partitionId() << 40
        out = pa.Table.from_arrays([*t.columns, pa.array(sequence + first), pa.array(offset)], schema=to_arrow_schema(schema))
        yield from out.to_batches(max_chunksize=10_000)

    return table.repartition(groups).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   vocabulary: str | None = None, group_pieces: int = 50_000) -> DataFrame:
    """Where every piece of every document's ids lies: the contract's columns."""
    return pack_pieces(pieces(docs, id_col, text_col, capacity, vocabulary), capacity, group_pieces)


def sequences(docs: DataFrame, placed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """``(sequence_id, ids)``: the packed token ids themselves, for documents with distinct ids."""
    ids = pieces(docs, id_col, text_col, capacity, vocabulary, with_ids=True).select(id_col, "piece", "ids")
    rows = placed.select(id_col, "piece", "sequence_id", "offset").join(ids, [id_col, "piece"])
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
