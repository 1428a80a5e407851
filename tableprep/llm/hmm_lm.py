"""Language-model scoring with a hidden Markov model.

Words fall into classes: each of the most frequent words is its own class, all
others share classes by their first and last letters.  A hidden Markov model
over the classes is trained by Baum-Welch; every round's expected counts are
summed over all partitions.  A text's probability is

    P(classes | HMM) * product over words of P(word | class),

the first factor by the scaled forward recursion over the whole text, the
second ``(c + 1) / (N_k + V_k + 1)`` with the word's training count c, the
class's tokens N_k and distinct words V_k, and the spare unit for unknown
words; a word that is its own class has probability 1 in it.

Counts of words are exact over all training texts.  The vocabulary has no
bound, so it is never broadcast: words of a bounded list are counted in each
task, all others travel as one row per (text, word) to the word's partition,
get their count there, and come back summed per text.  The list begins with
the classes of their own, which are the most frequent words by their exact
counts over all training texts; the frequent words of a sample follow, and
for those the list only decides which way a word is counted.

Defined results: NULL and empty texts are the end token alone; a NULL id
counts as empty text for the split; rows are kept one for one, repeated rows
count as often as they occur; without training texts all base scores are 0.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field, replace
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ASCII_LOWER, cut, cut_table, map_slices, with_fields

END = 0
ROWS = 2048
TEXT_BYTES = 8_000_000
BATCH_TOKENS = 250_000


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of the text after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() if text else []


def words_of_slice(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.BinaryArray]:
    """``words_of`` of many texts: the text of every word, its place among the distinct words, and these."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
    words = split.flatten()
    some = pc.binary_length(words).to_numpy() > 0                               # white space at an end leaves a blank
    if not some.all():
        text, words = text[some], words.filter(pa.array(some))
    found = words.dictionary_encode()
    return text, found.indices.to_numpy(), found.dictionary.cast(pa.binary())


def listed(words: pa.BinaryArray) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()        # several times as fast as to_pylist()


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC = _crc_table()


def edge_hashes(words: pa.BinaryArray) -> np.ndarray:
    """crc32 of the first two bytes, a space and the last two of every word (of one byte: this byte twice)."""
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1]
    first, last = ends[:-1], ends[1:] - 1
    out = np.full(len(words), 0xFFFFFFFF, dtype=np.uint32)
    two = last > first
    for b, every in ((data[first], True), (data[np.minimum(first + 1, last)], False), (np.uint8(32), True),
                     (data[np.maximum(last - 1, first)], False), (data[last], True)):
        step = CRC[(out ^ b) & 255] ^ (out >> 8)
        out = step if every else np.where(two, step, out)
    return ~out


@dataclass
class Model:
    """Frequent words in order, the first ``own`` of which are classes of their own; HMM over all classes."""
    frequent: list[bytes]
    own: int
    shared: int
    start: np.ndarray = None            # (S,)
    move: np.ndarray = None             # (S, S)
    emit: np.ndarray = None             # (classes, S)
    counts: np.ndarray = None           # training counts of the frequent words
    tokens: int = 0                     # N
    distinct: int = 0                   # V
    class_tokens: np.ndarray = None     # N_k
    class_words: np.ndarray = None      # V_k
    class_of: np.ndarray = field(default=None, repr=False)      # class of every code, made once
    lookup: dict = field(default=None, repr=False)
    likelihoods: list = field(default_factory=list)     # log10 per training token before each round over all texts

    def __post_init__(self):
        if self.class_of is None:
            self.class_of = np.array([*map(self.class_of_frequent, range(len(self.frequent))), *range(self.classes)], dtype=np.int64)

    @property
    def classes(self) -> int:
        return 1 + self.own + self.shared

    def shared_class(self, word: bytes) -> int:
        return 1 + self.own + crc32(word[:2] + b" " + word[-2:]) % self.shared

    def shared_classes(self, words: pa.BinaryArray) -> np.ndarray:
        return 1 + self.own + edge_hashes(words).astype(np.int64) % self.shared

    def class_of_frequent(self, i: int) -> int:
        return 1 + i if i < self.own else self.shared_class(self.frequent[i])


class Coder:
    """Word -> code: the place of a frequent word, or ``len(frequent) + class`` of any other."""

    def __init__(self, model: Model):
        self.model, self.n = model, len(model.frequent)
        self.fixed = {w: i for i, w in enumerate(model.frequent)}

    def codes(self, words: pa.BinaryArray) -> np.ndarray:
        out = np.fromiter(map(self.fixed.get, listed(words), repeat(-1)), dtype=np.int64, count=len(words))
        return np.where(out < 0, self.n + self.model.shared_classes(words), out)


def batches(sequences: list[np.ndarray]):
    """Index lists of sequences, longest first, of at most ``BATCH_TOKENS`` tokens each or one sequence."""
    part, held = [], 0
    for i in sorted(range(len(sequences)), key=lambda i: -len(sequences[i])):
        if part and held + len(sequences[i]) > BATCH_TOKENS:
            yield part
            part, held = [], 0
        part.append(i)
        held += len(sequences[i])
    if part:
        yield part


def packed(sequences: list[np.ndarray]):
    """Tokens of sequences (longest first), all first ones, then all second ones and so on, without padding.

    Returns the tokens, the sequence of each, and where the tokens of a step
    begin; step t holds the first ``active[t]`` sequences.
    """
    sizes = np.array([len(s) for s in sequences])
    steps = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    first = np.concatenate([[0], np.cumsum(active)])
    who = np.arange(first[-1]) - np.repeat(first[:-1], active)
    begins = np.cumsum(sizes) - sizes
    return np.concatenate(sequences)[begins[who] + np.repeat(np.arange(steps), active)], who, first


def forward(sequences: list[np.ndarray], model: Model, keep: bool = False):
    """Natural log likelihood of class sequences (longest first); with ``keep`` also what the backward pass needs."""
    flat, who, first = packed(sequences)
    emits = np.take(model.emit, flat, axis=0)
    alphas = np.empty_like(emits) if keep else emits
    scales = np.empty((len(flat), 1))
    ones = np.ones((len(model.start), 1))
    alpha, ends = None, first.tolist()
    for lo, hi in zip(ends, ends[1:]):
        before = model.start if alpha is None else alpha[:hi - lo] @ model.move
        alpha = np.multiply(before, emits[lo:hi], out=alphas[lo:hi])
        alpha /= np.matmul(alpha, ones, out=scales[lo:hi])
    log = np.bincount(who, weights=np.log(scales[:, 0]))
    return (log, flat, first, emits, alphas, scales) if keep else log


def expected_counts(sequences: list[np.ndarray], model: Model, likelihood: bool = False, block: int = 65536):
    """Baum-Welch counts of a batch: ``(start, move, emit)``, with ``likelihood`` also the log likelihood's sum."""
    log, flat, first, weight, alphas, scales = forward(sequences, model, keep=True)
    weight /= scales                                # becomes emit * beta / scale, for the step into the token
    beta = np.ones_like(alphas)
    back = np.ascontiguousarray(model.move.T)
    ends = first.tolist()
    for t in range(len(ends) - 2, 0, -1):
        lo, hi, last = ends[t], ends[t + 1], ends[t - 1]
        into = np.multiply(weight[lo:hi], beta[lo:hi], out=weight[lo:hi])
        np.matmul(into, back, out=beta[last:last + hi - lo])
    move = np.zeros_like(model.move)
    active, later = np.diff(first), ends[1]
    before = np.arange(later, len(flat)) - np.repeat(active[:-1], active[1:])   # the token before, of the same sequence
    for i in range(0, len(before), block):
        at = before[i:i + block]
        move += alphas[at].T @ weight[later + i:later + i + len(at)]
    gamma = np.multiply(alphas, beta, out=beta)
    emit = np.stack([np.bincount(flat, weights=g, minlength=model.classes) for g in gamma.T], axis=1)
    counts = gamma[:later].sum(axis=0), move * model.move, emit
    return (*counts, log.sum()) if likelihood else counts


def reestimate(model: Model, start, move, emit, strength: float = 500.0) -> Model:
    """Model from expected counts, smoothed towards the class frequencies."""
    unigram = emit.sum(axis=1) + 0.5
    unigram /= unigram.sum()
    e = emit + strength * unigram[:, None]
    m = move + 1.0
    s = start + 1.0
    return replace(model, start=s / s.sum(), move=m / m.sum(axis=1, keepdims=True), emit=e / e.sum(axis=0))


def coded(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with 32-bit ``codes`` of their words in place of ``text``, written once for all passes that follow."""
    keep = [c for c in rows.columns if c != "text"]
    sent = rows.sparkSession.sparkContext.broadcast(replace(model, start=None, move=None, emit=None))

    def make():
        coder = Coder(sent.value)

        def f(*columns):
            text, places, words = words_of_slice(columns[-1])
            codes = coder.codes(words).astype("<i4")[places]
            ends = np.zeros(len(columns[-1]) + 1, dtype=np.int32)
            np.cumsum(np.bincount(text, minlength=len(ends) - 1) * 4, out=ends[1:])
            return *columns[:-1], pa.Array.from_buffers(
                pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(codes)])
        return f

    schema = with_fields([rows.schema[c] for c in keep], "codes binary")
    return cut_table(map_slices(rows.select(*keep, "text"), make, schema, ROWS, TEXT_BYTES, arrow=True))


def codes_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<i4")


def count_round(rows: DataFrame, model: Model) -> tuple[Model, np.ndarray, np.ndarray, float]:
    """One Baum-Welch round over all ``rows(codes)``: new model, counts of frequent words, tokens of classes, and the
    natural log likelihood of the classes under ``model``."""
    states, n = len(model.start), len(model.frequent)
    sent = rows.sparkSession.sparkContext.broadcast(replace(model, frequent=[]))
    a, b, c = states, states + states * states, states + states * states + model.classes * states

    def make():
        m = sent.value
        class_of = m.class_of
        total = np.zeros(c + n + 1)

        def f(raw):
            codes = [codes_of(x) for x in raw]
            total[c:c + n] += np.bincount(np.concatenate(codes), minlength=n)[:n] if codes else 0
            sequences = [np.append(class_of[x], END) for x in codes]
            for part in batches(sequences):
                start, move, emit, log = expected_counts([sequences[i] for i in part], m, likelihood=True)
                total[c + n] += log
                total[:a] += start
                total[a:b] += move.ravel()
                total[b:c] += emit.ravel()
            return [], []

        def finish():
            at = np.flatnonzero(total)
            return at.astype(np.int32), total[at]

        f.finish = finish
        return f

    got = map_slices(rows, make, "slot int, v double", ROWS).groupBy("slot").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros(c + n + 1)
    total[got["slot"].to_numpy(np.int64)] = got["v"].to_numpy(float)
    emit = total[b:c].reshape(model.classes, states)
    return (reestimate(model, total[:a], total[a:b].reshape(states, states), emit),
            np.rint(total[c:c + n]).astype(np.int64), np.rint(emit.sum(axis=1)).astype(np.int64), float(total[c + n]))


def frequent_words(texts: DataFrame, limit: int, entries: int = 200_000) -> list[bytes]:
    """Words of all ``texts`` that occur twice or more, most frequent first, ``limit`` at most.

    Tasks add words up in a table of about ``entries`` words, which they send on when it is full.
    """
    def make():
        seen = {}

        def f(texts):
            _, places, words = words_of_slice(texts)
            for w, n in zip(listed(words), np.bincount(places, minlength=len(words)).tolist()):
                seen[w] = seen.get(w, 0) + n
            return full() if len(seen) > entries else ([], [])

        def full():
            out = list(seen), list(seen.values())
            seen.clear()
            return out

        f.finish = full
        return f

    rows = (map_slices(texts, make, "word binary, n long", ROWS, TEXT_BYTES, arrow=True).groupBy("word").agg(F.sum("n").alias("n"))
            .where("n > 1").orderBy(F.desc("n"), "word").limit(limit).select("word").collect())
    return [bytes(r[0]) for r in rows]


def first_guess(model: Model, sample: DataFrame, states: int) -> Model:
    """States that each start from the words of one sample text; states tend to stay."""
    texts = [r[0] for r in sample.where(F.length("text") > 400).orderBy(F.xxhash64("text"), "text").limit(states).collect()]
    coder = Coder(model)
    emit = np.ones((model.classes, states))
    for s, t in enumerate(texts):
        np.add.at(emit[:, s], model.class_of[coder.codes(pa.array(words_of(t), pa.binary()))], 2.0)
    emit[END] = emit.sum(axis=0) / 500
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9)
    return replace(model, start=np.full(states, 1 / states), move=move / move.sum(axis=1, keepdims=True),
                   emit=emit / emit.sum(axis=0))


def word_list(training: DataFrame, sample_docs: int = 8000, guess_docs: int = 1500, frequent: int = 100_000,
              own: int = 2000, shared: int = 6000) -> tuple[Model, DataFrame]:
    """The model's words and classes, and ``few(text)``, the sample for its starting point.

    The ``own`` words of the highest counts over all ``training(id, text)``
    become classes; ``sample_docs`` texts give the rest of the word list, and
    ``guess_docs`` of them are ``few``.  An id with several texts gives the
    one of the smallest hash.
    """
    ids = cut(training.select("id").orderBy(F.xxhash64("id"), "id").limit(sample_docs).distinct()
              .withColumn("r", F.xxhash64("id")))                               # bounded: fit to broadcast
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    sample = cut(training.join(F.broadcast(ids), "id").groupBy("id", "r").agg(one).select("r", "text"))
    words = frequent_words(training.select("text"), min(own, frequent))
    n, known = len(words), set(words)
    words.extend([w for w in frequent_words(sample.select("text"), frequent) if w not in known][:frequent - n])
    model = Model(words, n, shared)
    edge = ids.orderBy("r").limit(guess_docs).agg(F.max("r")).first()[0]
    return model, cut(sample.where(F.col("r") <= F.lit(edge)).select("text").repartition(8))


def fit(rows: DataFrame, few: DataFrame, model: Model, states: int = 8, guess_rounds: int = 6, rounds: int = 3) -> Model:
    """``guess_rounds`` of Baum-Welch over ``few(text)`` give the starting point, ``rounds`` go over all ``rows(codes)``;
    all counts used in scores come from those."""
    guess = coded(few, model)
    model = first_guess(model, few, states)
    for _ in range(guess_rounds):
        model, *_ = count_round(guess, model)
    for _ in range(rounds):
        model, counts, class_tokens, log = count_round(rows, model)
        model.likelihoods.append(log / np.log(10) / max(1, int(class_tokens.sum())))
    return replace(model, counts=counts, class_tokens=class_tokens, tokens=int(class_tokens.sum()))


def split_options(options: dict) -> tuple[dict, dict]:
    """Options of ``word_list`` and of ``fit``."""
    later = {k: v for k, v in options.items() if k in ("states", "guess_rounds", "rounds")}
    return {k: v for k, v in options.items() if k not in later}, later


def train(training: DataFrame, **options) -> Model:
    """Model from ``training(id, text)``; ``options`` are those of ``word_list`` and ``fit``."""
    first, later = split_options(options)
    model, few = word_list(training, **first)
    return fit(coded(training.select("text"), model), few, model, **later)


def rare_words(rows: DataFrame, model: Model) -> DataFrame:
    """``(id, digest, word, k, tf, train)`` per text and distinct word outside the list; words as 64-bit hashes."""
    sent = rows.sparkSession.sparkContext.broadcast(replace(model, start=None, move=None, emit=None))

    def make():
        m = sent.value
        frequent = set(m.frequent)

        def f(ids, digests, train, texts):
            text, places, words = words_of_slice(texts)
            distinct = listed(words)
            rare = ~np.fromiter(map(frequent.__contains__, distinct), dtype=bool, count=len(words))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), dtype=np.uint64, count=len(words))
            hashes = (hashes ^ np.uint64(1 << 63)).view(np.int64)               # the hash less 2^63
            k = m.shared_classes(words).astype(np.int32)
            kept = rare[places]
            pairs, tf = np.unique(text[kept] * len(words) + places[kept], return_counts=True)
            text, word = np.divmod(pairs, max(1, len(words)))
            text = pa.array(text)
            return ids.take(text), digests.take(text), hashes[word], k[word], tf.astype(np.int32), train.take(text)
        return f

    return map_slices(rows.select("id", "digest", "train", "text"), make, with_fields(
        rows.select("id", "digest").schema.fields, "word bigint, k int, tf int, train boolean"), ROWS, TEXT_BYTES, arrow=True)


def sum_rare_words(rare: DataFrame) -> DataFrame:
    """Per text (``by_class`` 0): ``log_counts``, ``known``; per class (1): ``words`` with a training count.

    A word's rows meet once, for its count; a text that occurs repeatedly is
    counted as often but summed once.
    """
    same = W.partitionBy("word").orderBy("id", "digest")
    c = F.col("c")
    once = F.col("copy") == 1
    counted = (rare.withColumn("copy", F.row_number().over(W.partitionBy("word", "id", "digest").orderBy("word")))
               .withColumn("first", F.row_number().over(same) == 1)
               .withColumn("c", F.sum(F.when(F.col("train"), F.col("tf")).otherwise(0)).over(W.partitionBy("word"))))
    return counted.groupingSets([[F.col("id"), F.col("digest")], [F.col("k")]], "id", "digest", "k").agg(
        F.grouping("id").cast("int").alias("by_class"),
        F.sum(F.when(once, F.col("tf") * F.log10(c + 1)).otherwise(0.0)).alias("log_counts"),
        F.sum(F.when(once & (c > 0), F.col("tf")).otherwise(0)).alias("known"),
        F.sum(F.when(F.col("first") & (c > 0), 1).otherwise(0)).alias("words"))


def score_texts(rows: DataFrame, model: Model) -> DataFrame:
    """Per row of ``rows(id, digest, train, codes)``: tokens, known words and log10 sums of everything but the counts of words outside the list."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value
        class_of = m.class_of
        n = len(m.frequent)
        base = np.concatenate([np.log10(m.counts + 1.0), np.zeros(m.classes)])
        known = np.concatenate([m.counts > 0, np.zeros(m.classes, dtype=bool)])
        inside = -np.log10(m.class_tokens + m.class_words + 1.0)
        inside[:1 + m.own] = 0
        inside = inside[class_of]
        inside[m.own:n] += base[m.own:n]
        ends = m.class_tokens[END]

        def f(ids, digests, train, raw):
            codes = [codes_of(x) for x in raw]
            sequences = [np.append(class_of[x], END) for x in codes]
            log = np.zeros(len(codes))
            for part in batches(sequences):
                log[part] = forward([sequences[i] for i in part], m)
            return (ids, digests, train, [len(s) for s in sequences], [int(known[x].sum()) + int(ends > 0) for x in codes],
                    [float(base[x].sum() + np.log10(ends + 1.0)) for x in codes],
                    [float(inside[x].sum() + g / np.log(10)) for x, g in zip(codes, log)])
        return f

    return map_slices(rows.select("id", "digest", "train", "codes"), make, with_fields(
        rows.select("id", "digest", "train").schema.fields,
        "n_tokens bigint, known bigint, log_base double, log_model double"), ROWS)


def score(docs: DataFrame, in_training: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The contract's columns, learned from the rows where ``in_training`` holds; ``options`` are those of ``train``."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"),
                       in_training.alias("train"), F.col(text_col).alias("text"))
    first, later = split_options(options)
    model, few = word_list(rows.where("train").select("id", "text"), **first)
    table = coded(rows, model)
    model = fit(table.where("train").select("codes"), few, model, **later)
    sums = cut_table(sum_rare_words(rare_words(rows, model)))
    words = np.zeros(model.classes, dtype=np.int64)
    for r in sums.where("by_class = 1").select("k", "words").collect():         # one row per shared class
        words[r[0]] = r[1]
    np.add.at(words, model.class_of[:len(model.counts)], model.counts > 0)
    words[END] = model.class_tokens[END] > 0
    model = replace(model, class_words=words, distinct=int(words.sum()))
    unit = float(np.log10(model.tokens + model.distinct + 1.0))
    s = sums.where("by_class = 0").select(F.col("id").alias("i"), F.col("digest").alias("d"), "log_counts",
                                          F.col("known").alias("rare_known"))
    t = score_texts(table, model).join(s, F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")), "left")
    more = F.coalesce("log_counts", F.lit(0.0))
    return t.select(
        F.col("id").alias(id_col), (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log_base") + more - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("log_model") + more).alias("score"))
