"""Language identification: script ranges, per-word scores, Viterbi with a switching penalty.

Letter n-grams of every training word are counted per language on the cluster
into a table of fixed size (hashed), and words per script range.  A word's
score for a language is the log probability of its n-grams; the script of its
first letter narrows the languages it may have.  Viterbi over the words with a
constant penalty per switch labels spans; the prediction is the language of
most words, its score their share.

A text is of one language without a search if no stretch of words gains more
than the penalty in another language, and none at either end of the text more
than half of it: a path of k stretches then gains at most the k - 1 penalties
it pays.  All other texts take the full recursion, many texts at a time.

Defined results: NULL texts and texts without a letter are ``und`` with score
0, as are all texts if nothing was learned; rows are kept one for one; ties go
to the first language by name.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, map_slices, with_fields

_WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
#: fixed values: first code point of script ranges
SCRIPTS = (
    (0x0000, "Latin"), (0x0250, "Ipa"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"),
    (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"),
    (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"),
    (0x20000, "Han"), (0x323B0, "Other"))
_STARTS = np.array([s for s, _ in SCRIPTS])
NAMES = sorted({n for _, n in SCRIPTS})
_NAME_OF = np.array([NAMES.index(n) for _, n in SCRIPTS])


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bucket of every trigram, first trigram of every word, script of every word)``; words are ``^word$``."""
    joined = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    mixed = joined[:-2] * np.uint64(0x9E3779B1) + joined[1:-1] * np.uint64(0x85EBCA77) + joined[2:] * np.uint64(0xC2B2AE3D)
    starts = np.concatenate(([0], np.cumsum(sizes + 2)))[:-1]      # of ^word$ in the joined text
    keep = np.ones(len(joined) - 2, dtype=bool)
    inner = (starts + sizes)[:-1]                                  # trigrams that reach into the next word
    keep[inner], keep[inner + 1] = False, False
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    script = _NAME_OF[np.searchsorted(_STARTS, joined[starts + 1], side="right") - 1]
    return ((mixed ^ (mixed >> np.uint64(17))) & np.uint64(BUCKETS - 1))[keep].astype(np.int64), first, script


def count_ngrams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``(lang, kind, slot, n)``: counts of trigram buckets (kind 0) and of words by script (kind 1), over all rows."""
    def make():
        seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def f(texts, langs):
            by_lang: dict[str, Counter] = {}
            for text, lang in zip(texts, langs):
                by_lang.setdefault(lang, Counter()).update(words_of(text))
            for lang, words in by_lang.items():
                grams, scripts = seen.setdefault(lang, (np.zeros(BUCKETS), np.zeros(len(NAMES))))
                if not words:
                    continue
                n = np.fromiter(words.values(), dtype=np.float64, count=len(words))
                bucket, _, script = ngrams(list(words))
                sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
                grams += np.bincount(bucket, weights=np.repeat(n, sizes), minlength=BUCKETS)
                scripts += np.bincount(script, weights=n, minlength=len(NAMES))
            return [], [], [], []

        def finish():
            rows = [(lang, kind, int(s), int(c[s])) for lang, both in seen.items()
                    for kind, c in enumerate(both) for s in np.flatnonzero(c)]
            return list(zip(*rows)) if rows else ([], [], [], [])

        f.finish = finish
        return f

    return (map_slices(docs.select(text_col, lang_col), make, "lang string, kind int, slot int, n long")
            .groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")))


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray           # (BUCKETS, languages): log probability of a trigram
    candidates: np.ndarray      # (scripts, languages): whether words of the script may be of the language


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", in_training: Column | None = None,
        smoothing: float = 0.5, least_share: float = 0.01) -> Model:
    """Model from the text and the non-NULL language of all training rows.

    A language is a candidate for a script if ``least_share`` of its own
    training words are of the script, however rare the language is.  What reaches the driver is one table of
    ``BUCKETS`` counts per language.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if in_training is not None:
        rows = rows.where(in_training)
    got = count_ngrams(rows, text_col, lang_col).toPandas()
    langs = sorted(got["lang"].unique())
    grams, scripts = np.zeros((BUCKETS, len(langs))), np.zeros((len(NAMES), len(langs)))
    at = got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
    for kind, t in enumerate((grams, scripts)):
        pick = (got["kind"] == kind).to_numpy()
        t[got["slot"].to_numpy(np.int64)[pick], at[pick]] = got["n"].to_numpy(float)[pick]
    used = max(1, int((grams.sum(axis=1) > 0).sum()))
    table = np.log((grams + smoothing) / (grams.sum(axis=0) + smoothing * used))
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    candidates = share >= least_share
    candidates[~candidates.any(axis=1)] = True
    return Model(list(langs), table, candidates)


OUT_OF_SCRIPT = -1000.0
#: (word, text, language) scores of a batch of the recursion
CELLS = 2_000_000


class Labeller:
    """Labels texts with a model; keeps scores of words it has seen."""

    def __init__(self, model: Model, penalty: float, entries: int = 300_000):
        self.model, self.penalty, self.entries = model, penalty, entries
        self._clear()

    def _clear(self):
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model.langs)))

    def _learn(self, new: list[str]) -> None:
        plain = ["".join(c for c in w if c.isalpha()) if not w.isalpha() else w for w in new]
        bucket, first, script = ngrams([w or "?" for w in plain])
        s = np.add.reduceat(self.model.table[bucket], first, axis=0)
        s = np.where(self.model.candidates[script], s, OUT_OF_SCRIPT + s)
        s[[i for i, w in enumerate(plain) if not w]] = np.nan         # no letter: not a word
        at = len(self.rows)
        for w in new:
            self.rows[w] = len(self.rows)
        if len(self.rows) > len(self.table):            # grown by doubling
            larger = np.zeros((2 * len(self.rows), self.table.shape[1]))
            larger[:at] = self.table[:at]
            self.table = larger
        self.table[at:len(self.rows)] = s

    def label(self, texts: list[str | None]) -> list[np.ndarray]:
        """Language number of every word of every text."""
        words = [words_of(t) for t in texts]
        if len(self.rows) > self.entries:
            self._clear()
        new = sorted(set().union(*words).difference(self.rows))
        if new:
            self._learn(new)
        get, out, mixed = self.rows.__getitem__, [None] * len(words), []
        for k, ws in enumerate(words):
            s = self.table[np.fromiter(map(get, ws), dtype=np.int64, count=len(ws))]
            if len(s) and np.isnan(s[:, 0]).any():
                s = s[~np.isnan(s[:, 0])]
            if not len(s):
                out[k] = np.zeros(0, dtype=np.int64)
                continue
            best = int(s.sum(axis=0).argmax())
            if one_language(s, best, self.penalty):
                out[k] = np.full(len(s), best)
            else:
                mixed.append((k, s))
        mixed.sort(key=lambda x: -len(x[1]))
        i = 0
        while i < len(mixed):                           # batches by what the longest text pads them to
            n = max(1, min(64, CELLS // max(1, mixed[i][1].size)))
            part = mixed[i:i + n]
            for (k, _), labels in zip(part, viterbi([s for _, s in part], self.penalty)):
                out[k] = labels
            i += n
        return out


def one_language(s: np.ndarray, best: int, penalty: float, block: int = 16_384) -> bool:
    """Whether no path beats language ``best``, that of the best sum, for the whole text.

    A stretch between two switches may gain the penalty over ``best``, the
    first and the last stretch half of it each.  Sums run on from block to
    block of words.
    """
    k = s.shape[1]
    total, low, top, least, between = np.zeros(k), np.zeros(k), -np.inf, np.full(k, np.inf), -np.inf
    for at in range(0, len(s), block):
        part = s[at:at + block]
        gain = total + np.cumsum(part - part[:, best:best + 1], axis=0)
        before = np.vstack([low[None], gain[:-1]])
        before = np.minimum.accumulate(before, axis=0)
        between = max(between, (gain - before).max())
        if at:
            least = np.minimum(least, total)            # the sum at the end of the block before
        if len(part) > 1:
            least = np.minimum(least, gain[:-1].min(axis=0))
        top, total, low = max(top, gain.max()), gain[-1], np.minimum(before[-1], gain[-1])
    last = (total - least).max() if len(s) > 1 else 0.0
    return bool(max(top, last, 0.0) <= penalty / 2 and between <= penalty)


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Best labels of each text (texts longest first), all texts a word at a time."""
    sizes = np.array([len(s) for s in scores])
    n, steps, k = len(scores), int(sizes[0]), scores[0].shape[1]
    if n == 1:
        padded = scores[0][:, None]                     # no copy of a very long text
    else:
        padded = np.zeros((steps, n, k))
        for i, s in enumerate(scores):
            padded[:len(s), i] = s
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # texts longer than t words
    came = np.zeros((steps, n, k), dtype=np.uint8 if k <= 256 else np.int16)
    d, own = padded[0].copy(), np.arange(k)
    for t in range(1, steps):
        a = active[t]
        x = d[:a]
        top = x.argmax(axis=1)
        switched = x[np.arange(a), top] - penalty
        stay = x >= switched[:, None]
        came[t, :a] = np.where(stay, own, top[:, None])
        d[:a] = np.where(stay, x, switched[:, None]) + padded[t, :a]
    out = []
    for i, size in enumerate(sizes):
        labels = np.empty(size, dtype=np.int64)
        at = int(d[i].argmax())
        for t in range(size - 1, -1, -1):
            labels[t] = at
            at = came[t, i, at]
        out.append(labels)
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
             penalty: float = 20.0) -> DataFrame:
    """``(doc_id, lang_pred, score, spans)``; spans are ``(first word, end, lang)`` stretches of one language."""
    df = docs.select(id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        langs = sent.value.langs
        labeller = Labeller(sent.value, penalty) if langs else None

        def one(labels):
            if not len(labels):
                return "und", 0.0, []
            n = np.bincount(labels, minlength=len(langs))
            best = int(n.argmax())
            edge = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
            return langs[best], float(n[best] / len(labels)), [
                {"first": a, "end": b, "lang": langs[labels[a]]} for a, b in zip(edge, edge[1:])]

        def f(ids, texts):
            labels = labeller.label(texts) if langs else [()] * len(texts)
            return ids, *zip(*map(one, labels))
        return f

    return map_slices(df, make, with_fields(
        df.schema.fields[:1], "lang_pred string, score double, spans array<struct<first:bigint,end:bigint,lang:string>>"))


def held_out_predictions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The contract's columns: learned from rows whose id's crc32 mod 4 is not 2, all rows predicted."""
    model = fit(docs, text_col, lang_col, in_training=id_remainder(id_col, 4) != 2)
    return identify(docs, model, id_col, text_col).select(
        id_col, (id_remainder(id_col, 4) == 2).alias("held_out"), "lang_pred", "score")
