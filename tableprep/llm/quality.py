"""Quality rules as a short-circuit cascade (DataFrame functions only).

Each rule is a measure of the text and a test of it.  On a bounded sample the
cost (seconds of one aggregate over the rule's measure) and the selectivity
(share rejected) of every rule are estimated; the rules then run in order of
rejection per cost, and a measure is computed only for rows that every rule
before it has passed.  The order changes the work, never the verdict.

Defined results: NULL and empty texts have no words, all measures 0, and are
rejected by the ``words`` rule; rows are kept one for one; ties in the order
go by rule name.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPACE, cut

_WHITE = " \t\n\x0b\x0c\r"


def _window_bits(n: Column) -> Column:
    return F.length(F.bin(n))


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in ``words``.

    Each window becomes one long: high bits of its XXH64, low bits its place.
    After sorting the longs, equal windows are neighbours unless two different
    ones share these bits.  Then some neighbours with equal bits differ in a
    word, which is looked for; such a text, usually one of many million words,
    has its windows sorted by their words instead.
    """
    n = F.size(words)
    bits = _window_bits(n)
    windows = F.slice(words, F.lit(1), n - 2)
    keys = F.transform(
        windows, lambda w, i: F.call_function("shiftleft", F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)), bits)
        .bitwiseOR(i.cast("long")))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def same_bits(x, y):
        return F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)

    def same_words(x, y):
        p, q = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
        return (F.get(words, p) == F.get(words, q)) & (F.get(words, p + 1) == F.get(words, q + 1)) & \
            (F.get(words, p + 2) == F.get(words, q + 2))

    def starts(s: Column) -> Column:
        hit = F.filter(s, lambda x, i: same_bits(x, F.get(s, i - 1)) | same_bits(x, F.get(s, i + 1)))
        return F.sort_array(F.transform(hit, lambda x: x.bitwiseAND(mask)))

    def clash(s: Column) -> Column:
        unlike = F.transform(s, lambda x, i: F.coalesce(same_bits(x, F.get(s, i + 1)) & ~same_words(x, F.get(s, i + 1)), F.lit(False)))
        return F.exists(unlike, lambda x: x)

    def starts_by_words() -> Column:
        rows = F.sort_array(F.transform(windows, lambda w, i: F.struct(
            F.struct(w.alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c")).alias("w"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            hit = F.filter(s, lambda x, i: F.coalesce(x["w"] == F.get(s, i - 1)["w"], F.lit(False))
                           | F.coalesce(x["w"] == F.get(s, i + 1)["w"], F.lit(False)))
            return F.sort_array(F.transform(hit, lambda x: x["i"].cast("long")))
        return F.transform(F.array(rows), repeated)[0]

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))).cast("long")),
            F.lit(0).cast("long"), lambda a, x: a + x)

    sorted_keys = F.sort_array(keys)
    found = F.transform(F.array(sorted_keys), lambda s: F.when(clash(s), starts_by_words()).otherwise(starts(s)))
    one = F.transform(found, covered)                                           # binds each array once
    return F.when(n >= 4, one[0]).otherwise(F.lit(0).cast("long"))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_WHITE)) != "")


def _dup_lines(text: Column) -> Column:
    return F.transform(F.array(lines_with_words(text)), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0]


#: measure -> expression over the text and its words
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words).cast("long"),
    "word_chars": lambda text, words: F.char_length(F.array_join(words, "")).cast("long"),
    "n_symbols": lambda text, words: F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long"),
    "n_lines": lambda text, words: F.size(lines_with_words(text)).cast("long"),
    "n_dup_lines": lambda text, words: _dup_lines(text).cast("long"),
    "n_repeat_words": lambda text, words: repeated_words(words),
}


def with_words(text_col: str, result: Callable[[Column, Column], Column]) -> Column:
    """``result(text, words)`` of a text column; the words are split once and bound, wherever the optimizer moves this."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(_WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPACE))
    return F.transform(F.array(F.struct(text.alias("t"), words.alias("w"))), lambda s: result(s["t"], s["w"]))[0]


@dataclass(frozen=True)
class Rule:
    """``rejects(measures)`` is true where the row goes; ``needs`` are the measures it reads besides ``n_words``."""
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[dict[str, Column]], Column]

    def test(self, text: Column, words: Column) -> Column:
        return self.rejects({m: MEASURES[m](text, words) for m in ("n_words", *self.needs)})


#: the contract's base rules, then those of this operator
RULES = (
    Rule("words", (), lambda m: m["n_words"] < 50),
    Rule("repeats", ("n_repeat_words",), lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", ("n_symbols",), lambda m: 100 * m["n_symbols"] > 20 * m["n_words"]),
    Rule("dup_lines", ("n_dup_lines", "n_lines"), lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
    Rule("word_length", ("word_chars",),
         lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"])),
)
BASE_RULES = ("words", "repeats")


def measure(docs: DataFrame, text_col: str = "text", names=tuple(MEASURES), as_col: str = "measures") -> DataFrame:
    """``docs`` with a struct of the measures ``names`` of every row, no rule applied."""
    return docs.withColumn(as_col, with_words(
        text_col, lambda text, words: F.struct(*[MEASURES[m](text, words).alias(m) for m in names])))


def estimate(docs: DataFrame, text_col: str = "text", rules=RULES, sample_rows: int = 2000,
             seed: int = 9, times: int = 3) -> list[tuple[str, float, float]]:
    """``(rule, cost, selectivity)`` of every rule on a sample of about ``sample_rows`` rows.

    The cost is the least of ``times`` timings of an aggregate over the rule,
    after one that compiles it, less the same for splitting words alone.
    """
    total = docs.count()
    fraction = min(1.0, sample_rows / max(total, 1))
    sample = cut(docs.select(F.col(text_col).alias("text")).sample(fraction=fraction, seed=seed).repartition(1))

    def seconds(test):
        job, spent = sample.agg(F.count_if(with_words("text", test)), F.count(F.lit(1))), []
        row = job.first()
        for _ in range(times):
            began = time.perf_counter()
            job.first()
            spent.append(time.perf_counter() - began)
        return min(spent), row

    plain, _ = seconds(lambda text, words: F.size(words) < 0)
    found = []
    for r in rules:
        spent, row = seconds(lambda text, words, r=r: r.test(text, words))
        found.append((r.name, max(spent - plain, 1e-3), row[0] / row[1] if row[1] else 0.0))
    return found


def cascade_order(estimates: list[tuple[str, float, float]]) -> list[str]:
    """Rules by rejection per cost, best first."""
    return [name for name, cost, share in sorted(estimates, key=lambda e: (-e[2] / e[1], e[0]))]


def cascade(docs: DataFrame, text_col: str = "text", rules=RULES, order: list[str] | None = None,
            sample_rows: int = 2000) -> DataFrame:
    """``docs`` with ``rejected_by``: the first rule of ``order`` that rejects the row, NULL if none does.

    ``order`` is estimated on a sample if not given.  A rule's measures are
    computed only for rows that the rules before it passed.
    """
    order = order or cascade_order(estimate(docs, text_col, rules, sample_rows))
    by_name = {r.name: r for r in rules}

    def first(text, words):
        return F.coalesce(*[F.when(by_name[n].test(text, words), F.lit(n)) for n in order])

    return docs.withColumn("rejected_by", with_words(text_col, first))


def digest_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 2000) -> DataFrame:
    """The contract's columns; ``rejected_by`` is the cascade's verdict over the same measures.

    As every measure is part of the result, nothing is left to skip here: the
    cascade's tests read the measured columns in the estimated order.
    """
    order = cascade_order(estimate(docs, text_col, RULES, sample_rows))
    df = measure(docs.select(F.col(id_col), F.col(text_col)), text_col).select(id_col, "measures.*")
    m = {name: F.col(name) for name in MEASURES}
    by_name = {r.name: r for r in RULES}
    first = F.coalesce(*[F.when(by_name[n].rejects(m), F.lit(n)) for n in order])
    base = by_name["words"].rejects(m) | by_name["repeats"].rejects(m)
    return df.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     base.alias("base_failed"), first.isNull().alias("kept"), first.alias("rejected_by"))
