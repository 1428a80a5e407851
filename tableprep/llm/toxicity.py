"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, documents drawn without regard
to labels are the unlabelled set, and a numpy linear model is fitted to the
risk ``pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))``; where the bracket turns
negative, its gradient is reversed.  The class prior ``pi`` is the toxic share
of the labelled training rows.  Features are the presence of words and word
beginnings (3 to 6 letters) that are over-represented among the positives.

The sample is bounded: ``positives`` and ``unlabelled`` documents, ``features``
features.  Every document is scored, whole text, in one pass.

Defined results: NULL, empty and letterless texts get the score of no
features; without a positive label every score is 0; an id labelled twice is
toxic if any label says so; repeated ids train once and are scored each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, id_remainder, map_slices, with_fields

_LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6)


def word_features(word: str) -> list[str]:
    """``word$`` for the whole word and ``word`` beginnings."""
    return [word + "$", *(word[:k] for k in PREFIXES if len(word) > k)]


def distinct_words(text: str | None) -> set[str]:
    return set(_LETTERS.findall(text.lower())) if text else set()


@dataclass
class Model:
    """``sigmoid(bias + sum of the weights of the features present)``."""
    bias: float = -np.inf
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self, entries: int = 400_000):
        weights, bias = self.weights, self.bias
        found: dict[str, tuple] = {}

        def score(text: str | None) -> float:
            if bias == -np.inf:
                return 0.0
            words = distinct_words(text)
            if len(found) > entries:
                found.clear()
            present = set()
            for w in words:
                fs = found.get(w)
                if fs is None:
                    fs = found[w] = tuple(f for f in word_features(w) if f in weights)
                if fs:
                    present.update(fs)
            z = bias + sum(weights[f] for f in sorted(present))
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return score


def fit_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, l2: float = 1e-4,
             ) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative positive-unlabelled logistic risk (Adam, full batch)."""
    w, b = np.zeros(xp.shape[1]), np.log(prior / (1 - prior))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def sig(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for t in range(1, steps + 1):
        zp, zu = xp @ w + b, xu @ w + b
        sp, su = sig(zp), sig(zu)
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()     # R_u(-) - pi R_p(-)
        gp, gu = prior * sp / len(sp), su / len(su)                                # gradients of both by z
        rest_w, rest_b = xu.T @ gu - xp.T @ gp, gu.sum() - gp.sum()
        pos = prior * (sp - 1) / len(sp)                                           # of pi R_p(+)
        sign = 1 if rest >= 0 else -1
        g = np.append(xp.T @ pos * (rest >= 0) + sign * rest_w + l2 * w, pos.sum() * (rest >= 0) + sign * rest_b)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def training_sample(docs: DataFrame, positive_ids: DataFrame, id_col: str, text_col: str, in_training: Column,
                    positives: int, unlabelled: int) -> DataFrame:
    """``(kind, text)``: kind 1 for positives, 0 for unlabelled; at most so many documents of each.

    An id with several texts gives the one of the smallest hash.
    """
    by_hash = F.xxhash64("id")
    p = positive_ids.select("id").orderBy(by_hash, "id").limit(positives).withColumn("kind", F.lit(1))
    u = (docs.where(in_training & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"))
         .orderBy(by_hash, "id").limit(unlabelled).distinct().withColumn("kind", F.lit(0)))
    ids = cut(p.unionByName(u))                             # bounded by the two parameters: fit to broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "id")
    one = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    return cut(rows.groupBy("id", "kind").agg(one).select("kind", "text"))


def candidate_features(sample: DataFrame, prior: float, features: int, least: int = 5, precision: float = 0.7) -> list[str]:
    """Features most over-represented among positives (z-score of document shares).

    ``pi * p / u`` estimates how many of the documents that show a feature are
    toxic; features below ``precision`` are left out, and so is a beginning of
    which a longer feature covers at least 85 % of the positives: the longer
    one says as much about fewer clean words.
    """
    def make():
        counts: dict[str, list[int]] = {}

        def f(kinds, texts):
            for kind, text in zip(kinds, texts):
                for feature in {x for w in distinct_words(text) for x in word_features(w)}:
                    counts.setdefault(feature, [0, 0])[kind] += 1
            return [], [], []

        f.finish = lambda: (list(counts), [c[1] for c in counts.values()], [c[0] for c in counts.values()])
        return f

    n = {r[0]: r[1] for r in sample.groupBy("kind").count().collect()}
    n_p, n_u = n.get(1, 0), n.get(0, 0)
    if not n_p:
        return []
    df = map_slices(sample, make, "feature string, p long, u long").groupBy("feature").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u")).where(F.col("p") >= least)
    p, u = F.col("p") / n_p, (F.col("u") + 0.5) / (n_u + 1)
    z = (p - u) / F.sqrt(u * (1 - u) / n_p)
    rows = (df.withColumn("z", z).where((F.col("z") > 3) & (prior * p >= precision * u))
            .orderBy(F.desc("z"), "feature").limit(8 * features).select("feature", F.col("p").alias("n")).collect())
    most: dict[str, int] = {}                               # positives of the best longer feature
    for r in rows:
        for k in PREFIXES:
            if k < len(r["feature"]):
                most[r["feature"][:k]] = max(most.get(r["feature"][:k], 0), r["n"])
    return [r["feature"] for r in rows if most.get(r["feature"], 0) < 0.85 * r["n"]][:features]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        in_training: Column | None = None, positives: int = 4000, unlabelled: int = 8000,
        features: int = 1024) -> Model:
    """Model from at most ``positives`` toxic and ``unlabelled`` other documents of the training rows."""
    in_training = F.lit(True) if in_training is None else in_training
    known = (labels.where(in_training).select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
             .where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y")))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0))).first()
    if not toxic:
        return Model()
    prior = float(np.clip(toxic / n, 1e-3, 0.5))
    sample = training_sample(docs, known.where("y = 1"), id_col, text_col, in_training, positives, unlabelled)
    names = candidate_features(sample, prior, features)
    at = {f: i for i, f in enumerate(names)}

    def make():
        def f(kinds, texts):
            return kinds, [sorted({at[x] for w in distinct_words(t) for x in word_features(w) if x in at}) for t in texts]
        return f

    rows = map_slices(sample, make, "kind int, present array<int>").collect()
    sides = {k: [r[1] for r in rows if r[0] == k] for k in (0, 1)}
    if not sides[0] or not sides[1]:
        return Model()
    x = {k: np.zeros((len(v), len(names)), dtype=np.float32) for k, v in sides.items()}
    for k, v in sides.items():
        for i, present in enumerate(v):
            x[k][i, present] = 1
    w, b = fit_nnpu(x[1], x[0], prior)
    return Model(b, dict(zip(names, w.tolist())))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``(doc_id, score, predicted)`` of every document."""
    df = docs.select(id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = sent.value.scorer()

        def f(ids, texts):
            s = [scorer(t) for t in texts]
            return ids, s, [int(x >= threshold) for x in s]
        return f

    return map_slices(df, make, with_fields(df.schema.fields[:1], "score double, predicted int"))


def held_out_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: trained on rows whose id's crc32 mod 3 is not 1, all rows scored."""
    model = fit(docs, labels, id_col, text_col, in_training=id_remainder(id_col, 3) != 1)
    return score(docs, model, id_col, text_col).withColumn("held_out", id_remainder(id_col, 3) == 1).select(
        id_col, "held_out", "score", "predicted")
