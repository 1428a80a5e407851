import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np

from tableprep.llm import hmm_lm as M
from tableprep.llm import langid as L
from tableprep.llm import toxicity as T
from tableprep.llm.common import id_remainder

from .helpers import EDGE, WORD, documents, lower, rows_of, tables

SMALL = {"states": 3, "sample_docs": 300, "guess_docs": 60, "guess_rounds": 2, "frequent": 400, "own": 100, "shared": 300}


def tiny_model(states=3, classes=5, seed=0):
    r = np.random.default_rng(seed)
    m = M.Model([], 0, classes - 1)
    m.start, m.move = r.dirichlet(np.ones(states)), r.dirichlet(np.ones(states), states)
    m.emit = r.dirichlet(np.ones(classes), states).T
    return m


def test_forward_is_the_sum_over_all_paths():
    m = tiny_model()
    seqs = [np.array([0, 3, 1, 4, 2]), np.array([2, 2, 0]), np.array([1])]
    for s, got in zip(seqs, M.forward(seqs, m)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(s)):
            p = m.start[path[0]] * m.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= m.move[path[t - 1], path[t]] * m.emit[s[t], path[t]]
            total += p
        assert math.isclose(got, math.log(total), rel_tol=1e-12)


def test_baum_welch_counts_are_expectations_and_raise_the_likelihood():
    m = tiny_model()
    r = np.random.default_rng(1)
    seqs = sorted((r.integers(0, 5, n) for n in r.integers(1, 40, 30)), key=lambda s: -len(s))
    before = None
    for _ in range(5):
        start, move, emit = M.expected_counts(seqs, m)
        assert math.isclose(start.sum(), len(seqs)) and math.isclose(emit.sum(), sum(map(len, seqs)))
        assert math.isclose(move.sum(), sum(len(s) - 1 for s in seqs))
        now = M.forward(seqs, m).sum()
        assert before is None or now >= before - 1e-9
        before = now
        m.start, m.move = start / start.sum(), move / move.sum(axis=1, keepdims=True)
        m.emit = emit / emit.sum(axis=0)


def test_long_text_among_short_ones_takes_memory_for_its_tokens_only():
    import tracemalloc
    m = tiny_model()
    r = np.random.default_rng(3)
    seqs = [r.integers(0, 5, n) for n in [5000] + [2] * 400 + [1]]
    want = [M.expected_counts([s], m, likelihood=True) for s in seqs]
    tracemalloc.start()
    got = M.expected_counts(seqs, m, likelihood=True)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 5_000_000                                 # 5801 tokens; 2 million cells if padded
    for x, *parts in zip(got, *want):
        assert np.allclose(x, sum(parts), rtol=1e-9)
    for x, y in zip(got, M.expected_counts(seqs, m, likelihood=True, block=7)):
        assert np.allclose(x, y, rtol=1e-12)


def test_batches_hold_their_tokens_without_padding(monkeypatch):
    monkeypatch.setattr(M, "BATCH_TOKENS", 1000)
    seqs = [np.zeros(n, dtype=int) for n in [3, 900, 1, 1500, 40, 40, 20]]
    assert list(M.batches(seqs)) == [[3], [1, 4, 5, 6], [0, 2]]
    assert list(M.batches([])) == []
    flat, who, first = M.packed([np.array([1, 2, 3]), np.array([4, 5]), np.array([6])])
    assert flat.tolist() == [1, 4, 6, 2, 5, 3] and who.tolist() == [0, 1, 2, 0, 1, 0] and first.tolist() == [0, 3, 5, 6]


def test_words_of_a_slice_are_those_of_each_text():
    import pyarrow as pa
    texts = EDGE + ["  two  ends\t", "\x0b\x0c\r", "a\x1cb\x1f \x85 \xa0c\u2028d", "É é İI K", "\x00 \x00a", " x", "é"]
    for kind in (pa.string(), pa.large_string()):
        for part in (pa.array(texts, kind), pa.array(texts, kind).slice(3, 9), pa.array([None, "", " "], kind), pa.array([], kind)):
            text, places, found = M.words_of_slice(part)
            words = found.to_pylist()
            model = M.Model(words[::3], 1, 97)
            assert M.Coder(model).codes(found).tolist() == [
                words.index(w) // 3 if w in words[::3] else len(words[::3]) + model.shared_class(w) for w in words]
            assert model.shared_classes(found[2:]).tolist() == [model.shared_class(w) for w in words[2:]]
            got = [[] for _ in range(len(part))]
            for i, p in zip(text.tolist(), places.tolist()):
                got[i].append(words[p])
            assert got == [M.words_of(t) for t in part.to_pylist()] and len(set(words)) == len(words)


def plain_base(rows):
    tokens = [[*WORD.findall(lower(t)), None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for h, ws in zip(held, tokens) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(h, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
            for h, w in zip(held, tokens)]


def test_base_score_and_model_score(spark):
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(r.doc_id + 100, r.text) for r in tables(spark, "documents").collect()]
    rows += [(150, rows[62][1]), (150, "again again"), (None, "no id at all")]
    out = M.score(documents(spark, [t for _, t in rows], [i for i, _ in rows]), id_remainder("doc_id", 7) != 2, **SMALL).collect()
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.held_out, r.train_tokens, round(r.base_score, 6)) for r in out)
    want = sorted((str(i), b[1], b[2], b[0], b[3], round(b[4], 6)) for (i, _), b in zip(rows, plain_base(rows)))
    assert got == want
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.score <= 0 for r in out)


def test_own_classes_are_the_words_of_the_highest_exact_counts(spark):
    texts = [f"common w{i % 7} text" for i in range(60)] + ["seldom " * 90 + "x y z"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)
    want = [w.encode() for w, _ in sorted(Counter(" ".join(texts).split()).items(), key=lambda x: (-x[1], x[0]))[:3]]
    assert want == [b"seldom", b"common", b"text"]
    model = M.train(docs, **SMALL | {"sample_docs": 5, "guess_docs": 5, "own": 3, "frequent": 20})
    assert model.frequent[:model.own] == want and len(set(model.frequent)) == len(model.frequent)
    assert sum(model.class_tokens) == sum(len(t.split()) + 1 for t in texts)
    assert M.frequent_words(docs.select("text"), 3, entries=2) == want


def test_rounds_over_all_texts_raise_the_likelihood(spark):
    docs = tables(spark, "documents").selectExpr("doc_id AS id", "text")
    logs = M.train(docs, **SMALL | {"guess_docs": 10}).likelihoods
    assert len(logs) >= 3 and logs == sorted(logs) and logs[-1] > logs[0]


def test_scores_without_training_rows_or_rows(spark):
    assert M.score(documents(spark, []), id_remainder("doc_id", 7) != 2, **SMALL).count() == 0
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    out = M.score(documents(spark, ["a b"] * len(held), held), id_remainder("doc_id", 7) != 2, **SMALL).collect()
    assert len(out) == len(held) and all(r.base_score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in out)


def test_viterbi_is_the_best_path_and_the_shortcut_agrees():
    r = np.random.default_rng(4)
    for _ in range(60):
        n, k, p = int(r.integers(1, 7)), 3, float(r.uniform(0, 4))
        s = r.normal(size=(n, k)) * 2
        best = max(itertools.product(range(k), repeat=n),
                   key=lambda y: sum(s[i, a] for i, a in enumerate(y)) - p * sum(a != b for a, b in zip(y, y[1:])))
        value = lambda y: sum(s[i, a] for i, a in enumerate(y)) - p * sum(a != b for a, b in zip(y, y[1:]))
        got = L.viterbi([s], p)[0]
        assert math.isclose(value(got), value(best), abs_tol=1e-9)
        top = int(s.sum(axis=0).argmax())
        if L.one_language(s, top, p):
            assert math.isclose(value([top] * n), value(best), abs_tol=1e-9)


def test_one_language_shortcut_is_plain_viterbi():
    a, c, b = [0.0] * 5 + [-7.0] * 5, [-3.0] * 10, [-7.0] * 5 + [0.0] * 5
    s = np.array([a, b, c]).T
    assert not L.one_language(s, 2, 20.0) and L.viterbi([s], 20.0)[0].tolist() == [0] * 5 + [1] * 5
    r = np.random.default_rng(8)
    taken = 0
    for _ in range(3000):
        n, p = int(r.integers(1, 16)), float(r.uniform(0, 12))
        s = np.repeat(r.normal(size=(3, 3)), 5, axis=0)[:n] * 2 + r.normal(size=(n, 3)) / 2
        got, best = L.viterbi([s], p)[0], int(s.sum(axis=0).argmax())
        if L.one_language(s, best, p):
            taken += 1
            value = s[np.arange(n), got].sum() - p * np.count_nonzero(np.diff(got))
            assert math.isclose(s[:, best].sum(), value, abs_tol=1e-9)
    assert taken > 300


def test_rare_language_stays_a_candidate_of_its_script(spark):
    rng = random.Random(2)
    word = {"big": lambda: "".join(rng.choice("abcde") for _ in range(6)), "rare": lambda: "".join(rng.choice("uvwxy") for _ in range(6))}
    rows = [(i, " ".join(word["big"]() for _ in range(500)), "big") for i in range(100)]
    rows += [(1000, " ".join(word["rare"]() for _ in range(100)), "rare")]         # 0.2 % of the words
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [" ".join(word[k]() for _ in range(30)) for k in ("rare", "big", "rare")]
    assert [r["lang_pred"] for r in rows_of(L.identify(documents(spark, texts), model))] == ["rare", "big", "rare"]


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = [r for r in L.held_out_predictions(docs).collect() if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in out) >= 0.98 * len(out) > 0
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges_and_spans(spark):
    rng = random.Random(1)
    word = {"xx": lambda: "".join(rng.choice("abc") for _ in range(6)), "yy": lambda: "".join(rng.choice("xyz") for _ in range(6)),
            "ру": lambda: "".join(rng.choice("абв") for _ in range(6))}
    rows = [(i, " ".join(word[k]() for _ in range(40)), k) for i, k in enumerate([*word] * 20)]
    train = spark.createDataFrame([*rows, (90, None, "xx"), (91, "no lang", None)], "doc_id long, text string, lang string")
    model = L.fit(train)
    assert model.langs == sorted(word)
    mixed = " ".join([word["xx"]() for _ in range(30)] + [word["yy"]() for _ in range(20)])
    texts = [None, "", "123 _ ½ !", mixed, "бав " * 9, "𐍈𐍈"]
    out = rows_of(L.identify(documents(spark, texts), model))
    assert [r["lang_pred"] for r in out[:3]] == ["und"] * 3 and [r["score"] for r in out[:3]] == [0.0] * 3
    assert out[3]["lang_pred"] == "xx" and out[3]["score"] == 0.6
    assert [(s["first"], s["end"], s["lang"]) for s in out[3]["spans"]] == [(0, 30, "xx"), (30, 50, "yy")]
    assert out[4]["lang_pred"] == "ру" and out[5]["lang_pred"] in word
    none = L.held_out_predictions(train.where("doc_id < 0"))
    assert none.count() == 0
    assert all(r["lang_pred"] == "und" for r in rows_of(L.identify(documents(spark, texts), L.fit(train.where("doc_id < 0")))))


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    y = {r.doc_id: r.toxic for r in labels.collect()}
    out = [r for r in T.held_out_scores(docs, labels).collect() if r.held_out and r.doc_id in y]
    s, t = np.array([r.score for r in out]), np.array([y[r.doc_id] for r in out])
    rank = s.argsort().argsort()
    auc = (rank[t == 1].mean() - (t.sum() - 1) / 2) / (len(t) - t.sum())
    assert auc > 0.93
    assert np.mean([r.predicted for r in out if y[r.doc_id] == 0]) < 0.02
    assert np.mean([r.predicted for r in out if y[r.doc_id] == 1]) > 0.7
    assert all(r.predicted == (r.score >= 0.7) for r in out)


def test_nonnegative_risk_finds_the_positive_direction():
    r = np.random.default_rng(0)
    xp = np.c_[np.ones(300), r.integers(0, 2, 300)]
    pos = r.random(2000) < 0.2
    xu = np.c_[pos, r.integers(0, 2, 2000)].astype(float)
    w, b = T.fit_nnpu(xp, xu, 0.2)
    assert w[0] + b > 0 > b and abs(w[1]) < abs(w[0]) / 3


def test_toxicity_edges(spark):
    docs = documents(spark, EDGE)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = rows_of(T.held_out_scores(docs, none))
    assert len(out) == len(EDGE) and all(r["score"] == 0 and r["predicted"] == 0 for r in out)
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (None, 1, 1), (3, 1, None), (7, 0, 1)], "doc_id long, quality int, toxic int")
    out = rows_of(T.held_out_scores(docs, labels))
    assert len(out) == len(EDGE) and all(0 <= r["score"] <= 1 for r in out)
    assert T.held_out_scores(documents(spark, []), labels).count() == 0


def test_one_language_by_blocks_of_words():
    rng = np.random.default_rng(12)
    seen = set()
    for _ in range(400):
        s = rng.integers(-6, 7, (int(rng.integers(1, 30)), 3)).astype(float)
        best, p = int(s.sum(axis=0).argmax()), float(rng.integers(1, 60))
        got = {L.one_language(s, best, p, block) for block in (1, 2, 3, 7, 100)}
        assert len(got) == 1
        seen |= got
    assert seen == {True, False}


def test_memory_of_a_very_long_text_of_two_languages():
    import tracemalloc
    n, k = 100_000, 30
    s = np.zeros((n, k))
    s[:n // 2, 0], s[n // 2:, 1] = 5.0, 5.0
    tracemalloc.start()
    assert not L.one_language(s, 0, 20.0)
    labels = L.viterbi([s], 20.0)[0]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert labels.tolist() == [0] * (n // 2) + [1] * (n // 2)
    assert peak < s.nbytes                                  # no second table of scores


def test_batches_of_mixed_texts_are_bounded(monkeypatch):
    """One long text among short ones does not pad these to its length."""
    sizes = []
    real = L.viterbi
    monkeypatch.setattr(L, "viterbi", lambda s, p: sizes.append(len(s) * len(s[0]) * s[0].shape[1]) or real(s, p))
    monkeypatch.setattr(L, "one_language", lambda *a: False)
    monkeypatch.setattr(L, "CELLS", 3000)
    model = L.Model(["a", "b"], np.random.default_rng(0).random((65536, 2)), np.ones((64, 2), dtype=bool))
    labels = L.Labeller(model, 1.0).label(["one two three " * 700] + ["four five six"] * 80 + [None])
    assert [len(x) for x in labels] == [2100] + [3] * 80 + [0]
    assert max(sizes) <= 2100 * 2 and len(sizes) > 1


def test_samples_do_not_depend_on_the_order_of_repeated_ids(spark):
    """Ids that occur with several texts give the same text whatever the order of the rows."""
    from pyspark.sql import functions as F
    from tableprep.llm import toxicity as X
    rows = [(i % 40, f"text {i}" if i % 9 else None) for i in range(400)]
    got = set()
    for order in (rows, rows[::-1], rows[1::2] + rows[::2]):
        docs = documents(spark, [t for _, t in order], [i for i, _ in order]).repartition(3)
        ids = docs.select(F.col("doc_id").alias("id")).where("id < 10").distinct()
        sample = X.training_sample(docs, ids, "doc_id", "text", F.lit(True), 5, 20)
        _, few = M.word_list(docs.select(F.col("doc_id").alias("id"), "text"), sample_docs=30, guess_docs=10)
        got.add((tuple(sorted(map(str, sample.collect()))), tuple(sorted(map(str, few.collect())))))
    assert len(got) == 1
