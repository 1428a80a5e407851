import random
from collections import Counter

from pyspark.sql import functions as F

from tableprep.llm import quality as Q

from .helpers import EDGE, WORD, documents, rows_of, tables


def plain(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    keys = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(keys)
    rep = len({i + j for i, k in enumerate(keys) if n[k] > 1 for j in range(3)})
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": rep}


TEXTS = [*EDGE, "a b c " * 40, "# * $ word " * 30, "\n".join(["one line of words"] * 30 + [f"other {i}" for i in range(5)]),
         "\x85 \xa0 odd\x0bblanks\x0chere\r\n", "tail a b c d a b c"]


def test_measures_match_plain_counts(spark):
    docs = documents(spark, TEXTS)
    out = rows_of(Q.measure(docs).select("doc_id", "measures.*"))
    for r, t in zip(out, TEXTS):
        r.pop("doc_id")
        assert r == plain(t), repr(t)[:60]
    given = tables(spark, "documents")
    texts = {r.doc_id: r.text for r in given.collect()}
    for r in Q.measure(given).select("doc_id", "measures.*").collect():
        d = r.asDict()
        assert plain(texts[d.pop("doc_id")]) == d


def test_cascade_verdict_does_not_depend_on_the_order(spark):
    docs = documents(spark, TEXTS)
    names = [r.name for r in Q.RULES]
    one = rows_of(Q.cascade(docs, order=names).select("doc_id", F.col("rejected_by").isNull().alias("kept")))
    two = rows_of(Q.cascade(docs, order=names[::-1]).select("doc_id", F.col("rejected_by").isNull().alias("kept")))
    assert one == two == [{"doc_id": r["doc_id"], "kept": r["kept"]} for r in rows_of(Q.digest_columns(docs))]
    kept = Q.cascade(docs, order=names).where("rejected_by IS NULL")
    assert kept.count() == sum(r["kept"] for r in one)


def test_order_is_by_rejection_per_cost_and_empty_tables_work(spark):
    assert Q.cascade_order([("a", 1.0, 0.1), ("b", 0.1, 0.1), ("c", 1.0, 0.0), ("d", 5.0, 0.0)]) == ["b", "a", "c", "d"]
    empty = documents(spark, [])
    assert Q.digest_columns(empty).count() == 0 and Q.cascade(empty).count() == 0


def test_plan_has_no_python(spark):
    plan = Q.digest_columns(tables(spark, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_windows_that_share_hash_bits(spark, monkeypatch):
    """Hashes of two values: different windows are neighbours everywhere, and equal ones are not."""
    real = F.xxhash64
    monkeypatch.setattr(Q.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(2)) if len(c) == 3 else real(*c))
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 60))) for _ in range(200)] + TEXTS[:6]
    out = rows_of(Q.measure(documents(spark, texts), names=("n_words", "n_repeat_words")).select("doc_id", "measures.*"))
    assert [r["n_repeat_words"] for r in out] == [plain(t)["n_repeat_words"] for t in texts]


def test_a_dear_rule_moves_back(spark):
    """Two rules that reject the same rows, one of which does much more for it."""
    docs = documents(spark, [" ".join(f"w{(i * k) % 97}" for i in range(400)) for k in range(300)])
    cheap = Q.Rule("z_cheap", (), lambda m: m["n_words"] >= 100)
    dear = Q.Rule("a_dear", ("n_repeat_words",), lambda m: (m["n_words"] >= 100) & (m["n_repeat_words"] >= 0))
    found = Q.estimate(docs, rules=(dear, cheap))
    assert {n: s for n, _, s in found} == {"z_cheap": 1.0, "a_dear": 1.0}
    assert Q.cascade_order(found) == ["z_cheap", "a_dear"]
