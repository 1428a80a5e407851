import corpus_pipeline as C
from tableprep.llm import secret_scan as S

from .helpers import SF, tables
from .test_quality import plain
from .test_secrets_and_leaks import plain_hits, plain_spans
from .test_sharding_packing import check_packing
from .test_simhash import plain_components, plain_fingerprint


def rejected(m):
    return (m["n_words"] < 50 or 2 * m["n_repeat_words"] > m["n_words"] or 5 * m["n_symbols"] > m["n_words"]
            or 2 * m["n_dup_lines"] > m["n_lines"] or not 2 * m["n_words"] <= m["word_chars"] <= 20 * m["n_words"])


def test_stages_match_a_plain_run(spark):
    docs = tables(spark, "documents")
    have = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in tables(spark, "benchmark").collect()]
    names = [n for n, _ in C.STAGES]
    assert names == ["quality rules", "simhash near-dedup", "benchmark decontamination", "secret scans", "best-fit packing"]
    stage = dict(C.STAGES)
    kept = {i: t for i, t in have.items() if not rejected(plain(t))}
    got = stage["quality rules"](spark, docs, SF)
    assert {r.doc_id: r.text for r in got.collect()} == kept
    ids = sorted(kept)
    roots = plain_components(ids, [plain_fingerprint(kept[i]) for i in ids])
    one = {r: kept[r] for r in roots}
    got = stage["simhash near-dedup"](spark, got, SF)
    assert {r.doc_id: r.text for r in got.collect()} == one and got.columns == docs.columns
    clean = {i: t for i, t in one.items() if not plain_hits(t, items)[4]}
    got = stage["benchmark decontamination"](spark, got, SF)
    assert {r.doc_id: r.text for r in got.collect()} == clean and got.columns == docs.columns
    auto = S.automaton()
    open_ = {i: S.redact(t, S.find_spans(t, auto)) for i, t in clean.items()}
    got = stage["secret scans"](spark, got, SF)
    assert {r.doc_id: r.text for r in got.collect()} == open_ and got.columns == docs.columns
    assert not any(plain_spans(t) for t in open_.values())
    final = [r.asDict() for r in stage["best-fit packing"](spark, got, SF).collect()]
    order = sorted(open_)
    for r in final:
        r["doc_id"] = order.index(r["doc_id"])
    check_packing(final, [open_[i] for i in order], 2048)


def test_stages_keep_columns_called_like_their_own(spark):
    docs = tables(spark, "documents").selectExpr(
        "doc_id", "'a' AS rejected_by", "doc_id + 1 AS n_words", "'s' AS spans", "text", "n_chars", "doc_id + 2 AS items")
    want = {r.doc_id: tuple(r) for r in docs.collect()}
    for name, stage in C.STAGES[:1] + C.STAGES[2:3]:
        got = stage(spark, docs, SF)
        rows = got.collect()
        assert got.columns == docs.columns and rows and all(tuple(r) == want[r.doc_id] for r in rows), name


def test_run_gives_the_last_stage(spark):
    out = C.run(spark, SF)
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(out.columns)
    assert out.count() > 0
