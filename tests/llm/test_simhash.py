import random

import xxhash

from tableprep.llm import simhash as H

from .helpers import EDGE, WORD, documents, lower, rows_of, tables


def plain_fingerprint(text):
    w = WORD.findall(lower(text))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, distance=3):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for k, i in enumerate(ids):
        r = find(k)
        low[r] = i if r not in low else min(low[r], i)
    return [low[find(k)] for k in range(len(ids))]


def test_documents_match_brute_force(spark):
    rows = sorted((r.doc_id, r.text) for r in tables(spark, "documents").collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([i for i, _ in rows], fps)
    out = rows_of(H.near_duplicates(tables(spark, "documents")))
    assert [(r["fingerprint"], r["component_id"]) for r in out] == [(f"{f:016x}", c) for f, c in zip(fps, want)]


def test_edges(spark):
    out = rows_of(H.near_duplicates(documents(spark, EDGE)))
    fps = [plain_fingerprint(t) for t in EDGE]
    assert [r["fingerprint"] for r in out] == [f"{f:016x}" for f in fps]
    assert [r["component_id"] for r in out] == plain_components(range(len(EDGE)), fps)
    assert H.near_duplicates(documents(spark, [])).count() == 0
    ids = [None, 5, 5, None]
    out = rows_of(H.near_duplicates(documents(spark, ["p q r s", "p q r s", "p q r s", "only one of these"], ids)))
    assert sorted((r["component_id"] is None, r["component_id"]) for r in out) == [(False, 5), (False, 5), (False, 5), (True, None)]


def _planted(rng, n):
    fps = set()
    for _ in range(n):
        f = rng.getrandbits(64)
        for _ in range(rng.choice([0, 0, 1, 3, 12])):            # chains of near fingerprints
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
        fps.add(f)
    base = rng.getrandbits(64)
    fps |= {base ^ rng.getrandbits(10) for _ in range(150)}       # a dense group in few bits
    return sorted(fps)


def test_links_connect_what_brute_force_links(spark):
    rng = random.Random(3)
    for hot_rows in (20_000, 20):                                 # 20: hot keys get longer keys
        fps = _planted(rng, 250)
        signed = [f - (1 << 64) if f >> 63 else f for f in fps]
        df = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
        roots = {r.node: r.root for r in H.components(H.links(df, 3, 8, hot_rows)).collect()}
        want = plain_components(signed, fps)
        assert [roots.get(s, s) for s in signed] == want


def test_keep_one_keeps_one_row_of_each_group(spark):
    texts = [*EDGE, "same text here", "p q r s", "p q r s"]
    ids = [*range(len(EDGE)), 7, None, None]
    docs = documents(spark, texts, ids)
    kept = H.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(plain_fingerprint(r.text) for r in kept.collect())
    assert got == sorted({plain_fingerprint(t) for t in texts}) or len(got) < len({plain_fingerprint(t) for t in texts})
    assert sum(r.text == "same text here" for r in kept.collect()) == 1
    assert H.keep_one(documents(spark, [])).count() == 0
