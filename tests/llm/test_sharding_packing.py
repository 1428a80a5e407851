import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tableprep.llm import packing as P
from tableprep.llm import sharding as S

from .helpers import EDGE, documents, rows_of, tables


def smallest(sizes, shards):
    def fits(c):
        n, a = 1, 0
        for s in sizes:
            if a + s > c:
                n, a = n + 1, 0
            a += s
        return n <= shards
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        m = (lo + hi) // 2
        lo, hi = (lo, m) if fits(m) else (m + 1, hi)
    return lo


def test_capacity_is_the_smallest_feasible(spark):
    rng = random.Random(1)
    for sizes, shards in (([rng.randint(1, 900) for _ in range(900)], 24), ([5, 5, 900, 5, 5, 5], 4), ([7], 3), ([3] * 50, 24)):
        pos = sorted(rng.sample(range(1 << 60), len(sizes)))
        groups = spark.createDataFrame(list(zip(pos, sizes)), "pos long, bytes long")
        for bits in ((14, 8), (3, 2)):                       # 3, 2: blocks are split again and again
            cuts, capacity = S.plan_cuts(groups, shards, *bits)
            part = Counter()
            for p, s in zip(pos, sizes):
                part[sum(p >= c for c in cuts)] += s
            assert capacity == smallest(sizes, shards) and max(part.values()) <= capacity and len(cuts) == shards - 1


def test_shards_of_documents(spark):
    texts = [*EDGE, *(r.text for r in tables(spark, "documents").collect()), *["copied text"] * 60]
    out = rows_of(S.shard(documents(spark, texts, [None, 1, *range(2, len(texts))])))
    assert len(out) == len(texts)
    slots, of_text = defaultdict(list), {}
    for r, t in zip(out, texts):
        raw = (t or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert of_text.setdefault(t or "", r["shard"]) == r["shard"] and 0 <= r["shard"] < 24
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert S.shard(documents(spark, [])).count() == 0


def check_packing(rows, texts, capacity):
    tok = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    by, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
            part = ids[at:at + capacity]
            assert (r["piece"], r["start"], r["length"], r["ids_crc32"]) == (k, at, len(part), zlib.crc32(part.tobytes()))
            at += len(part)
        assert at == len(ids)
    for v in seq.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= capacity
    return len(seq)


def test_packing_round_trip(spark):
    texts = [*EDGE, "İstanbul ǅ ΑΣ <|endoftext|> it's DON'T a\x1fb 　x ́a 12.5% ñ\x85b ŉx µ ÿ", "é" * 3000,
             *(r.text for r in tables(spark, "documents").collect())]
    rows = rows_of(P.pack_documents(documents(spark, texts)))
    n = check_packing(rows, texts, 2048)
    total = sum(r["length"] for r in rows)
    assert n <= 1.02 * -(-total // 2048) + 1
    small = P.pack_pieces(P.pieces(documents(spark, texts), capacity=64), 64, group_pieces=400)
    check_packing(rows_of(small), texts, 64)
    assert P.pack_documents(documents(spark, [])).count() == 0
    assert P.pack_documents(documents(spark, ["a"] * 3, [None, 1, 1])).count() == 3


def test_sequences_hold_the_ids(spark):
    texts = ["one two three", "four", "five six"]
    docs = documents(spark, texts)
    seq = {r.sequence_id: r.ids for r in P.sequences(docs, P.pack_documents(docs)).collect()}
    tok = Tokenizer.from_file(public_tokenizers.path(P.VOCABULARY))
    for r in P.pack_documents(docs).collect():
        want = [*tok.encode(texts[r.doc_id], add_special_tokens=False).ids, 0]
        assert seq[r.sequence_id][r.offset:r.offset + r.length] == want


def test_rule_takes_the_smallest_sum_of_squares():
    rng = random.Random(2)
    for _ in range(40):
        lengths = sorted((rng.randint(1, 30) for _ in range(80)), reverse=rng.random() < 0.5)
        sequence, offset = P.pack(lengths, 30)
        gaps, fill = {}, {}
        for s, b, o in zip(lengths, sequence.tolist(), offset.tolist()):
            open_ = Counter(g for g in gaps.values() if g)
            cost = {}
            for g in open_:
                if g >= s:
                    c = open_.copy()
                    c[g] -= 1
                    if g > s:
                        c[g - s] += 1
                    cost[g] = sum(v * v for v in c.values())
            if cost:
                assert cost[gaps[b]] == min(cost.values())
            else:
                assert b not in gaps
            assert o == fill.get(b, 0)
            fill[b] = o + s
            gaps[b] = 30 - fill[b]


def test_encoder_same_as_the_tokenizer():
    """Plain texts, texts of many scripts, blanks of all kinds, special strings, long words, and the vocabulary's own parts."""
    path = P.tokenizer_path()
    t = Tokenizer.from_file(path)
    rng = random.Random(8)
    parts = [x.removesuffix("</w>") for x in t.get_vocab(with_added_tokens=False)]
    plain = [x for x in parts if x.isascii() and x.isalpha()]
    latin = [chr(c) for c in range(0x180)]
    odd = [*latin, "\u0301", "İ", "ß", "ﬁ", "日本", "Привет", "\U0001f600", "'S", "'ll", "<|endoftext|>", "<|", "\x1c", "\u2028", "\u3000"]
    texts = [None, "", " ", "\n\t", "a" * 20_000, "it's we'LL O'Neil 'sa ''s", "x" * 300 + "\xa0" + "9" * 300, "Ünïcödé ÀÉ ŒÞ ǅ"]
    texts += [" ".join("".join(rng.choice(plain) for _ in range(rng.randrange(1, 4))) for _ in range(300)) for _ in range(60)]
    texts += ["".join(rng.choice(latin + plain[:500] + [" "] * 60) for _ in range(400)) for _ in range(60)]
    texts += ["".join(rng.choice(odd + plain[:500] + [" "] * 60) for _ in range(200)) for _ in range(60)]
    want = [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]
    got = [np.frombuffer(x, dtype="<u4").tolist() for x in P.ChunkEncoder(path).encode(texts)]
    for x, a, b in zip(texts, got, want):
        assert a == b, x
