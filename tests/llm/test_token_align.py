import hashlib
import random
from collections import Counter

import pytest

from tableprep.llm import queries
from tableprep.llm import token_align as T

from .helpers import EDGE, SF, documents, rows_of, tables

ODD = [" " * 3_000_000 + "x", "\n\n   \t a  ", "it's we'LL 's 12a3 ³²",
       "▁a b", "a<|endoftext|>b <s> </s> <unk> <0x41>", "  two  blanks ", "tab\tnew\n\nline  x", "ﬁ é café",
       "\U0001f600\U0001f600 中文文本 рус", "\x00\x01 \x7f", "a" * 300, " ", "　", "é̂"]


def plain(texts):
    """The contract by sets of byte offsets, from its wording."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer, pre_tokenizers
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    # the alphabet from the library: what each byte of a two-byte character is pre-tokenised to
    letters = {}
    for c in map(chr, [*range(0x800), *range(0x800, 0xD800, 0x100), *range(0xE000, 0x110000, 0x100)]):
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
        letters.update(zip(shown, c.encode()))
    docs = []
    for text in texts:
        docs.append(None)
        if not text:
            continue
        raw = (" " + text).encode()
        e = a.encode(" " + text, add_special_tokens=False)
        ta = [(i, bytes(letters[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        tb = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
              for i, p in zip(b.encode(text), b.encode(text, out_type=str))]
        if b"".join(x for _, x in ta) != raw or b"".join(x for _, x in tb) != raw:
            continue

        def ends(tokens):
            at, out = 0, {}
            for k, (_, x) in enumerate(tokens):
                at += len(x)
                out[at] = k
            return out
        ea, eb = ends(ta), ends(tb)
        groups, links, i, j = [], [], 0, 0
        for at in sorted(set(ea) & set(eb)):
            groups.append((ta[i:ea[at] + 1], tb[j:eb[at] + 1]))
            i, j = ea[at] + 1, eb[at] + 1
            links.append((ta[i - 1][0], tb[j - 1][0]))
        docs[-1] = (len(ta), len(tb), groups, links)
    count = Counter(x for d in docs if d for x in d[3])
    top = {}
    for (_, y), n in count.items():
        top[y] = max(n, top.get(y, 0))
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        text = ";".join(",".join(str(x) for x, _ in g) + "|" + ",".join(str(x) for x, _ in h) for g, h in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(count[x] == top[x[1]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def random_texts(n, seed=2):
    rng = random.Random(seed)
    parts = ["the", "a", "quick", "xyzzy", "1234", " ", "  ", "\n", "\t", "café", "日本", "don't", "...", "é", "▁", "A", "\U0001f680"]
    return ["".join(rng.choice(parts) + rng.choice(["", " ", " ", " "]) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("listed", [100_000, 5, 0])
def test_same_as_plain(spark, listed):
    texts = EDGE + ODD + random_texts(150) + ["same text here"] * 30
    found = rows_of(T.link_figures(documents(spark, texts).repartition(4), listed=listed))
    assert [[r[c] for c in COLUMNS] for r in found] == [list(x) for x in plain(texts)]


def test_repeated_and_null_ids(spark):
    docs = documents(spark, ["one two", "one two", "three", None], ids=[1, 1, None, 1])
    found = sorted([tuple(r[c] for c in COLUMNS) for r in T.link_figures(docs, listed=2).collect()])
    assert found == sorted(plain(["one two", "one two", "three", None]))


def test_empty_table(spark):
    assert T.link_figures(documents(spark, [])).collect() == []


def test_windows_do_not_depend_on_their_neighbours():
    texts = random_texts(200, seed=9) + ODD
    path = T.tokenizer_path
    one = T.Aligner(path(T.BYTE_BPE), path(T.PIECES))
    for x, y in zip(one.align(texts), [one.align([t])[0] for t in texts]):
        assert (x is None) == (y is None)
        if x:
            assert x[:3] == y[:3] and x[3].tolist() == y[3].tolist()
    assert [len(p[2].split(b";")) for p in one.align(["it is so. it is so.", "it is so."])] == [8, 4]


def test_windows_that_share_a_hash():
    texts = random_texts(60, seed=4)
    path = T.tokenizer_path
    plain_, clash = (T.Aligner(path(T.BYTE_BPE), path(T.PIECES)) for _ in range(2))
    clash.mix = clash.mix * 0                               # every window has the same hash
    for x, y in zip(plain_.align(texts), clash.align(texts)):
        assert (x is None) == (y is None) and (x is None or (x[:3] == y[:3] and x[3].tolist() == y[3].tolist()))


def test_whole_table(spark):
    docs = tables(spark, "documents").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op12_token_alignment"](spark, SF).collect()}
    assert found == dict(zip([r.doc_id for r in docs], plain([r.text for r in docs])))
