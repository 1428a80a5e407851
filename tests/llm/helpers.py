"""Small tables and plain re-implementations for the operator tests."""

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")
#: NULL, empty, blank, one word, repeated, clashing case, other scripts, long
EDGE = [None, "", " \n\t ", "one", "One two", "ÀB éa 東京 mixed", "a b c a b c a b c", "same text here", "same text here",
        "x" * 5000, " ".join(f"w{i % 700}" for i in range(20_000)), "line\nline\n\nline\n"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, texts, ids=None, extra=""):
    """A documents table whose further columns are called like the operators' own."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), 7, "x", 0.5) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "shard int, fingerprint string, score double")


def rows_of(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is not None, r[key]))


def tables(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
