"""Secret scans: Aho-Corasick keyword prefilter, anchored expressions near hits, embedded checksums.

One automaton over all keywords runs over the lower-cased bytes of a text;
only where a keyword ends is the kind's expression tried, anchored at the
keyword's start.  The hex kind has no keyword: its prefilter is a run of 16
bytes of the hex class.  Kinds whose tokens carry a checksum (``github``,
``npm``: six base-62 digits of the CRC-32 of the random part) count only
where the checksum holds.

Defined results: NULL or empty texts have no spans; rows are kept one for
one; offsets are code points, ends exclusive; matches of one kind do not
overlap, matches of different kinds may.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame

from .common import ASCII_LOWER, map_slices, with_fields

#: kinds in the order of the contract, then the checksum kinds
KINDS = ("assign", "access", "hex", "github", "npm")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_ASSIGN = re.compile(rb"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
                     rb"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?"
                     rb"(?P<value>[A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_GITHUB = re.compile(rb"gh[pousr]_(?P<value>[A-Za-z0-9]+)")
_NPM = re.compile(rb"npm_(?P<value>[A-Za-z0-9]+)")
#: fixed values: keyword -> kind
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
            "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github",
            "ghs_": "github", "ghr_": "github", "npm_": "npm"}
_HEX_CLASS = bytes(104 if 48 <= b <= 57 or 97 <= b <= 102 else 32 for b in range(256))
_HEX_RUN = b"h" * 16


def base62_crc32(value: bytes) -> str:
    """Six base-62 digits of the CRC-32 of ``value``."""
    n, out = zlib.crc32(value), ""
    while n:
        n, r = divmod(n, 62)
        out = _BASE62[r] + out
    return out.rjust(6, "0")


def _checksum_holds(m: re.Match) -> bool:
    v = m["value"]
    return len(v) == 36 and base62_crc32(v[:30]).encode() == v[30:]


#: kind -> (anchored expression, test of a match)
_RULES = {
    "assign": (_ASSIGN, lambda m: len(m["value"]) >= 12),
    "access": (_ACCESS, lambda m: m.end() - m.start() >= 18),
    "github": (_GITHUB, _checksum_holds),
    "npm": (_NPM, _checksum_holds),
}


def automaton():
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def find_spans(text: str | None, auto) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of one text by start, then kind as in ``KINDS``."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    found = []
    hits: dict[str, list[int]] = {}
    for end, (size, kind) in auto.iter(raw.translate(ASCII_LOWER).decode("latin-1")):
        hits.setdefault(kind, []).append(end - size + 1)
    for kind, starts in hits.items():
        pattern, holds = _RULES[kind]
        free = 0
        for s in sorted(set(starts)):
            m = pattern.match(raw, s) if s >= free else None
            if m:
                free = m.end()
                if holds(m):
                    found.append((s, KINDS.index(kind), free))
    runs = raw.translate(_HEX_CLASS)
    at = runs.find(_HEX_RUN)
    while at >= 0:
        end = _HEX.match(raw, at).end()
        found.append((at, KINDS.index("hex"), end))
        at = runs.find(_HEX_RUN, end)
    found.sort()
    if not found or len(raw) == len(text):
        return [(KINDS[k], a, b) for a, k, b in found]
    point, prev, points = 0, 0, {}
    for p in sorted({x for a, _, b in found for x in (a, b)}):      # bytes to code points, one walk
        point += len(raw[prev:p].decode("utf-8", "surrogatepass"))
        points[p], prev = point, p
    return [(KINDS[k], points[a], points[b]) for a, k, b in found]


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """``text`` with every (merged) span replaced by ``[kind]`` of its first match."""
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, a, b = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < b:
            i += 1
            b = max(b, spans[i][2])
        out += [text[at:a], f"[{kind}]"]
        at, i = b, i + 1
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, kinds, starts, ends)`` per document: parallel arrays of its spans."""
    df = docs.select(id_col, text_col)
    schema = with_fields(df.schema.fields[:1], "kinds array<string>, starts array<bigint>, ends array<bigint>")

    def make():
        auto = automaton()

        def f(ids, texts):
            spans = [find_spans(t, auto) for t in texts]
            return ids, *([[x[k] for x in s] for s in spans] for k in range(3))
        return f

    return map_slices(df, make, schema)


def redact_secrets(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the spans of ``text_col`` replaced; ``n_chars_col``, if there, follows the changed texts."""
    names = docs.columns
    at = names.index(text_col)
    size = names.index(n_chars_col) if n_chars_col in names else -1

    def make():
        auto = automaton()

        def f(*cols):
            cols = list(cols)
            new = [redact(t, find_spans(t, auto)) for t in cols[at]]
            if size >= 0:
                cols[size] = [n if t == old else len(t) for n, t, old in zip(cols[size], new, cols[at])]
            cols[at] = new
            return cols
        return f

    return map_slices(docs, make, docs.schema)


def digest_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's columns: counts per base kind, digest of the base spans, all spans."""
    found = scan_secrets(docs, id_col, text_col)
    schema = with_fields(found.schema.fields[:1],
                         "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")

    def make():
        def f(ids, kinds, starts, ends):
            rows = [list(zip(*x)) for x in zip(kinds, starts, ends)]
            counts = [[sum(k == base for k in ks) for ks in kinds] for base in KINDS[:3]]
            named = [[(k, f"{k}:{a}:{b}") for k, a, b in r] for r in rows]
            base = [hashlib.sha256(",".join(s for k, s in r if k in KINDS[:3]).encode()).hexdigest() for r in named]
            return ids, *counts, base, [",".join(s for _, s in r) for r in named]
        return f

    return map_slices(found, make, schema)
