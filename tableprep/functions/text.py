"""Column expressions for logged model calls (K1-K7).  All JVM-side.

JSON is inspected with Spark's VARIANT functions (``try_parse_json``,
``schema_of_variant``, ``variant_get``), so no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Silent-failure patterns (matched on lower-cased text; "." never crosses a newline).
SILENT_FAILURE_PATTERNS = [
    r"\bmean\b.*\bfraud\b",
    r"one.hot.*high.cardinality",
    r"fit.*full.*dataset",
    r"drop.*low.*correlation",
    r"error.*none",
]
TRUNCATE_AT = 800
CHARS_PER_TOKEN = 4
# Heuristic quality score (base, bonuses, unparsable scores, cap).
SCORE_BASE = 3.0
SCORE_RULES = [(("justification", "risk_summary"), 0.5), (("backtrack",), 0.3),
               (("risk_level", "risk_note"), 0.4), (("readiness_score",), 0.3)]
TREATMENT_BONUS = 0.3
TREATMENT = "cdp"
UNPARSABLE_SCORE = {"baseline": 2.5, "cdp": 3.5}
SCORE_CAP = 5.0


def portable(pattern: str) -> str:
    """Same regex for Java and RE2 with Python's meaning of '.' (anything but newline)."""
    return pattern.replace(".", "[^\n]")


def token_estimate(text: Column) -> Column:                                      # K1
    return F.floor(F.char_length(text) / CHARS_PER_TOKEN).cast("long")


def truncate(text: Column, n: int = TRUNCATE_AT) -> Column:                      # K2
    return F.substring(text, 1, n)


def silent_failure(text: Column) -> Column:                                      # K3
    low = F.lower(text)
    hits = [low.rlike(portable(p)) for p in SILENT_FAILURE_PATTERNS]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return F.coalesce(out, F.lit(False))


#: number literals that Python's parser takes and JSON has not, after a structural character
_NON_FINITE = r"([:\[,]\s*)-?(?:NaN|Infinity)(?=\s*[,}\]])"
_OBJECT = r"^\s*\{"
_MAP_OPTIONS = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}


def parse_reply(text: Column) -> Column:
    """The reply as a variant, NULL if it is no JSON.

    NaN and Infinity, which Python's parser takes, are read as 1 (a number,
    and true); an object with a repeated key, which the strict parser refuses,
    is read again as a map and keeps the key's last value."""
    odd = text.contains("NaN") | text.contains("Infinity")
    t = F.when(odd, F.regexp_replace(text, _NON_FINITE, "$11")).otherwise(text)
    entries = F.map_entries(F.from_json(t, "map<string,variant>", _MAP_OPTIONS))
    late = F.transform(F.array(entries), lambda es: F.filter(
        es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.size(es)), lambda x: x["key"] == e["key"])))[0]
    last = F.try_parse_json(F.to_json(F.map_from_entries(late)))
    v = F.coalesce(F.try_parse_json(t), F.when(text.rlike(_OBJECT), last))
    # the parsers stop after the first value; text after it makes the reply no JSON
    s = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    first, last_char = F.substring(s, 1, 1), F.right(s, F.lit(1))
    whole = (F.when(first == "{", last_char == "}").when(first == "[", last_char == "]")
             .when(first == '"', (last_char == '"') & (F.length(s) > 1)).otherwise((s != "") & ~s.rlike(r"\s")))
    return F.when(whole, v)


def _kind(json: Column) -> Column:
    """Kind of a JSON text by its first character: { [ " t f n, or a digit or sign."""
    return F.substring(F.ltrim(F.translate(json, "\t\r\n", "   ")), 1, 1)


def truthy(v: Column) -> Column:
    """Python truthiness of a JSON value held in a variant (missing -> False)."""
    t = F.to_json(v)
    k = _kind(t)
    return (F.when(v.isNull() | (k == "n"), False)
            .when(k.isin("t", "f"), k == "t")
            .when(k == '"', t != '""')
            .when(k.isin("[", "{"), ~t.isin("[]", "{}"))
            .otherwise(F.coalesce(t.try_cast("double") != 0, F.lit(True))))


def backtrack(text: Column, v: Column | None = None) -> Column:                   # K4
    """JSON object: truthiness of its ``backtrack`` key; otherwise the text
    contains BACKTRACK (case-insensitive).  ``v`` may pass an already parsed
    reply (``parse_reply``; parse once, use many times)."""
    v = parse_reply(text) if v is None else v
    is_obj = v.isNotNull() & (_kind(text) == "{")
    field = F.try_variant_get(v, "$.backtrack", "variant")
    return F.when(is_obj, truthy(field)).otherwise(F.coalesce(F.upper(text).contains("BACKTRACK"), F.lit(False)))


def _has(v: Column, kind: Column, key: str) -> Column:
    """Python ``key in data`` for dict keys, list elements and substrings."""
    arr = F.try_variant_get(v, "$", "array<variant>")
    in_list = F.exists(arr, lambda x: F.to_json(x) == f'"{key}"')
    return (F.when(kind == "{", F.try_variant_get(v, f"$.{key}", "variant").isNotNull())
            .when(kind == "[", F.coalesce(in_list, F.lit(False)))
            .when(kind == '"', F.try_variant_get(v, "$", "string").contains(key))
            .otherwise(False))


def quality_score(text: Column, strategy: Column, v: Column | None = None) -> Column:   # K5
    v = parse_reply(text) if v is None else v
    kind = F.when(v.isNotNull(), _kind(text))
    score = F.lit(SCORE_BASE)
    for keys, bonus in SCORE_RULES:
        cond = _has(v, kind, keys[0])
        for k in keys[1:]:
            cond = cond | _has(v, kind, k)
        score = score + F.when(cond, bonus).otherwise(0.0)
    score = score + F.when(strategy == TREATMENT, TREATMENT_BONUS).otherwise(0.0)
    parsed = F.least(F.bround(score, 2), F.lit(SCORE_CAP))
    unparsable = F.when(strategy == "baseline", UNPARSABLE_SCORE["baseline"]).otherwise(UNPARSABLE_SCORE["cdp"])
    return F.when(kind.isin("{", "[", '"'), parsed).otherwise(unparsable)


def strip_fences(text: Column) -> Column:                                        # K6
    """strip, then drop a leading ```json / ``` and a trailing ```, strip again."""
    s = F.regexp_replace(text, r"^\s+|\s+$", "")
    for fence in ("```json", "```"):
        s = F.regexp_replace(F.regexp_replace(s, "^" + fence.replace("`", "\\`"), ""), r"\`\`\`$", "")
        s = F.regexp_replace(s, r"^\s+|\s+$", "")
    return s


def lenient_json(text: Column) -> Column:
    """``(ok, cleaned)``: cleaned text and whether it parses as JSON."""
    cleaned = strip_fences(text)
    return F.struct(parse_reply(cleaned).isNotNull().alias("ok"), cleaned.alias("cleaned"))


def score_from_reply(text: Column) -> Column:                                    # K7
    """First digit 1-5 as a float, else NULL."""
    d = F.regexp_extract(text, "[1-5]", 0)
    return F.when(d != "", d.cast("double"))
