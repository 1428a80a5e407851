import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tableprep.llm import queries, warc

from .helpers import SF, tables

SCHEMA = "page_id long, url string, html string, digest string, id int, revisit boolean, file string"
RESULT = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
HTML = [None, "", "<p>one</p>", "<p>one</p>", "a\r\n\r\nb", "\r\n\r\n", "\r\n", "x\r", "x\n", "\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n",
        "é日本\U0001f600", "y" * 70_000, "z\r\n" * 40_000, "\r", "\n\r\n\r", "", "\x00\x01"]


def pages(spark, html, ids=None, urls=None):
    n = len(html)
    rows = list(zip(ids or range(n), urls or [f"http://www.a{i % 3}.example.org/{i}" for i in range(n)], html))
    return spark.createDataFrame([(*r, "d", 1, True, "f") for r in rows], SCHEMA)


def plain(rows, least=0):
    """The contract over ``(page_id, html)``."""
    raw = [(i, (h or "").encode()) for i, h in rows]
    out = []
    for i, p in raw:
        same = [j for j, q in raw if q == p and j is not None]
        first = min(same, default=None)
        revisit = len(p) >= least and first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r[c] for c in RESULT) for r in df.collect()], key=str)


@pytest.mark.parametrize("least", [0, 3])
def test_same_as_plain(spark, least):
    df = pages(spark, HTML).repartition(3)
    assert result(warc.capture_histories(df, least_bytes=least)) == plain(list(enumerate(HTML)), least)


def test_random_line_ends(spark):
    rng = random.Random(4)
    html = ["".join(rng.choice(["\r", "\n", "\r\n", "a", "\r\n\r\n"]) for _ in range(rng.randrange(0, 3000))) for _ in range(400)]
    found = warc.capture_histories(pages(spark, html).coalesce(1), records_per_file=90, run_entries=37, range_entries=50)
    assert result(found) == plain(list(enumerate(html)))


def test_repeated_and_null_ids(spark):
    ids, html = [5, 5, None, 7, None, 2], ["s", "s", "s", "s", "t", None]
    assert result(warc.capture_histories(pages(spark, html, ids))) == plain(list(zip(ids, html)))
    assert result(warc.capture_histories(pages(spark, ["u", "u"], [None, None]))) == plain([(None, "u")] * 2)
    assert warc.capture_histories(pages(spark, [])).collect() == []


def test_urls(spark):
    urls = [None, "", "http://h/a b\r\nX: 1", "HTTPS://WWW2.Example.com:443/P?q=1#f", "mailto:x"]
    found = warc.capture_histories(pages(spark, list("abcde"), urls=urls)).collect()
    assert {r.page_id: (r.url, r.url_key) for r in found} == {
        0: ("", ""), 1: ("", ""), 2: ("http://h/a%20b%0D%0AX:%201", "h)/a%20b%0d%0ax:%201"),
        3: (urls[3], "com,example)/p?q=1"), 4: ("mailto:x", "mailto:x")}


def test_histories_are_in_global_order(spark):
    """One URL holds a third of all captures and spans ranges; runs are short."""
    n = 3000
    urls = [f"http://hot.example/" if i % 3 == 0 else f"http://s{i % 40}.example/{i % 7}" for i in range(n)]
    df = pages(spark, [f"page {i % 900}" for i in range(n)], urls=urls).repartition(5)
    found = warc.capture_histories(df, date=F.timestamp_seconds((F.col("page_id") * 7919) % 1000), run_entries=100,
                                   range_entries=200).collect()
    rows = sorted(found, key=lambda r: (r.range, r.position))
    keys = [(r.url_key, r.timestamp, r.page_id) for r in rows]
    assert keys == sorted(keys) and len({r.page_id for r in rows}) == n
    sizes = [sum(r.range == k for r in rows) for k in {r.range for r in rows}]
    assert len({r.range for r in rows if r.url_key == "example,hot)/"}) > 1 and max(sizes) < 2 * 200


def test_files_are_warc(spark, tmp_path):
    """The files follow the format: read by a parser that knows nothing of ours; offsets of the index hold."""
    folder = str(tmp_path / "w")
    warc.write_archives(pages(spark, HTML).coalesce(1), folder, records_per_file=4)
    files = {f.name: gzip.decompress(f.read_bytes()) for f in (tmp_path / "w").glob("part-*.gz")}
    assert len(files) == -(-len(HTML) // 4)
    n = 0
    for raw in files.values():
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            said = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"WARC-Target-URI", b"Content-Length"} <= set(said)
            size = int(said[b"Content-Length"])
            assert rest[size:size + 4] == b"\r\n\r\n"
            raw, n = rest[size + 4:], n + 1
    assert n == len(HTML)
    for r in warc.read_runs(spark, folder).collect():
        part = files[r.file][r.offset:r.offset + r.length]
        assert part.startswith(b"WARC/1.1\r\n") and f"<urn:page:{r.page_id}>".encode() in part


def test_damaged_archives_raise(spark, tmp_path):
    folder = str(tmp_path / "w")
    warc.write_archives(pages(spark, ["text one", "text two"]).coalesce(1), folder)
    raw = gzip.decompress(next((tmp_path / "w").glob("part-*.gz")).read_bytes())
    for k, bad in enumerate((raw.replace(b"text two", b"text tvo"), raw[:-9])):
        other = tmp_path / f"bad{k}"
        other.mkdir()
        (other / "part-0.txt.gz").write_bytes(gzip.compress(bad))
        with pytest.raises(Exception, match="does not have its digest|within a record"):
            warc.read_runs(spark, str(other)).collect()


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    lists = [sorted(rng.choices(range(20), k=rng.randrange(0, 9))) for _ in range(k)]
    assert list(warc.LoserTree(lists, lambda x: x)) == sorted(x for one in lists for x in one)


def test_whole_table(spark):
    rows = [(r.page_id, r.html) for r in tables(spark, "pages").collect()]
    assert result(queries.QUERIES["op13_warc"](spark, SF)) == plain(rows)
