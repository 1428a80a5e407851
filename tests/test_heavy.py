"""Most frequent values: summaries, their proof, and the full count behind it."""
import datetime
import decimal
import random
from collections import Counter

import pyarrow as pa
import pytest

from tableprep.functions import heavy
from tableprep.functions.stats import SLOTS, value_counts, value_summary


def full(df, cols=None):
    return {r["column"]: (r["non_null"], r["top_n"], r["mode"].asDict()) for r in value_summary(value_counts(df, cols)).collect()}


def same(got, want):
    assert set(got) == set(want)
    for c in want:
        a, b = got[c], want[c]
        assert a[:2] == b[:2], c
        assert repr([a[2][s] for s in SLOTS]).replace("-0.0", "0.0") == repr([b[2][s] for s in SLOTS]).replace("-0.0", "0.0"), c


def table(spark, n=4000):
    rng = random.Random(1)
    nan = float("nan")
    rows = [(i,                                                     # unique
             rng.choice([3, 3, 1, 2]), "z" if i % 3 == 0 else f"t{i}",
             rng.choice([nan, nan, 1.5]), [0.0, -0.0, 1.0, 2.0][i % 4], None,
             datetime.date(2020, 1, 1) + datetime.timedelta(days=i % 7), datetime.datetime(2020, 1, 1, 0, 0, i % 3),
             i % 5 == 0, decimal.Decimal(i % 4) / 4, f"tie{i % 2000}", [1], i if i % 2 else None) for i in range(n)]
    return spark.createDataFrame(rows, "id long, few int, hot string, nan double, zero double, none string, day date, "
                                       "at timestamp, flag boolean, money decimal(9,2), tied string, list array<int>, "
                                       "holes long").repartition(5)


@pytest.mark.parametrize("counters, candidates", [(512, 16), (20, 4), (2, 1)])
def test_same_as_full_count(spark, counters, candidates):
    df = table(spark)
    same(heavy.top_values(df, counters=counters, candidates=candidates), full(df))


def test_no_full_count_where_the_summary_proves(spark, monkeypatch):
    asked = []
    real = heavy.value_counts
    monkeypatch.setattr(heavy, "value_counts", lambda df, cols: asked.extend(cols) or real(df, cols))
    df = table(spark)
    heavy.top_values(df, ["few", "hot", "nan", "zero", "day", "flag"], counters=64)
    assert asked == []
    heavy.top_values(df, ["few", "id", "tied"], counters=64)
    assert sorted(asked) == ["id", "tied"]


def test_empty_tables_and_columns(spark):
    df = table(spark)
    assert heavy.top_values(df.limit(0)) == {}
    assert heavy.top_values(df.select("list")) == {}
    assert heavy.top_values(df.select("none")) == {}
    assert heavy.top_table(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_error_bounds_every_count(seed):
    rng = random.Random(seed)
    values = [int(rng.paretovariate(0.7)) for _ in range(20_000)]
    one = heavy.Summary(pa.int64(), 30)
    for at in range(0, len(values), 700):
        one.add(pa.array(values[at:at + 700] + [None]))
    one.merge()
    held = dict(zip(one.table["v"].to_pylist(), one.table["n"].to_pylist()))
    assert len(held) <= 30 and one.total == len(values) and one.error <= len(values) / 31
    for v, n in Counter(values).items():
        assert n - one.error <= held.get(v, 0) <= n
