"""One key with most of the rows: results have to equal brute force."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from marketmill.functions.windows import exact_median, previous_value, share_of_total, top_n_per_key
from marketmill.operators import indicators as I

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    keys = ["hot"] * 3000 + [f"k{i % 40}" for i in range(1500)] + ["single"]
    return [(k, DAY + dt.timedelta(rng.randrange(30)), i, round(rng.gauss(100, 30), rng.choice([0, 2]))) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, day date, id int, v double").repartition(16)


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_exact_median(df, rows, buckets):
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m", buckets).collect()}
    want = {k: statistics.median(x[3] for x in g) for k, g in by_key(rows).items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("accuracy", [4, 16, 1024])
def test_exact_median_of_odd_values(spark, accuracy):
    nan, inf = float("nan"), float("inf")
    groups = {
        "one": [7.0], "nan": [nan], "half": [1.0, nan], "most": [1.0, nan, nan], "some": [1.0, 2.0, 3.0, nan], "inf": [inf, inf, nan], "low": [-inf, 5.0],
        "ties": [2.0] * 50 + [3.0] * 50, "none": [None], None: [4.0, 8.0], "many": [float(i % 997) for i in range(5000)] + [None] * 20 + [nan] * 7,
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").repartition(5)
    got = {r.k: r.m for r in exact_median(df, ["k"], "v", "m", accuracy).collect()}
    want = {}
    for k, vs in groups.items():
        known = sorted((v for v in vs if v is not None), key=lambda v: (v != v, v))
        if known:
            want[k] = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    assert {k: repr(v) for k, v in got.items()} == {k: repr(v) for k, v in want.items()}


def test_median_reads_the_rows_twice(df):
    plan = exact_median(df, ["k"], "v", "m")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 2


def test_previous_value(df, rows):
    got = {r.id: r.p for r in previous_value(df, ["k"], "day", "id", "v", "p").collect()}
    want = {}
    for g in by_key(rows).values():
        g = sorted(g, key=lambda r: (r[1], r[2]))
        for before, r in zip([None, *g], g):
            want[r[2]] = before and before[3]
    assert got == want


@pytest.mark.parametrize("n", [3, 1200])
def test_top_n(df, rows, n):
    got = sorted(r.id for r in top_n_per_key(df, ["k"], [F.desc("v"), F.asc("id")], n).collect())
    want = sorted(r[2] for g in by_key(rows).values() for r in sorted(g, key=lambda r: (-r[3], r[2]))[:n])
    assert got == want


def test_shares(df):
    for few in (False, True):
        total = share_of_total(df, ["k"], "v", "s", few=few).groupBy("k").agg(F.sum("s").alias("t")).collect()
        assert all(abs(r.t - 100) < 1e-6 for r in total)


def brute_ema(x, n):
    out, last = [None] * len(x), None
    for i in range(n - 1, len(x)):
        last = sum(x[:n]) / n if i == n - 1 else last + 2 / (n + 1) * (x[i] - last)
        out[i] = last
    return out


def brute_rsi(x, n):
    d = [b - a for a, b in zip(x, x[1:])]
    out, up, down = [None] * len(x), None, None
    for i in range(n - 1, len(d)):
        if i == n - 1:
            up, down = sum(max(v, 0) for v in d[:n]) / n, sum(max(-v, 0) for v in d[:n]) / n
        else:
            up, down = (up * (n - 1) + max(d[i], 0)) / n, (down * (n - 1) + max(-d[i], 0)) / n
        out[i + 1] = 100.0 if down == 0 else 100 - 100 / (1 + up / down)
    return out


def test_recursive_indicators_carry_state_between_batches(spark):
    rng = random.Random(5)
    closes = {"hot": [rng.uniform(1, 9) for _ in range(700)], **{f"s{i}": [rng.uniform(1, 9) for _ in range(i)] for i in range(1, 25)}}
    rows = [(s, DAY + dt.timedelta(i), x, x, x) for s, xs in closes.items() for i, x in enumerate(xs)]
    bars = spark.createDataFrame(rows, "symbol string, date date, high double, low double, close double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = I.indicators(bars, [("e", "ema", 5), ("r", "rsi", 5), ("d", "dema", 3)]).orderBy("symbol", "date").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for s, xs in closes.items():
        mine = [r for r in got if r.symbol == s]
        e3 = brute_ema(xs, 3)
        e33 = [None] * 2 + brute_ema(e3[2:], 3) if len(xs) > 2 else [None] * len(xs)
        dema = [2 * a - b if b is not None else None for a, b in zip(e3, e33)]
        for col, want in (("e", brute_ema(xs, 5)), ("r", brute_rsi(xs, 5)), ("d", dema)):
            assert [x is None for x in want] == [r[col] is None for r in mine]
            assert all(w is None or abs(w - r[col]) < 1e-9 for w, r in zip(want, mine))


def test_unknown_indicator(spark):
    with pytest.raises(ValueError):
        I.indicators(spark.createDataFrame([], "symbol string, date date, high double, low double, close double"), [("x", "macd", 3)])


def test_date_filter_keeps_warm_up(spark):
    rows = [("A", DAY + dt.timedelta(i), 1.0 * i, 1.0 * i, 1.0 * i) for i in range(6)]
    bars = spark.createDataFrame(rows, "symbol string, date date, high double, low double, close double")
    got = [r.sma for r in I.sma(bars, 3, "2024-01-04").orderBy("date").collect()]
    assert got == [2.0, 3.0, 4.0]
