"""Scans over chunks against the streaming indicators, stored states, and numbering by ranges."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketmill.functions.windows import page, rank_rows
from marketmill.operators import indicators as I
from marketmill.operators import maintain as B
from marketmill.operators.longseries import recursive_indicators

NAMES = ("ema", "dema", "tema", "rsi", "adx")
SPECS = [(f"{name}_{n}", name, n) for name in NAMES for n in (1, 3, 14)]
KEYS = ["symbol", "date"]


def walk(spark, n, symbols):
    """Bars of ``symbols`` with n bars each (a list of pairs), some of them without prices."""
    frames = []
    for symbol, count in symbols:
        r = F.col("id")
        close = 100 + 10 * F.sin(r / 17.0) + F.pmod(F.xxhash64("id", F.lit(str(symbol))), F.lit(1000)) / 250.0
        frames.append(
            spark.range(count).select(
                F.lit(symbol).cast("string").alias("symbol"), (F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz") + F.make_interval(mins=r)).alias("date"),
                (close + F.pmod(r * 7, F.lit(13)) / 10).alias("high"), (close - F.pmod(r * 5, F.lit(11)) / 10).alias("low"),
                F.when(F.pmod(r, F.lit(97)) != 5, close).alias("close"), r.alias("volume"),
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def same(got, want, columns):
    a, b = (df.orderBy(F.asc_nulls_first("symbol"), "date").toPandas() for df in (got, want))
    assert len(a) == len(b) and list(a["date"]) == list(b["date"])
    for c in columns:
        np.testing.assert_allclose(a[c].to_numpy(float), b[c].to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=c)


def test_scan_equals_the_stream(spark):
    bars = walk(spark, 0, [("A", 4000), ("B", 3), ("C", 40), (None, 700), ("D", 1)])
    got, states = recursive_indicators(bars, SPECS, parts=13)
    assert got.columns == [*bars.columns, *[c for c, _, _ in SPECS]]
    same(got, I.indicators(bars, SPECS), [c for c, _, _ in SPECS])
    assert sorted(str(r.symbol) for r in states.collect()) == ["A", "B", "C", "D", "None"]
    # fewer bars in a chunk than the warm-up takes
    few = walk(spark, 0, [("A", 60)])
    same(recursive_indicators(few, SPECS, parts=25)[0], I.indicators(few, SPECS), [c for c, _, _ in SPECS])


def test_states_continue(spark):
    bars = walk(spark, 0, [("A", 900), ("B", 30), ("C", 5), ("E", 50)])
    bars = bars.filter("symbol <> 'E' OR volume < 20")
    before, after = bars.filter("volume < 20"), bars.filter("volume >= 20")
    _, first = recursive_indicators(before, SPECS, parts=4)
    first = spark.createDataFrame(first.collect(), first.schema)
    got, last = recursive_indicators(after, SPECS, first, parts=7)
    want = I.indicators(bars, SPECS).filter("volume >= 20")
    same(got, want, [c for c, _, _ in SPECS])
    whole = recursive_indicators(bars, SPECS, parts=3)[1]
    a, b = ({r.symbol: r.state for r in df.collect()} for df in (last, whole))
    assert a.keys() == b.keys()
    for k in a:
        np.testing.assert_allclose(np.array(a[k], float), np.array(b[k], float), rtol=1e-9, atol=1e-9)
    none, kept = recursive_indicators(after.limit(0), SPECS, first)
    assert none.collect() == [] and kept.count() == first.count()
    with pytest.raises(Exception, match="the state is not of"):
        recursive_indicators(after, [("x", "ema", 4)], first)


def test_one_long_series_runs_in_many_tasks(spark):
    bars = walk(spark, 0, [("HOT", 300_000)])
    specs = [("ema", "ema", 20), ("adx", "adx", 14)]
    got, _ = recursive_indicators(bars, specs, parts=12)
    per = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per) >= 8 and max(per) < 60_000
    same(got.filter("volume >= 299000"), I.indicators(bars, specs).filter("volume >= 299000"), ["ema", "adx"])


def test_long_series_of_the_public_function(spark):
    bars = walk(spark, 0, [("A", 200), ("B", 90)])
    specs = [("sma", "sma", 5), ("rsi", "rsi", 5)]
    same(I.indicators(bars, specs, long_series=True), I.indicators(bars, specs), ["sma", "rsi"])


def test_ranks_by_ranges(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 7 > 0, F.lit("HOT")).when(F.col("id") % 2 > 0, F.lit("b")).alias("k"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"), "id"
    )
    order = [F.desc_nulls_last("v"), F.asc("id")]
    for keys in ([], ["k"]):
        window = Window.partitionBy(*keys).orderBy(*order) if keys else Window.partitionBy(F.lit(1)).orderBy(*order)
        want = {(r.id, r.n - 1) for r in rows.withColumn("n", F.row_number().over(window)).collect()}
        assert {(r.id, r.n) for r in rank_rows(rows, order, "n", keys, parts=9).collect()} == want
    assert rank_rows(rows.limit(0), order, "n").collect() == []


def test_a_feed_of_one_day_is_dealt_out(spark):
    rows = spark.range(2_000_000).select(F.lit("2024-05-05").cast("date").alias("date"), F.xxhash64("id").alias("id"))
    order = [F.desc_nulls_last("date"), F.asc("id")]
    out = B.new_since(rows, order, "2024-05-01", "date", page_size=1000)
    per = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per) == 2_000_000 and max(per) < 2 * 2_000_000 / 8
    pages = out.groupBy("page").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("z")).orderBy("page").collect()
    assert [p.n for p in pages] == [1000] * 2000 and all(x.z < y.a for x, y in zip(pages, pages[1:]))
    deep = page(rows, order, 1500, 1000, band="date")
    assert {r.id for r in deep.collect()} == {r.id for r in out.filter("page = 1500").collect()}


def test_rank_of_one_key_is_not_found_in_one_task(spark):
    """All rows have one key; the numbers within it are found range by range."""
    rows = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("n"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = rank_rows(rows, [F.desc("n")], "at", ["k"], parts=16)
        assert got.filter("at + n <> 3999").count() == 0
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 4000 and max(sizes) <= 2400
