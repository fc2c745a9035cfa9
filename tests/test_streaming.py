"""Streams over several files: batch and stream agree, late rows are dropped, restarts do no harm."""

import datetime as dt

from pyspark.sql import functions as F

from marketmill.operators import maintain as B
from marketmill.operators import prices as P
from marketmill.sources.datasets import read_dataset
from marketmill.streaming import jobs as J
from marketmill.streaming import keyed as K

TICK = "symbol string, ts timestamp_ntz, price double, size bigint, id bigint"
T0 = dt.datetime(2024, 1, 1)


def land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_bars_equal_batch_on_closed_windows(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    rows = [("A" if i % 3 else "B", T0 + dt.timedelta(minutes=7 * i), float(i % 11), 1, i) for i in range(300)]
    for a in range(0, 300, 100):
        land(spark, src, rows[a : a + 100], TICK)
        J.start_append(J.stream_bars(stream(spark, src, TICK), "1hour", "10 minutes"), out, cp).awaitTermination()
    # far behind the watermark by now
    land(spark, src, [("A", T0, 99.0, 1, 999)], TICK)
    J.start_append(J.stream_bars(stream(spark, src, TICK), "1hour", "10 minutes"), out, cp).awaitTermination()
    got = {(r.symbol, r.date, r.open, r.high, r.low, r.close, r.volume) for r in spark.read.parquet(out).collect()}
    batch = P.bars_intraday(spark.createDataFrame(rows, TICK), "1hour").collect()
    closed = rows[-1][1] - dt.timedelta(minutes=10)
    want = {(r.symbol, r.date, r.open, r.high, r.low, r.close, r.volume) for r in batch if r.date + dt.timedelta(hours=1) <= closed}
    assert got == want and got


def test_dedup_across_batches(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = "symbol string, filingDate timestamp_ntz, transactionType string, offset bigint"
    keys = ["symbol", "filingDate", "transactionType"]
    for start in (0, 50):
        land(spark, src, [("HOT", T0, "P", start + i) for i in range(50)] + [(f"s{start}", T0, "P", start)], schema)
        feed = J.stream_dedup(stream(spark, src, schema), keys, "filingDate", "1 day", ["offset"])
        J.start_append(feed.select(*keys), out, cp).awaitTermination()
    assert sorted(r.symbol for r in spark.read.parquet(out).collect()) == ["HOT", "s0", "s50"]


def test_snapshot_keeps_latest(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = spark.createDataFrame([], "e string, seq int, payload string").schema
    batches = [[("a", 1, "x"), ("b", 1, "y")], [("a", 3, "z"), ("a", 2, "old"), ("b", 9, None)], [("a", 0, "late"), ("c", 1, "w")]]
    for rows in batches:
        land(spark, src, rows, schema)
    for run in range(2):  # the second run starts anew and sees everything again
        cp = str(tmp_path / f"cp{run}")
        J.start_snapshot(stream(spark, src, schema), out, schema, ["e"], "payload", [F.desc("seq")], cp, 4).awaitTermination()
        got = sorted((r.e, r.seq, r.payload) for r in read_dataset(spark, out, schema).collect())
        assert got == [("a", 3, "z"), ("b", 1, "y"), ("c", 1, "w")]


def test_changefeed_rebuilds_dirty_cells(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = "subject string, predicate string, value double, valid_from date, published_at timestamp_ntz, source_id bigint"
    q = dt.date(2024, 3, 31)
    build = lambda f: B.facts_panel(B.facts_latest(f), ["eps"])
    view = build(spark.createDataFrame([], schema)).schema
    for rows in ([("A", "eps", 1.0, q, T0, 1), ("B", "eps", 5.0, q, T0, 1)], [("A", "eps", 2.0, q, T0 + dt.timedelta(1), 1)]):
        land(spark, src, rows, schema)
        facts = stream(spark, src, schema)
        cells = lambda s, dirty: s.read.schema(schema).parquet(src).join(dirty, ["subject", "valid_from"], "left_semi")
        J.start_changes(facts, cells, build, out, view, ["entity", "time"], cp, 4).awaitTermination()
    assert sorted((r.entity, r.eps) for r in read_dataset(spark, out, view).collect()) == [("A", 2.0), ("B", 5.0)]


def test_feed_keeps_late_rows(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = spark.createDataFrame([], "symbol string, filingDate timestamp_ntz, seq bigint").schema
    days = [0, 57, 400]
    for i, back in enumerate(days):  # newest first
        land(spark, src, [("A", T0 - dt.timedelta(back), i), ("A", T0, 10 + i), (None, None, 20 + i)], schema)
    for run in range(2):
        q = J.start_feed(stream(spark, src, schema), out, schema, ["symbol", "filingDate"], [F.asc("seq")], f"{cp}{run}", 4)
        q.awaitTermination()
        got = {(r.symbol, r.filingDate) for r in read_dataset(spark, out, schema).collect()}
        assert got == {(None, None)} | {("A", T0 - dt.timedelta(d)) for d in days}
        assert read_dataset(spark, out, schema).count() == 4


def written(folder):
    return sum(f.stat().st_size for f in folder.rglob("*") if f.is_file()) if folder.exists() else 0


def test_keyed_feed(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = spark.createDataFrame([], "symbol string, filingDate timestamp_ntz, seq bigint, note string").schema
    days = [0, 57, 400]
    keys, order = ["symbol", "filingDate"], [("seq", True), ("note", False)]

    def run(files):
        feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(src)
        K.start_keyed_feed(feed, out, keys, order, cp).awaitTermination()
        return spark.read.schema(schema).parquet(out)

    for i, back in enumerate(days):  # newest first
        land(spark, src, [("A", T0 - dt.timedelta(back), i, None), ("A", T0, 10 + i, "x"), ("A", T0, 10 + i, "y"), (None, None, None, "n"), (None, None, 20 + i, "n")], schema)
        got = sorted(((r.symbol, r.filingDate, r.seq, r.note) for r in run(1).collect()), key=str)
    assert got == sorted([(None, None, None, "n")] + [("A", T0 - dt.timedelta(d), i, None) for i, d in enumerate(days)], key=str)
    # many keys, then a batch of a few in many small files: it writes its own only
    land(spark, src, [(f"s{i}", T0, i, "z") for i in range(5000)], schema)
    assert run(100).count() == 5004
    before = written(tmp_path / "out")
    spark.createDataFrame([("new", T0, i, "w") for i in range(12)] + [("s7", T0, -1, "late")], schema).repartition(6).write.mode("append").parquet(src)
    assert run(100).count() == 5005
    assert written(tmp_path / "out") - before < 6000 < before


def test_keyed_snapshot(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = spark.createDataFrame([], "e string, seq int, at timestamp_ntz, big bigint, payload string").schema
    big = 2**60 + 1
    batches = [
        [("a", 1, T0, big, "x"), ("b", 1, None, None, "y"), (None, 5, T0, big, "n")],
        [("a", 3, T0, big + 2, "z"), ("a", 2, T0, 1, "old"), ("b", 9, T0, 1, None)],
        [("a", 0, T0, 0, "late"), ("c", 1, T0, None, "w"), ("b", None, T0, 1, "null")],
    ]
    order = [("seq", False), ("at", True)]
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(src)
        feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(src)
        K.start_keyed_snapshot(feed, out, ["e"], "payload", order, cp).awaitTermination()
    got = sorted(tuple(r) for r in K.read_snapshot(spark, out, schema, ["e"], order).collect() if r.e)
    assert got == [("a", 3, T0, big + 2, "z"), ("b", 1, None, None, "y"), ("c", 1, T0, None, "w")]
    # an entity comes again only when it has got better
    assert spark.read.parquet(out).filter("e = 'b'").count() == 1 and spark.read.parquet(out).filter("e is null").count() == 1


def test_rank_sorts_like_spark(spark):
    nan = float("nan")
    rows = [(None, 1.0), (1, None), (1, nan), (1, 2.0), (2, -1.0), (2, nan), (None, None)]
    for up in (True, False):
        for also in (True, False):
            order = [F.asc("a") if up else F.desc("a"), F.asc("b") if also else F.desc("b")]
            want = [repr(tuple(r)) for r in spark.createDataFrame(rows, "a int, b double").coalesce(1).orderBy(*order).collect()]
            got = sorted(rows, key=lambda r: K._Rank(r, [(0, up), (1, also)]))
            assert [repr(r) for r in got] == want


def test_best_rows_of_a_batch_sort_like_spark(spark):
    """A feed picks its rows of a batch in Arrow; they are those that Spark's own window takes."""
    import random

    from pyspark.sql import Window

    rng, nan = random.Random(3), float("nan")
    rows = [
        (rng.choice([None, "a", "b", "ä"]), rng.choice([None, 1, 2]), rng.choice([None, nan, -1.0, 0.5, 2.0]), i)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, l int, x double, n long")
    for order in ([("x", True), ("n", False)], [("x", False), ("n", True)], [("l", False), ("x", True), ("n", True)]):
        along = Window.partitionBy("k", "l").orderBy(*[F.asc(c) if up else F.desc(c) for c, up in order])
        want = {r.n for r in df.withColumn("r", F.row_number().over(along)).filter("r = 1").collect()}
        assert set(K._best_rows(["k", "l"], order)(df.toArrow())["n"].to_pylist()) == want


def test_keyed_feed_calls_no_python_for_a_key(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    schema = spark.createDataFrame([], "symbol string, seq bigint").schema
    land(spark, src, [(f"s{i % 3000}", -i) for i in range(9000)], schema)
    query = K.start_keyed_feed(stream(spark, src, schema), out, ["symbol"], [("seq", True)], cp)
    query.awaitTermination()
    assert [o.operatorName for o in query.lastProgress.stateOperators] == ["dedupe"]
    got = spark.read.schema(schema).parquet(out)
    assert {(r.symbol, r.seq) for r in got.collect()} == {(f"s{i}", -6000 - i) for i in range(3000)} and got.count() == 3000
