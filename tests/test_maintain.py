"""Hand-made cases of the maintenance operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketmill.functions.windows import page
from marketmill.operators import maintain as B

D = dt.date.fromisoformat


def gaps(spark, lo, hi, stored=None):
    req = spark.createDataFrame([("k", D(lo), D(hi))], "k string, lo date, hi date")
    rows = [("k", D(stored[0]), D(stored[1]))] if stored else []
    cov = spark.createDataFrame(rows, "k string, min_date date, max_date date")
    return [(str(r.gap_lo), str(r.gap_hi)) for r in B.date_gaps(req, cov, ["k"]).orderBy("gap_lo").collect()]


@pytest.mark.parametrize(
    "lo, hi, stored, expected",
    [
        ("2020-01-01", "2024-12-31", None, [("2020-01-01", "2024-12-31")]),
        ("2021-01-01", "2022-12-31", ("2020-01-01", "2023-12-31"), []),
        ("2020-01-01", "2023-12-31", ("2020-01-01", "2023-12-31"), []),
        ("2020-01-01", "2025-12-31", ("2020-01-01", "2023-12-31"), [("2024-01-01", "2025-12-31")]),
        ("2020-01-01", "2025-12-31", ("2022-01-01", "2025-12-31"), [("2020-01-01", "2021-12-31")]),
        ("2020-01-01", "2025-12-31", ("2022-01-01", "2023-12-31"),
         [("2020-01-01", "2021-12-31"), ("2024-01-01", "2025-12-31")]),
        ("2022-01-01", "2022-12-31", ("2020-01-01", "2020-12-31"), [("2022-01-01", "2022-12-31")]),
        ("2020-01-01", "2020-12-31", ("2022-01-01", "2022-12-31"), [("2020-01-01", "2020-12-31")]),
    ],
)
def test_date_gaps(spark, lo, hi, stored, expected):
    assert gaps(spark, lo, hi, stored) == expected


def test_date_gaps_wrong_order(spark):
    with pytest.raises(Exception, match="range start after range end"):
        gaps(spark, "2024-01-02", "2024-01-01")


def series(spark, rows):
    return spark.createDataFrame([(k, D(d) if d else None, v) for k, d, v in rows], "k string, date date, v int")


def dates(df):
    return sorted((r.k, str(r.date), r.v) for r in df.collect())


def test_refresh_asks_for_the_gap_only(spark):
    existing = series(spark, [("a", "2024-01-02", 1), ("a", "2024-01-03", 1)])
    source = series(spark, [("a", f"2024-01-0{i}", 2) for i in range(2, 6)])
    req = spark.createDataFrame([("a", D("2024-01-02"), D("2024-01-05"))], "k string, lo date, hi date")
    _, answer = B.refresh_range(req, existing, source, ["k"], "date", "2024-02-01")
    assert dates(answer) == [("a", "2024-01-02", 1), ("a", "2024-01-03", 1), ("a", "2024-01-04", 2), ("a", "2024-01-05", 2)]


def test_refresh_after_any_split_equals_one_shot(spark):
    source = series(spark, [("a", f"2024-01-{i:02d}", i) for i in range(1, 31)])
    whole = spark.createDataFrame([("a", D("2024-01-01"), D("2024-01-30"))], "k string, lo date, hi date")
    for cut in (1, 11, 29):
        first = spark.createDataFrame([("a", D("2024-01-01"), D(f"2024-01-{cut:02d}"))], "k string, lo date, hi date")
        stored, _ = B.refresh_range(first, source.limit(0), source, ["k"], "date", "2024-02-01")
        stored, _ = B.refresh_range(whole, stored, source, ["k"], "date", "2024-02-01")
        assert dates(stored) == dates(source)


def test_refresh_without_bounds_replaces_and_upto_stores_nothing(spark):
    existing = series(spark, [("a", "2024-01-02", 1), ("b", "2024-01-02", 1)])
    source = series(spark, [("a", "2024-01-09", 2), ("b", "2024-01-01", 2), ("b", "2024-01-09", 2)])
    req = spark.createDataFrame([("a", None, None), ("b", None, D("2024-01-05"))], "k string, lo date, hi date")
    stored, answer = B.refresh_range(req, existing, source, ["k"], "date", "2024-02-01")
    assert dates(stored) == [("a", "2024-01-09", 2), ("b", "2024-01-02", 1)]
    assert dates(answer) == [("a", "2024-01-09", 2), ("b", "2024-01-01", 2)]


def test_upsert_periods(spark):
    old = series(spark, [("a", "2022-12-31", 1), ("a", "2023-12-31", 1), ("a", None, 9)])
    new = series(spark, [("a", "2023-12-31", 2), ("a", "2024-12-31", 2)])
    out = B.upsert_periods(old, new, ["k"], "date")
    assert dates(out) == [("a", "2022-12-31", 1), ("a", "2023-12-31", 2), ("a", "2024-12-31", 2)]
    assert dates(B.upsert_periods(old, new, ["k"], "date", limit=1)) == [("a", "2024-12-31", 2)]


def test_stale_keys(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    cov = spark.createDataFrame([("a", D("2024-01-10")), ("b", D("2024-01-08"))], "k string, last_updated date")
    stale = lambda n: sorted(r.k for r in B.stale_keys(keys, cov, ["k"], "2024-01-10", n).collect())
    assert stale(1) == ["b", "c"]
    assert stale(2) == ["c"]
    assert stale(-1) == ["a", "b", "c"]


def test_page(spark):
    df = series(spark, [("a", "2023-12-31", 1), ("a", "2025-12-31", 1), ("a", "2024-12-31", 1), ("a", None, 1)])
    order = [F.desc_nulls_last("date")]
    assert [str(r.date) for r in page(df, order, 0, 2).collect()] == ["2025-12-31", "2024-12-31"]
    assert [str(r.date) for r in page(df, order, 1, 2).collect()] == ["2023-12-31", "None"]
    assert [str(r.date) for r in page(df, order, 1, 2, band="date", deep=0).collect()] == ["2023-12-31", "None"]
    assert page(df, order, 9, 2, band="date", deep=0).count() == 0
    assert page(df, order, None, None).count() == 4
    # several times of one day are one band
    times = df.withColumn("date", F.to_timestamp("date")).unionByName(
        df.select("k", (F.to_timestamp("date") + F.expr("INTERVAL 5 HOURS")).alias("date"), "v"), allowMissingColumns=True
    )
    for start in range(4):
        plain = [r.date for r in page(times, order, start, 2).collect()]
        assert [r.date for r in page(times, order, start, 2, band="date", deep=0).collect()] == plain


def feed(spark, rows):
    return spark.createDataFrame(rows, "symbol string, filingDate string, transactionType string, seq int")


def test_new_since_keeps_the_crossing_page(spark):
    f = feed(spark, [("A", f"2024-01-{30 - i:02d}", "P", i) for i in range(10)] + [("A", "n/a", "P", 10)])
    out = B.new_since(f, [F.asc("seq")], "2024-01-26", "filingDate", page_size=3, max_pages=9)
    assert sorted(r.seq for r in out.collect()) == [0, 1, 2, 3, 4, 5]
    assert B.new_since(f, [F.asc("seq")], None, "filingDate", 3, 2).count() == 6
    assert B.new_since(f, [F.asc("seq")], "2020-01-01", "filingDate", 3, 9).count() == 11


def test_new_since_per_key(spark):
    rows = [("A", f"2024-01-{30 - i:02d}", i) for i in range(10)] + [("B", "n/a", 0), ("B", "n/a", 1), ("B", "n/a", 2)]
    rows += [("C", "2024-01-09", 0), ("C", "2019-01-01", 1), ("C", "2018-01-01", 2)]
    f = spark.createDataFrame(rows, "symbol string, date string, seq int")
    cp = spark.createDataFrame([("A", D("2024-01-26"))], "symbol string, checkpoint date")
    order = [F.asc("seq")]
    out = B.new_since_per_key(f, ["symbol"], order, cp, "date", "2024-02-01", 1000, page_size=2, max_pages=9)
    got = sorted((r.symbol, r.seq) for r in out.collect())
    # A: the page of 2024-01-26 ends the walk; B: the undated first page does; C: the floor does
    assert got == [("A", i) for i in range(6)] + [("B", 0), ("B", 1), ("C", 0), ("C", 1)]
    out = B.new_since_per_key(f, ["symbol"], order, cp, "date", "2024-02-01", 1000, page_size=2, max_pages=1)
    assert out.filter("symbol = 'A'").count() == 2


def test_merge_feed_first_wins(spark):
    stored = feed(spark, [("A", "2024-01-02", "P", 7)])
    fresh = feed(spark, [("A", "2024-01-02", "P", 1), ("A", "2024-01-03", "P", 3), ("A", "2024-01-03", "P", 2), ("A", None, "P", 4), ("A", None, "P", 5)])
    out = B.merge_feed(stored, fresh, ["symbol", "filingDate", "transactionType"], [F.asc("seq")])
    assert sorted((str(r.filingDate), r.seq) for r in out.collect()) == [("2024-01-02", 7), ("2024-01-03", 2), ("None", 4)]


def test_checkpoints_never_move_back(spark):
    seen = spark.createDataFrame([("a", "2024-01-01"), ("a", "bad"), ("b", "2024-03-01"), ("c", "bad")], "s string, date string")
    cp = spark.createDataFrame([("a", D("2024-02-01")), ("d", D("2024-01-05"))], "s string, checkpoint date")
    out = {r.s: str(r.checkpoint) for r in B.advance_checkpoints(seen, cp, ["s"], "date").collect()}
    assert out == {"a": "2024-02-01", "b": "2024-03-01", "d": "2024-01-05"}


def test_snapshot(spark):
    cols = "e string, payload string, seq int"
    old = spark.createDataFrame([("a", "x", 0), ("b", "y", 0)], cols)
    new = spark.createDataFrame([("a", "x2", 1), ("a", "x3", 2), ("b", None, 3), ("c", "z", 1)], cols)
    out = B.upsert_snapshot(old, new, ["e"], "payload", [F.desc("seq")])
    assert sorted((r.e, r.payload) for r in out.collect()) == [("a", "x3"), ("b", "y"), ("c", "z")]


def test_worklist_and_universe(spark):
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    cal = spark.createDataFrame([("A", D("2024-01-05")), ("X", D("2024-01-05")), (None, D("2024-01-05")), ("B", D("2023-01-05"))], "symbol string, date date")
    run = lambda *a, **k: sorted(r.symbol for r in B.refresh_worklist(universe, cal, "date", *a, **k).collect())
    assert run("2024-01-01", "2024-01-01", "2024-01-10") == ["A"]
    assert run("2024-01-01", "2024-01-01", "2024-01-10", within_universe=False) == ["A", "X"]
    assert run(None, None, "2024-01-10") == ["A", "B", "C"]
    assert run("2024-01-01", "2023-12-01", "2024-01-10") == ["A", "B", "C"]
    existing = spark.createDataFrame([("old", 1, "u"), ("keep", 1, "v")], "symbol string, id int, universe string")
    listing = spark.createDataFrame([("n", 1), ("n", 2), (" ", 3), (None, 4)], "symbol string, id int")
    out = B.refresh_universe(existing, listing, "u", [F.desc("id")])
    assert sorted((r.symbol, r.id, r.universe) for r in out.collect()) == [("keep", 1, "v"), ("n", 2, "u")]


@pytest.fixture()
def facts(spark):
    rows = [
        ("A", "eps", 1.0, D("2024-03-31"), dt.datetime(2024, 5, 1), 2),
        ("A", "eps", 1.5, D("2024-03-31"), dt.datetime(2024, 5, 1), 1),
        ("A", "eps", 2.0, D("2024-03-31"), dt.datetime(2024, 6, 1), 1),
        ("A", "eps", None, D("2024-03-31"), dt.datetime(2024, 7, 1), 1),
        ("A", "rev", 9.0, D("2024-03-31"), dt.datetime(2024, 5, 1), 1),
        ("B", "eps", 3.0, D("2024-06-30"), dt.datetime(2024, 5, 2), 1),
    ]
    return spark.createDataFrame(
        rows, "subject string, predicate string, value double, valid_from date, published_at timestamp, source_id bigint"
    )


def test_facts(spark, facts):
    panel = B.facts_panel(B.facts_latest(facts), ["eps", "rev"]).orderBy("entity").collect()
    assert [(r.entity, r.eps, r.rev) for r in panel] == [("A", 2.0, 9.0), ("B", 3.0, None)]
    old = B.facts_panel(B.facts_latest(facts, "2024-05-15 00:00:00"), ["eps"]).orderBy("entity").collect()
    assert [(r.entity, r.eps) for r in old] == [("A", 1.5), ("B", 3.0)]
    assert B.freshness_token(facts.limit(0)).first().token is None
    assert B.changed_since(facts, None).count() == 2
    assert [r.subject for r in B.changed_since(facts, "2024-05-15 00:00:00").collect()] == ["A"]
    assert B.changed_since(facts, "2024-07-01 00:00:00").count() == 0


def test_usage(spark):
    gb = 1024**3
    rows = [(dt.datetime(2024, 1, 1), 1, "x", 10 * gb), (dt.datetime(2024, 1, 2), 2, None, 8 * gb), (dt.datetime(2024, 1, 2), 3, "", 2 * gb),
            (dt.datetime(2024, 2, 1), 4, "x", gb)]
    req = spark.createDataFrame(rows, "ts timestamp, id int, category string, bytes bigint")
    out = {(r.month, r.category): r for r in B.usage_rollup(req, 18, 20).collect()}
    assert out[("2024-01", "user")].bytes == 10 * gb
    assert out[("2024-01", "x")].overSoftCap and out[("2024-01", "x")].overHardCap
    assert out[("2024-01", "user")].overSoftCap and not out[("2024-01", "user")].overHardCap
    assert not out[("2024-02", "x")].overSoftCap
    breach = B.first_breach(req, 18 * gb).collect()
    assert [(r.month, r.id, r.runningBytes) for r in breach] == [("2024-01", 2, 18 * gb)]


def brute_streak(statuses, n):
    run = 0
    for i, s in enumerate(statuses):
        run = 0 if s == "success" else run + (s == "paywall")
        if s == "paywall" and run == n:
            return i
    return None


def test_failure_streaks_across_chunks(spark):
    import random

    rng = random.Random(7)
    cycles = {c: [rng.choice(["paywall"] * 6 + ["other", "success"]) for _ in range(200)] for c in range(12)}
    cycles[99] = ["success", "paywall"] * 50
    rows = [(c, i, s) for c, ss in cycles.items() for i, s in enumerate(ss)]
    df = spark.createDataFrame(rows, "cycle int, attempt_no int, status string")
    for n in (2, 10, 17):
        got = {r.cycle: r.attempt_no for r in B.failure_streaks(df, n, chunk=7).collect()}
        want = {c: brute_streak(ss, n) for c, ss in cycles.items()}
        assert got == {c: i for c, i in want.items() if i is not None}


def test_latest_runs(spark):
    runs = spark.createDataFrame([("a", 1, "OK"), ("a", 2, "PARTIAL"), ("b", 1, "OK")], "category string, started_at int, status string")
    out = B.latest_runs(runs, [F.desc("started_at")])
    assert sorted((r.category, r.status) for r in out.collect()) == [("a", "PARTIAL"), ("b", "OK")]


def test_walks_have_no_cap(spark):
    rows = spark.range(30_500).select(
        F.when(F.col("id") % 50 == 0, "B").otherwise("A").alias("symbol"),
        F.date_sub(F.lit("2024-06-01").cast("date"), (F.col("id") / 1000).cast("int")).alias("date"), F.col("id").alias("seq"),
    )
    order = [F.desc_nulls_last("date"), F.asc("seq")]
    out = B.new_since(rows, order, "2024-05-02", "date")
    # 30,000 rows are newer, and the page that reaches the checkpoint is taken whole
    assert out.count() == 30_100 and out.agg(F.max("page")).first()[0] == 300
    assert out.filter(F.col("page") != F.floor(F.col("seq") / 100)).count() == 0
    cp = spark.createDataFrame([("A", D("2024-05-02"))], "symbol string, checkpoint date")
    per = B.new_since_per_key(rows.filter("symbol = 'A'"), ["symbol"], order, cp, "date", "2024-06-01")
    assert per.filter("date > date'2024-05-02'").count() == 29_400


def test_null_keys_are_keys(spark):
    req = spark.createDataFrame([(None, D("2024-01-01"), D("2024-01-09"))], "k string, lo date, hi date")
    cov = spark.createDataFrame([(None, D("2024-01-01"), D("2024-01-05"))], "k string, min_date date, max_date date")
    assert [(str(r.gap_lo), str(r.gap_hi)) for r in B.date_gaps(req, cov, ["k"]).collect()] == [("2024-01-06", "2024-01-09")]
    f = spark.createDataFrame([(None, D("2024-01-05"), 1), (None, D("2024-01-01"), 2)], "symbol string, date date, seq int")
    cp = spark.createDataFrame([(None, D("2024-01-03"))], "symbol string, checkpoint date")
    out = B.new_since_per_key(f, ["symbol"], [F.asc("seq")], cp, "date", "2024-02-01", page_size=1)
    assert sorted(r.seq for r in out.collect()) == [1, 2]


def test_gaps_bound_the_scan_of_the_source(spark, tmp_path):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    spark.createDataFrame([(k, day(i), float(i)) for k in "ab" for i in range(300)], "k string, date date, v double").write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    existing = source.filter(F.col("date").between("2024-02-01", "2024-03-01") & (F.col("k") == "a"))
    requests = spark.createDataFrame([("a", day(20), day(80)), ("b", day(30), day(40))], "k string, lo date, hi date")
    stored, answer = B.refresh_range(requests, existing, source, ["k"], "date", "2024-12-31")
    assert stored.count() == 61 + 11 and answer.count() == 61 + 11
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-21)" in plan and "LessThanOrEqual(date,2024-03-21)" in plan
    none = requests.limit(0)
    assert B.refresh_range(none, existing, source, ["k"], "date", "2024-12-31")[0].count() == existing.count()


def test_new_keys_are_dealt_once(spark):
    """Stored and fresh keys meet in one shuffle; null keys meet null keys, and other types of stored keys do no harm."""
    stored = spark.createDataFrame([(1, "x", 0.5), (1, "x", 0.6), (None, "y", 1.0)], "k long, t string, v double")
    fresh = spark.createDataFrame([(1, "x", 3, "a"), (2, "x", 5, "b"), (2, "x", 4, "c"), (None, "y", 1, "d"), (None, None, 2, "e")], "k int, t string, n int, note string")
    new = B.new_keys(stored, fresh, ["k", "t"], [F.asc("n")])
    assert new.dtypes == fresh.dtypes
    assert new._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted((tuple(r) for r in new.collect()), key=str) == [(2, "x", 4, "c"), (None, None, 2, "e")]
