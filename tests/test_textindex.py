"""Searches through the trigram index: the same answers, fewer rows read, no index for short texts. Facts at many dates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketmill.operators import intervals as V
from marketmill.operators import maintain as B
from marketmill.operators import search as C
from marketmill.sources import textindex as X


@pytest.fixture(scope="module")
def names(spark, tmp_path_factory):
    rng = random.Random(5)
    syllables = ["ca", "ri", "mon", "tel", "bo", "zu", "ver", "lin", "ost", "ÄR"]
    rows = [(f"S{i}", "".join(rng.choices(syllables, k=rng.randint(1, 6))).title() + rng.choice([" Inc", " AG", " Co", ""])) for i in range(6000)]
    rows += [("NUL", None), (None, "Carimon Inc"), ("DUP", "Carimon Inc"), ("DUP", "Carimon Inc"), ("X1", ""), ("X2", "a")]
    df = spark.createDataFrame(rows, "symbol string, name string").repartition(5)
    path = str(tmp_path_factory.mktemp("index") / "names")
    X.write_index(df, path, {"symbol": X.starts(F.col("symbol")), "name": X.contains(F.col("name"))}, [F.lower("name")], block_rows=64)
    return df, path


@pytest.mark.parametrize("text", ["carimon", "CARIMON INC", "zuzu", "är", "ärär", "s59", "nothing like it", "a", "", "inc", "%_", "Dup"])
def test_the_same_answers(spark, names, text):
    df, path = names
    some = X.narrowed(spark, path, [("symbol", X.START + text), ("name", text)])
    assert some.columns == df.columns
    key = lambda d: sorted(map(str, d.collect()))
    assert key(C.search_symbols(some, text)) == key(C.search_symbols(df, text))
    assert key(C.search_companies(X.narrowed(spark, path, [("name", text)]), text)) == key(C.search_companies(df, text))


def test_rows_read_fall_with_selectivity(spark, names):
    df, path = names
    read = {t: X.narrowed(spark, path, [("name", t)]).count() for t in ("carimontelbo", "mon", "zz top", "mo")}
    assert read["zz top"] == 0 and 0 < read["carimontelbo"] <= 20 * 64 < read["mon"] <= read["mo"] == df.count()
    plan = X.narrowed(spark, path, [("name", "carimontelbo")])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(__block" in plan
    assert X.blocks_of(spark, path, []) is None and X.blocks_of(spark, path, [("name", "carimon"), ("symbol", "s")]) is None


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "symbol string, name string")
    X.write_index(df, str(tmp_path / "i"), {"name": X.contains(F.col("name"))}, [F.col("name")])
    assert X.narrowed(spark, str(tmp_path / "i"), [("name", "abc")]).collect() == []


T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(8)
    rows = [
        (rng.choice(["a", "b", None]), rng.choice("PQ"), dt.date(2023, 12, rng.randint(1, 5)), rng.choice([None, 1.0, 2.0, 3.0]),
         rng.choice([None, *[T0 + dt.timedelta(rng.randint(0, 20), rng.choice([0, 3600])) for _ in range(9)]]), rng.randint(1, 3))
        for _ in range(800)
    ]
    return spark.createDataFrame(rows, "subject string, predicate string, valid_from date, value double, published_at timestamp_ntz, source_id int")


def test_many_dates_equal_single_calls(spark, facts):
    dates = [str((T0 + dt.timedelta(d)).date()) for d in range(-1, 24)] + ["2024-01-05 01:00:00", "2024-01-05 00:30:00"]
    intervals = V.fact_intervals(facts)
    got = {}
    for r in V.facts_as_of(intervals, dates).collect():
        got.setdefault(str(r.as_of), set()).add((r.subject, r.predicate, r.valid_from, r.value, r.source_id, r.since))
    for d in dates:
        moment = d if " " in d else f"{d} 00:00:00"
        want = {tuple(r[c] for c in ("subject", "predicate", "valid_from", "value", "source_id", "published_at")) for r in B.facts_latest(facts, moment).collect()}
        assert got.get(moment, set()) == want, d
        panel = V.panels_as_of(intervals, [d], ["P", "Q"]).drop("as_of").collect()
        assert sorted(map(str, panel)) == sorted(map(str, B.facts_panel(B.facts_latest(facts, moment), ["P", "Q"]).collect()))
        changed = {(r.subject, r.valid_from) for r in V.changed_since(intervals, [d]).collect()}
        valued = facts.filter("value is not null")
        assert changed == {(r.subject, r.valid_from) for r in B.changed_since(valued, moment).collect()}
    assert V.facts_as_of(intervals, []).collect() == [] and V.fact_intervals(facts.limit(0)).collect() == []
    plan = V.facts_as_of(V.fact_intervals(facts), dates)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_intervals_grow_by_new_facts(spark, facts):
    whole = sorted(map(str, V.fact_intervals(facts).collect()))
    first = facts.filter(F.pmod(F.xxhash64("published_at", "value"), F.lit(2)) == 0)
    rest = facts.filter(F.pmod(F.xxhash64("published_at", "value"), F.lit(2)) == 1)
    stored = spark.createDataFrame(V.fact_intervals(first).collect(), V.fact_intervals(first).schema)
    assert sorted(map(str, V.merge_intervals(stored, rest).collect())) == whole
    assert sorted(map(str, V.merge_intervals(stored, rest.limit(0)).collect())) == sorted(map(str, stored.collect()))


def test_panels_deal_intervals_and_not_rows_of_dates(spark):
    """Only the intervals are shuffled, once, by (entity, time); cells without a wanted predicate and dates without facts stay as they were."""
    schema = "subject string, predicate string, valid_from date, value double, source_id long, since timestamp_ntz, until timestamp_ntz"
    t, q = (lambda d: dt.datetime(2024, 1, d)), dt.date(2023, 12, 31)
    rows = [("a", "P", q, 1.0, 1, t(1), t(5)), ("a", "P", q, 2.0, 1, t(5), None), ("a", "Q", q, 9.0, 1, t(3), None), ("b", "X", q, 3.0, 1, t(2), None), (None, "Q", None, 4.0, 1, t(1), t(2))]
    intervals = spark.createDataFrame(rows, schema)
    dates = ["2024-01-01", "2024-01-04", "2024-01-05", "2023-01-01"]
    panel = V.panels_as_of(intervals, dates, ["P", "Q"])
    assert panel._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    got = {(r.as_of.day, r.entity, r.time, r.P, r.Q) for r in panel.collect()}
    assert got == {(1, "a", q, 1.0, None), (1, None, None, None, 4.0), (4, "a", q, 1.0, 9.0), (5, "a", q, 2.0, 9.0), (4, "b", q, None, None), (5, "b", q, None, None)}
    assert V.panels_as_of(intervals, [], ["P"]).collect() == []
