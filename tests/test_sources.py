"""Dataset tables, landing and views."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.functions import scalars as S
from marketmill.sources import datasets as D
from marketmill.sources import landing as L
from marketmill.sources.views import Manifest, Views

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("date", T.StringType()), T.StructField("v", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted((str(r.k), str(r.date), r.v) for r in df.collect())


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    assert D.read_dataset(spark, path, SCHEMA).count() == 0
    D.write_dataset(frame(spark, [("a", "2024-01-01", 1), ("b", "2024-01-01", 2), (None, "x", 3)]), path, ["k"], 4)
    assert rows(D.read_dataset(spark, path, SCHEMA)) == [("None", "x", 3), ("a", "2024-01-01", 1), ("b", "2024-01-01", 2)]
    assert rows(D.read_dataset(spark, path, SCHEMA, {"k": "b"})) == [("b", "2024-01-01", 2)]
    assert rows(D.read_dataset(spark, path, SCHEMA, {"k": None})) == [("None", "x", 3)]
    # another bucket count does not matter for an existing table
    D.overwrite_keys(spark, frame(spark, [("b", "2024-01-02", 5), ("c", None, 6)]), path, SCHEMA, ["k"], 8)
    assert rows(D.read_dataset(spark, path, SCHEMA)) == [("None", "x", 3), ("a", "2024-01-01", 1), ("b", "2024-01-02", 5), ("c", "None", 6)]
    D.delete_keys(spark, spark.createDataFrame([("a",), (None,)], "k string"), path, SCHEMA, ["k"])
    assert rows(D.read_dataset(spark, path, SCHEMA)) == [("b", "2024-01-02", 5), ("c", "None", 6)]
    D.delete_keys(spark, spark.createDataFrame([("b",), ("c",)], "k string"), path, SCHEMA, ["k"])
    assert D.read_dataset(spark, path, SCHEMA).count() == 0


def test_keys_in_any_order_and_in_part(spark, tmp_path):
    path = str(tmp_path / "t")
    data = frame(spark, [("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("b", "2024-01-01", 3)])
    D.write_dataset(data, path, ["k", "date"], 8)
    one = [("a", "2024-01-02", 2)]
    assert rows(D.read_dataset(spark, path, SCHEMA, {"k": "a", "date": "2024-01-02"})) == one
    assert rows(D.read_dataset(spark, path, SCHEMA, {"date": "2024-01-02", "k": "a"})) == one
    assert rows(D.read_dataset(spark, path, SCHEMA, {"k": "a"})) == [("a", "2024-01-01", 1), ("a", "2024-01-02", 2)]
    wanted = spark.createDataFrame([("2024-01-01", "b")], "date string, k string")
    assert rows(D.read_keys(spark, path, SCHEMA, wanted, ["date", "k"])) == [("b", "2024-01-01", 3)]
    assert rows(D.read_keys(spark, path, SCHEMA, wanted, ["k"])) == [("b", "2024-01-01", 3)]
    D.overwrite_keys(spark, frame(spark, [("b", "2024-01-01", 9)]), path, SCHEMA, ["date", "k"])
    assert rows(D.read_dataset(spark, path, SCHEMA, {"k": "b"})) == [("b", "2024-01-01", 9)]
    with pytest.raises(ValueError):
        D.delete_keys(spark, wanted, path, SCHEMA, ["k"])
    plain = str(tmp_path / "plain")
    data.write.parquet(plain)
    with pytest.raises(ValueError):
        D.read_dataset(spark, plain, SCHEMA)


def test_range_keeps_undated(spark):
    df = frame(spark, [("a", "2024-01-01", 1), ("a", "2024-01-05 10:00:00", 2), ("a", None, 3), ("a", "bad", 4), ("a", "2024-02-01", 5)])
    got = lambda *a, **k: sorted(r.v for r in D.read_range(df, "date", *a, **k).collect())
    assert got("2024-01-02", "2024-01-05") == [2, 3, 4]
    assert got("2024-01-05") == [2, 3, 4, 5]
    assert got(None, "2024-01-01") == [1, 3, 4]
    assert got("2024-01-02", "2024-01-05", keep_undated=False) == [2]
    assert got() == [1, 2, 3, 4, 5]
    ts = df.select("v", F.try_to_timestamp(F.lit("2024-01-05 10:00:00")).alias("date"))
    assert D.read_range(ts, "date", "2024-01-05", "2024-01-05").count() == 5


def test_append_is_by_date(spark):
    old = frame(spark, [("a", "2024-01-01", 1), ("a", None, 2)])
    new = frame(spark, [("a", "2024-01-01", 3), ("a", "2024-01-02", 4), ("a", "2024-01-02", 5), ("a", None, 6), ("b", "2024-01-01", 7)])
    assert sorted(r.v for r in D.append_new(old, new, "date", ["k"]).collect()) == [1, 2, 4, 5, 7]
    assert sorted(r.v for r in D.append_new(old, new, "date").collect()) == [1, 2, 4, 5]


def test_coverage_counts_undated_rows(spark):
    df = frame(spark, [("a", "2024-01-03", 1), ("a", "2024-01-01", 1), ("a", None, 1), ("b", "bad", 1)])
    out = D.coverage(df, ["k"], "date", "2024-02-01").collect()
    assert [(r.k, str(r.min_date), str(r.max_date), r.record_count) for r in out] == [("a", "2024-01-01", "2024-01-03", 3)]


def test_corrupt_file_is_nothing_stored(spark, tmp_path):
    path = str(tmp_path / "t")
    D.write_dataset(frame(spark, [("a", "2024-01-01", 1)]), path, ["k"], 2)
    bucket = next(p for p in os.listdir(path) if p.startswith("key_bucket"))
    good = next(f for f in os.listdir(f"{path}/{bucket}") if f.endswith(".parquet"))
    data = open(f"{path}/{bucket}/{good}", "rb").read()
    with open(f"{path}/{bucket}/broken.parquet", "wb") as f:
        f.write(data[: len(data) // 2])
    assert D.read_dataset(spark, path, SCHEMA, ignore_corrupt=True).count() == 1
    open(f"{path}/{bucket}/none.parquet", "wb").close()
    frame(spark, []).coalesce(1).write.mode("append").parquet(f"{path}/{bucket}")
    with open(f"{path}/{bucket}/other.parquet", "wb") as f:
        f.write(b"no table at all, but long enough")
    states = {os.path.basename(r.path): r.state for r in D.file_states(spark, path).collect()}
    named = {k: v for k, v in states.items() if not k.startswith("part-")}
    assert named == {"broken.parquet": "broken", "none.parquet": "empty", "other.parquet": "broken"}
    assert len(states) > 4 and {v for k, v in states.items() if k.startswith("part-")} == {"sound"}
    assert {os.path.basename(r.path) for r in D.skipped_files(spark, path).collect()} == set(named)
    assert D.file_states(spark, str(tmp_path / "nothing")).collect() == []


@pytest.mark.parametrize("step", ["stage", "record", "write", "empty", "remove"])
def test_a_broken_replacement_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    old = [("a", "2024-01-01", 1), ("b", "2024-01-01", 2), ("c", "2024-01-01", 3), ("d", "2024-01-01", 4)]
    D.write_dataset(frame(spark, old), path, ["k"], 3)
    doomed = spark.createDataFrame([("a",), ("b",), ("c",), ("x",)], "k string")
    new = [("x", "2024-02-02", 9)]
    writer, removed = type(frame(spark, [])).write.fget, D._remove
    count = {"n": 0}
    at = {"stage": 1, "record": 2, "write": 3, "empty": 4}

    def write(self):
        count["n"] += 1
        if count["n"] == at.get(step):
            raise OSError("disk")
        return writer(self)

    def remove(spark_, folder):
        if step == "remove" and folder.endswith(D.PENDING):
            raise OSError("disk")
        removed(spark_, folder)

    with monkeypatch.context() as m:
        m.setattr(type(frame(spark, [])), "write", property(write))
        m.setattr(D, "_remove", remove)
        with pytest.raises(OSError):
            D.overwrite_keys(spark, frame(spark, new), path, SCHEMA, ["k"], replaced=doomed)
    want = sorted(old) if step in ("stage", "record") else sorted([old[3], new[0]])
    assert rows(D.read_dataset(spark, path, SCHEMA)) == want
    assert rows(D.read_dataset(spark, path, SCHEMA, {"k": "d"})) == [old[3]]
    D.overwrite_keys(spark, frame(spark, [("e", "2024-03-03", 5)]), path, SCHEMA, ["k"])
    assert rows(D.read_dataset(spark, path, SCHEMA)) == sorted([*want, ("e", "2024-03-03", 5)])
    assert not os.path.exists(f"{path}/{D.PENDING}")


def test_reconcile_types(spark):
    bodies = [
        '{"big": 9007199254740993, "mixed": "n/a", "num": 1, "real": 1.5, "flag": true, "nested": {}, "nul": null}',
        '{"big": 1, "mixed": 5, "num": 2, "real": 2, "flag": false, "nested": {"a": 1}}',
        '{"num": null, "edge": 9007199254740992}',
    ]
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    out = L.reconcile_types(raw, "body", ["big", "mixed", "num", "real", "flag", "nested", "nul", "edge"])
    kinds = dict(out.dtypes)
    assert kinds["big"] == kinds["mixed"] == "string"
    assert (kinds["num"], kinds["real"], kinds["flag"], kinds["edge"]) == ("bigint", "double", "boolean", "bigint")
    r = out.orderBy("id").collect()
    assert [x.big for x in r] == ["9007199254740993", "1", None]
    assert [x.mixed for x in r] == ["n/a", "5", None]
    assert [x.nested for x in r] == [None, '{"a":1}', None]
    assert raw.first().body == bodies[0]


def test_ingest_json(spark):
    bodies = ["", "  ", '{"Error Message": "Invalid key"}', '[{"a": 1, "b": "x"}, {"a": "bad"}]', '{"a": 3}', "[]"]
    raw = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string")
    data, errors = L.ingest_json(raw, "body", T.StructType([T.StructField("a", T.LongType())]), ["id"])
    assert [(r.id, r.error) for r in errors.collect()] == [(2, "Invalid key")]
    got = data.orderBy("id", "pos").collect()
    assert [(r.id, r.a) for r in got] == [(3, 1), (3, None), (4, 3)]
    assert got[0].extra == {"b": "x"}


def test_views(spark, tmp_path):
    v = Views(spark, str(tmp_path / "views"))
    assert v.names() == [] and v.read("x") is None and v.drop("x") is False
    one = spark.createDataFrame([(1, "a")], "i int, s string")
    v.publish(one, Manifest("x", "table", "h", exports=["x"], sources=["t"], freshness={"t": "1"}))
    v.publish(one.unionByName(one), Manifest("x", "table", "h2"))
    v.publish(one, Manifest("a", "table", "h"))
    assert v.names() == ["a", "x"]
    assert v.read("x").count() == 2 and v.read("x").schema == one.schema
    assert v.manifest("x")["expr_hash"] == "h2" and v.manifest("x")["columns"] == ["i", "s"]
    assert v.drop("x") is True and v.read("x") is None and v.names() == ["a"]


def test_scalars(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00", "$15,001 - $50,000", "97.29%", "{bad", "Over $5,000,000")], "d string, a string, p string, j string, o string")
    low, high = S.amount_bounds("a")
    olow, ohigh = S.amount_bounds("o")
    r = df.select(
        S.lead_date("d").alias("d"), S.lead_date("a").alias("n"), low.alias("lo"), high.alias("hi"), S.percent_to_number("p").alias("p"),
        F.to_json(S.json_object("j")).alias("j"), S.series_key("e", "p", F.lit(None)).alias("k"), olow.alias("ol"), ohigh.alias("oh"),
    ).first()
    assert (r.d, r.n, r.lo, r.hi, r.p, r.j, r.k) == (dt.date(2024, 1, 5), None, 15001, 50000, 97.29, "{}", "e/97.29%/_default")
    assert (r.ol, r.oh) == (5000000, 5000000)


def test_broken_bodies_and_dotted_names(spark):
    from marketmill.sources import landing as L

    raw = spark.createDataFrame([(1, '[{"a": 1}, {"a"'), (2, '{"Error Message": null}'), (3, '[{"a": 2}]')], "id int, body string")
    data, errors = L.ingest_json(raw, "body", spark.createDataFrame([], "a int").schema, ["id"])
    assert sorted((r.id, r.a, r.record) for r in data.collect()) == [(1, None, '[{"a": 1}, {"a"'), (3, 2, '{"a":2}')]
    assert [(r.id, r.error) for r in errors.collect()] == [(2, None)]
    out = L.reconcile_types(spark.createDataFrame([('{"a.b": 1}',), ('{"a.b": 2}',)], "j string"), "j", ["a.b"])
    assert out.dtypes == [("a.b", "bigint")] and sorted(r[0] for r in out.collect()) == [1, 2]
