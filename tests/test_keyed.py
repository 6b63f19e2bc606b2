"""Keyed tables: no lost update, unique columns, repeated commits, deltas that follow the change, and streams into them."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from quillmine.sources import keyed
from quillmine.streaming import ingest

SCHEMA = "k string, n long, pmid string"


def table(spark, path, **more):
    return keyed.KeyedTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, "k", **more)


def rows(t, version=None):
    return {r.k: (r.n, r.pmid) for r in t.read(version).collect()}


def test_put_remove_and_versions(spark, tmp_path):
    t = table(spark, tmp_path, fold=100)
    df = lambda *r: spark.createDataFrame(r, SCHEMA)
    assert rows(t) == {} and t.version() == 0
    t.put(df(("a", 1, "x"), ("b", 2, ""), ("c", 3, None), (None, 9, "q")))
    t.put(df(("b", 20, "y")), spark.createDataFrame([("c",), ("zz",), (None,)], "k string"))
    t.put(removed=df(("a", 0, "")))
    t.put(df(("a", 5, "x"), ("c", 6, "")), df(("c", 0, "")))
    want = {"a": (5, "x"), "b": (20, "y")}
    assert rows(t) == want and rows(t, 1) == {"a": (1, "x"), "b": (2, ""), "c": (3, None)} and rows(t, 3) == {"b": (20, "y")}
    assert t.compact() and rows(t) == want and t._last()[1]["deltas"] == []
    with pytest.raises(ValueError, match="needs rows"):
        t.put()


def test_unique_columns(spark, tmp_path):
    t = table(spark, tmp_path, unique=("pmid",))
    df = lambda *r: spark.createDataFrame(r, SCHEMA)
    t.put(df(("a", 1, "x"), ("b", 2, ""), ("c", 3, "")))
    for bad in (df(("d", 1, "x")), df(("d", 1, "z"), ("e", 1, "z")), df(("b", 1, "x"))):
        with pytest.raises(keyed.NotUnique, match="pmid"):
            t.put(bad)
    with pytest.raises(keyed.NotUnique, match="changed twice"):
        t.put(df(("d", 1, ""), ("d", 2, "")))
    t.put(df(("a", 1, "y"), ("d", 1, "x")))  # the value moves on in one commit
    t.put(df(("e", 1, "y")), df(("a", 0, "")))
    assert rows(t) == {"b": (2, ""), "c": (3, ""), "d": (1, "x"), "e": (1, "y")} and t.version() == 3


def test_no_lost_update(spark, tmp_path):
    """Writers that all read the same version before any of them writes."""
    t = table(spark, tmp_path, fold=4)
    t.put(spark.createDataFrame([("sum", 0, ""), ("other", 7, "")], SCHEMA))
    ready, met = threading.Barrier(4), []

    def add(i):
        first = True

        def change(state):
            nonlocal first
            now = state.where("k = 'sum'").first().n
            if first:
                first = False
                ready.wait(60)
            met.append((i, now))
            return state.where("k = 'sum'").withColumn("n", F.lit(now + 10**i).cast("long")), None

        return t.commit(change)

    with ThreadPoolExecutor(4) as pool:
        versions = sorted(pool.map(add, range(4)))
    assert rows(t) == {"sum": (1111, ""), "other": (7, "")} and len(set(versions)) == 4
    assert [m for m in met if m[1] == 0].__len__() == 4 and len(met) > 4  # three were refused at least once


def test_uniqueness_holds_between_writers(spark, tmp_path):
    t = table(spark, tmp_path, unique=("pmid",))
    t.put(spark.createDataFrame([("x", 0, "")], SCHEMA))
    ready = threading.Barrier(2)

    def claim(name):
        first = True

        def change(_):
            nonlocal first
            if first:
                first = False
                ready.wait(60)
            return spark.createDataFrame([(name, 1, "same")], SCHEMA), None

        try:
            return t.commit(change)
        except keyed.NotUnique:
            return None

    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(claim, ["a", "b"]))
    assert got.count(None) == 1 and len(rows(t)) == 2


def test_tokens_publishing_and_forgetting(spark, tmp_path):
    t = table(spark, tmp_path / "t", fold=3)
    one = spark.createDataFrame([("a", 1, "")], SCHEMA)
    assert t.put(one, token="b:1") == t.put(one.withColumn("n", F.lit(5).cast("long")), token="b:1") == 1
    for i in range(12):
        t.put(spark.createDataFrame([(f"k{i}", i, "")], SCHEMA), token=f"b:{i + 2}")
    assert len(rows(t)) == 13 and t.put(one.withColumn("n", F.lit(8).cast("long")), token="b:1") == t.version()
    numbers = t._numbers()
    named = {x for n in numbers for x in (t._manifest(n)["base"], *t._manifest(n)["deltas"]) if x}
    assert len(numbers) < 10 and named == {p.name for p in (tmp_path / "t" / "data").iterdir()}
    assert keyed.publish(spark, f"{tmp_path}/p/one", "1") and not keyed.publish(spark, f"{tmp_path}/p/one", "2")
    (tmp_path / "p" / "draft").write_text("3")
    assert not keyed._renamed(spark, f"{tmp_path}/p/draft", f"{tmp_path}/p/one") and keyed._renamed(spark, f"{tmp_path}/p/draft", f"{tmp_path}/p/two")
    assert (tmp_path / "p" / "one").read_text() == "1" and (tmp_path / "p" / "two").read_text() == "3"


def test_streams_write_what_they_change(spark, tmp_path):
    base = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("n"), F.lit("").alias("pmid"))
    t = table(spark, tmp_path / "t", fold=100)
    t.put(base)
    for i in range(3):
        base.where(f"n < {10 * (i + 1)}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    total = lambda old, new: old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n")).withColumn("pmid", F.lit(""))
    for _ in range(2):
        ingest.ingest_keyed(stream(), t, f"{tmp_path}/cp", total)
    got = rows(t)
    assert len(got) == 20_000 and got["k5"][0] == 20 and got["k15"][0] == 45 and got["k25"][0] == 50 and got["k31"][0] == 31
    size = lambda name: sum(p.stat().st_size for p in (tmp_path / "t" / "data" / name).rglob("*.parquet"))
    first, *others = t._last()[1]["deltas"]
    assert len(others) == 3 and all(size(o) < size(first) / 5 for o in others)
