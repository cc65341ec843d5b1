"""Tables in key buckets: what a load rewrites, ids that stay, and two loads at once."""

import os

import pytest

from tallybook.operators import upsert

KEY, VALUES = ["k"], ["v", "w"]


def rows(spark, *given):
    return spark.createDataFrame(list(given), "k string, v long, w date")


def load(store, run_id, table, rows):
    return upsert.publish(store, run_id, {table: upsert.stage(store, run_id, table, rows, KEY, VALUES, "id", 8)}, {})


def content(store):
    return {r["k"]: (r["id"], r["v"]) for r in store.read("t").collect()}


def test_only_changed_buckets_are_written(spark, tmp_path):
    out = str(tmp_path)
    first = load(upsert.snapshot(spark, out), "a", "t", rows(spark, *[(f"k{i:03}", i, None) for i in range(200)]))
    assert first.number == 1 and len(first.paths["t"]) == 8 and first.tops["t"] == 200
    assert content(first) == {f"k{i:03}": (i + 1, i) for i in range(200)}
    bucket = {r["k"]: r["b"] for r in rows(spark, ("k007", 7, None), ("k008", 8, None), ("x", 0, None)).select("k", upsert.bucket_of(KEY, 8).alias("b")).collect()}
    staged = upsert.stage(first, "b", "t", rows(spark, ("k007", 70, None), ("k008", 8, None), ("x", 0, None)), KEY, VALUES, "id", 99)
    assert staged.rewritten == sorted({bucket["k007"], bucket["x"]}) and (staged.inserted, staged.updated) == (1, 1)
    assert {r["k"] for r in staged.changed.collect()} == {"k007", "x"}
    second = upsert.publish(first, "b", {"t": staged}, {})
    assert {d for d in os.listdir(tmp_path / "run=b" / "t") if d.startswith("__")} == {f"__bucket={b}" for b in staged.rewritten}
    assert all("run=a" in p for b, p in second.paths["t"].items() if b not in staged.rewritten)
    now = content(second)
    assert now["k007"] == (8, 70) and now["k008"] == (9, 8) and now["x"] == (201, 0) and len(now) == 201
    assert content(first)["k007"] == (8, 7)  # the earlier snapshot stays as it was
    third = load(second, "c", "t", rows(spark, ("k007", 70, None)))
    assert not os.path.exists(tmp_path / "run=c" / "t") and third.number == 3 and content(third) == now


def test_of_two_loads_at_once_one_is_refused(spark, tmp_path):
    out = str(tmp_path)
    begun = load(upsert.snapshot(spark, out), "a", "t", rows(spark, ("k", 1, None)))
    mine = {"t": upsert.stage(begun, "mine", "t", rows(spark, ("k", 2, None)), KEY, VALUES, "id")}
    theirs = {"t": upsert.stage(begun, "theirs", "t", rows(spark, ("k", 3, None), ("n", 3, None)), KEY, VALUES, "id")}
    upsert.publish(begun, "mine", mine, {})
    with pytest.raises(upsert.ConcurrentLoad):
        upsert.publish(begun, "theirs", theirs, {})
    now = upsert.snapshot(spark, out)
    assert now.run_id == "mine" and content(now) == {"k": (1, 2)}
    again = load(now, "again", "t", rows(spark, ("k", 3, None), ("n", 3, None)))  # begun anew, it goes through
    assert content(again) == {"k": (1, 3), "n": (2, 3)}


def test_empty_loads_and_other_tables(spark, tmp_path):
    out = str(tmp_path)
    none = upsert.snapshot(spark, out)
    assert none.number == 0 and "t" not in none
    empty = load(none, "a", "t", rows(spark))
    assert empty.read("t").count() == 0 and empty.read("t").columns == ["id", "k", "v", "w"]
    filled = upsert.publish(empty, "b", {}, {"log": spark.range(3)})
    assert filled.read("log").count() == 3 and "t" in filled and filled.tops["t"] == 0
    with pytest.raises(FileNotFoundError):
        filled.read("other")
