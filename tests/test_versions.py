"""Versioned tables: whole commits, failed ones, conflicts, removal."""

import os

import pytest
from pyspark.sql import functions as F

from martkit.operators.merge import upsert, upsert_version
from martkit.operators.versions import Conflict, Pointer, Versions, parts_of
from martkit.plans.craft import CraftWarehouse, mart_rows
from martkit.session import scratch_path

SCHEMA = "k string, month string, v int"


def month():
    return F.col("month")


def rows_of(store, pointer=None, parts=None):
    return sorted(tuple(r) for r in store.read("t", SCHEMA, parts, pointer).collect())


def test_a_commit_is_seen_whole_or_not_at_all(spark):
    store = Versions(spark, scratch_path(spark, "versions"))
    assert store.current() == Pointer() and rows_of(store) == []
    one = spark.createDataFrame([("a", "01", 1), ("b", "02", 2)], SCHEMA)
    first = store.commit(Pointer(), {"t": (one, month())}, parts_of(one, month()), {"last": 2})
    two = spark.createDataFrame([("b", "02", 5), ("c", "03", 6)], SCHEMA)
    staged = store.stage(first, {"t": (two, month())}, ["02", "03"])
    assert rows_of(store) == [("a", "01", 1), ("b", "02", 2)] and store.current() == first  # staged is not committed
    second = store.publish(staged)
    assert rows_of(store) == [("a", "01", 1), ("b", "02", 5), ("c", "03", 6)] and second.notes == {"last": 2}
    assert rows_of(store, first) == [("a", "01", 1), ("b", "02", 2)] and rows_of(store, second, ["03", "09"]) == [("c", "03", 6)]
    assert store.changed_parts("t", first, second) == ["02", "03"]
    assert second.folders["t"]["01"] == first.folders["t"]["01"]  # referenced, not copied


def test_failed_and_conflicting_commits_change_nothing(spark):
    store = Versions(spark, scratch_path(spark, "versions"))
    one = spark.createDataFrame([("a", "01", 1)], SCHEMA)
    first = store.commit(Pointer(), {"t": (one, month())}, ["01"])
    bad = one.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        store.commit(first, {"t": (bad, month())}, ["01"])
    with pytest.raises(ValueError, match="does not name"):
        store.commit(first, {"t": (one, month())}, ["02"])
    assert store.current() == first and rows_of(store) == [("a", "01", 1)]
    store.commit(first, {"t": (one.withColumn("v", F.lit(2)), month())}, ["01"])
    with pytest.raises(Conflict):
        store.commit(first, {"t": (one.withColumn("v", F.lit(3)), month())}, ["01"])
    assert rows_of(store) == [("a", "01", 2)]
    third = store.commit(store.current(), {"t": (one.limit(0), month())}, ["01"])  # a part without rows goes
    assert rows_of(store) == [] and third.folders["t"] == {}


def test_old_versions_are_removed_on_request(spark):
    store = Versions(spark, scratch_path(spark, "versions"))
    pointer, states = Pointer(), []
    for v in range(3):
        rows = spark.createDataFrame([("a", "01", v), *([("b", "02", 0)] if not v else [])], SCHEMA)
        pointer = store.commit(pointer, {"t": (rows, month())}, ["01", "02"] if not v else ["01"])
        states.append(pointer)
    fork = store.fork(scratch_path(spark, "fork"), states[1])
    gone = store.remove_old()
    assert gone == sorted({states[0].folders["t"]["01"], states[1].folders["t"]["01"]})
    assert rows_of(store) == [("a", "01", 2), ("b", "02", 0)] and store.remove_old() == []
    assert not any(os.path.exists(g) for g in gone) and all(os.path.exists(f) for f in pointer.folders["t"].values())
    fork.commit(states[1], {"t": (spark.createDataFrame([("a", "01", 9)], SCHEMA), month())}, ["01"])
    assert fork.remove_old() == [] and rows_of(store) == [("a", "01", 2), ("b", "02", 0)]  # a fork deletes nothing of its origin


def test_versioned_merge_reads_touched_parts_only(spark):
    store = Versions(spark, scratch_path(spark, "versions"))
    schema = "id bigint, k string, month string, v int, at int"
    base = spark.createDataFrame([(1, "a", "01", 1, 0), (2, "b", "02", 2, 0)], schema)
    first = store.commit(Pointer(), {"t": (base, month())}, ["01", "02"], {"last_id": 2})
    source = spark.createDataFrame([("b", "02", 7), ("c", "03", 8), (None, "03", 9)], SCHEMA)
    for run in (1, 2):  # a row without a key is not inserted by any run
        pointer = upsert_version(store, "t", spark.createDataFrame([], schema).schema, source, ["k", "month"], "id", month(), "at", F.lit(run))
        got = sorted(tuple(r) for r in store.read("t", schema).collect())
        assert got == [(1, "a", "01", 1, 0), (2, "b", "02", 7, run), (3, "c", "03", 8, run)]
        assert pointer.notes["last_id"] == 3 and pointer.folders["t"]["01"] == first.folders["t"]["01"]


def test_upsert_leaves_rows_without_a_key_out(spark):
    target = spark.createDataFrame([(1, "a", 1)], "id bigint, k string, v int")
    source = spark.createDataFrame([("a", 2), ("b", 3), (None, 4)], "k string, v int")
    for _ in range(2):
        target = upsert(target, source, ["k"], "id")
        assert sorted(tuple(r) for r in target.collect()) == [(1, "a", 2), (2, "b", 3)]


@pytest.mark.parametrize("touch", [True, False])
def test_the_mart_by_contributions_equals_a_rebuild(spark, sf, touch):
    w = CraftWarehouse(spark, sf, increment_from="2001-03-01", touch_unchanged=touch)
    mart, l2 = w.applied["mart"], w.load2
    want = mart_rows(l2["f_order"], l2["d_customer"], l2["d_product"])
    assert sorted(map(tuple, mart.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    ids = [r.id for r in mart.select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    # The orders whose contribution changed are part of the second load, not whole months.
    assert w.changed_orders.count() <= w.stage_fact2.count() < l2["f_order"].count()
    assert not w.applied["store"].read("counts", w.run1["schemas"]["counts"]).filter("n <= 0").count()
