"""Keys, merges, increments and quality rules on hand-made tables."""

import datetime as dt

from pyspark.sql import functions as F

from martkit.operators import incremental as inc
from martkit.operators import quality as q
from martkit.operators.keys import dense_keys, keep_first, keep_last
from martkit.operators.merge import insert_absent, not_in, upsert


def test_dense_keys_follow_order_across_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("v"))
    keyed = dense_keys(df, ["v"], "k", num_partitions=5).collect()
    assert sorted((r.v, r.k) for r in keyed) == [(v, v + 1) for v in range(1000)]
    again = dense_keys(df, ["v"], "k", start=101, num_partitions=3).agg(F.min("k"), F.max("k")).first()
    assert tuple(again) == (101, 1100)


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k int, o int, v string")
    assert {r.k: r.v for r in keep_first(df, ["k"], ["o"]).collect()} == {1: "a", 2: "z"}
    assert {r.k: r.v for r in keep_last(df, ["k"], ["o"]).collect()} == {1: "c", 2: "z"}


def test_not_in_three_valued(spark):
    src = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    dim_null = spark.createDataFrame([(1,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert sorted(r.k for r in not_in(src, "k", dim, "k").collect()) == [2]
    assert not_in(src, "k", dim_null, "k").count() == 0  # a null in the list: nothing qualifies
    assert not_in(src, "k", empty, "k").count() == 3  # empty list: everything, null too


def test_insert_absent_one_row_per_key(spark):
    dim = spark.createDataFrame([(1, "A")], "id int, name string")
    src = spark.createDataFrame([(1, "A"), (2, "B2"), (2, "B1"), (None, "N")], "id int, name string")
    got = insert_absent(dim, src, "id", [F.min("name").alias("name")]).collect()
    assert sorted((r.id, r.name) for r in got) == [(1, "A"), (2, "B1")]


def _dim(spark):
    return spark.createDataFrame(
        [(1, "a", "x1", dt.datetime(2000, 1, 1)), (2, "b", "y1", dt.datetime(2000, 1, 1))],
        "sid long, key string, attr string, load_dttm timestamp_ntz",
    )


def test_upsert_updates_inserts_and_is_idempotent(spark):
    t = _dim(spark)
    s = spark.createDataFrame([("b", "y2"), ("d", "w"), ("c", "z")], "key string, attr string")
    ts = F.lit(dt.datetime(2001, 1, 1)).cast("timestamp_ntz")
    once = upsert(t, s, ["key"], "sid", "load_dttm", ts)
    rows = sorted((r.sid, r.key, r.attr) for r in once.collect())
    assert rows == [(1, "a", "x1"), (2, "b", "y2"), (3, "c", "z"), (4, "d", "w")]
    twice = upsert(once, s, ["key"], "sid", "load_dttm", ts)
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_upsert_into_empty_target(spark):
    t = _dim(spark).limit(0)
    s = spark.createDataFrame([("b", "1"), ("a", "2")], "key string, attr string")
    got = upsert(t, s, ["key"], "sid", "load_dttm", F.lit(dt.datetime(2001, 1, 1)).cast("timestamp_ntz"))
    assert sorted((r.sid, r.key) for r in got.collect()) == [(1, "a"), (2, "b")]


def test_empty_delta_keeps_the_mark(spark):
    empty = spark.createDataFrame([], "a timestamp_ntz, b timestamp_ntz")
    mark = dt.datetime(2001, 1, 1)
    assert inc.next_mark(empty, ["a", "b"], mark) == mark


def test_changed_rows_union_of_conditions(spark):
    mark = dt.datetime(2000, 6, 1)
    old, new = dt.datetime(2000, 1, 1), dt.datetime(2001, 1, 1)
    fact = spark.createDataFrame([(1, 10, old), (2, 20, new), (3, 30, old), (4, 10, new)],
                                 "order_id long, customer_id long, load_dttm timestamp_ntz")
    cust = spark.createDataFrame([(10, old), (30, new)], "customer_id long, load_dttm timestamp_ntz")
    got = inc.changed_rows(fact, "load_dttm", mark, [(cust, "customer_id", "load_dttm")])
    assert sorted(r.order_id for r in got.collect()) == [2, 3, 4]


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, "A", None), (1, "B", 2.0), (2, "Z", 1.0)], "k int, c string, x double")
    assert [tuple(r) for r in q.unique_violations(df, ["k"]).collect()] == [(1, 2)]
    nulls = {r.column_name: r.null_count for r in q.null_counts(df).collect()}
    assert nulls == {"k": 0, "c": 0, "x": 1}
    assert q.domain_violations(df, "c", ["A", "B"]).count() == 1
    parent = spark.createDataFrame([(1,)], "k int")
    assert q.fk_violations(df, "k", parent, "k").count() == 1
    report = q.summarize([("u", q.ERROR, q.unique_violations(df, ["k"]))]).collect()
    assert [tuple(r) for r in report] == [("u", "ERROR", 1)]
