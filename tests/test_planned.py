"""Ranks, references in one pass, planned writes, quarantined lines, keys."""

import os
import random

import pytest
from pyspark.sql import functions as F

from martkit.functions.numeric import div_round, typed
from martkit.operators.keys import hash_key
from martkit.operators.merge import write_version
from martkit.operators.quality import null_keys, reference_counts
from martkit.operators.ranks import with_ranks
from martkit.plans import catalog, venues
from martkit.session import scratch_path
from martkit.sources import io


@pytest.mark.parametrize("descending", [False, True])
def test_ranks_equal_the_window(spark, descending):
    """100,000 rows, a third of them tied, over many partitions; nulls."""
    v = F.when(F.col("id") % 3 == 0, F.lit(50)).when(F.col("id") % 97 == 0, F.lit(None)).otherwise((F.hash("id") % 700).cast("int"))
    df = spark.range(100_000).select("id", v.alias("v"))
    got = with_ranks(df, ["v"], descending, num_partitions=13)
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    from pyspark.sql import Window

    w = Window.orderBy(order)
    want = df.withColumn("rank", F.rank().over(w).cast("bigint")).withColumn("dense_rank", F.dense_rank().over(w).cast("bigint"))
    assert got.exceptAll(want).isEmpty() and got.count() == 100_000
    small = spark.createDataFrame([(2, "a"), (1, "b"), (2, "a"), (2, "c")], "x int, y string")
    rows = with_ranks(small, ["x", "y"]).collect()
    assert sorted((r.x, r.y, r["rank"], r.dense_rank) for r in rows) == [(1, "b", 1, 1), (2, "a", 2, 2), (2, "a", 2, 2), (2, "c", 4, 3)]
    assert with_ranks(small.limit(0), ["x"]).collect() == []


def test_no_task_sees_all_rows_of_a_ranking(spark):
    plan = with_ranks(spark.range(1000), ["id"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_part" not in line]
    assert not windows  # every window is by partition number or over the one row per partition


def test_references_in_one_pass(spark):
    child = spark.createDataFrame([(1, 10), (1, 11), (2, None), (3, 10), (3, 12), (None, 12)], "a int, b bigint")
    p, q = spark.createDataFrame([(1,), (3,), (3,)], "k bigint"), spark.createDataFrame([(10,), (None,)], "k int")
    refs = [("a->p", "c", "a", "p", "k"), ("b->q", "c", "b", "q", "k"), ("q->p", "q", "k", "p", "k"), ("e->p", "e", "x", "p", "k")]
    tables = {"c": child, "p": p, "q": q, "e": spark.createDataFrame([], "x int")}
    out = reference_counts(refs, tables)
    assert {r.rule: r.n_bad for r in out.collect()} == {"a->p": 1, "b->q": 3, "q->p": 1, "e->p": 0}
    g = random.Random(1)
    rows = [(g.randrange(50), g.randrange(50)) for _ in range(500)]
    keys = [(k,) for k in range(0, 50, 3)]
    tables = {"c": spark.createDataFrame(rows, "a int, b int"), "p": spark.createDataFrame(keys, "k int")}
    got = reference_counts([("a", "c", "a", "p", "k"), ("b", "c", "b", "p", "k")], tables).collect()
    known = {k for k, in keys}
    assert {r.rule: r.n_bad for r in got} == {"a": sum(a not in known for a, _ in rows), "b": sum(b not in known for _, b in rows)}


def test_each_table_is_read_once_for_its_references(spark, sf):
    from martkit.plans.quality import foreign_keys

    plan = foreign_keys(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("lineitem.parquet") <= 1 and plan.count("ReadSchema: struct<l_orderkey") >= 1


def _files(path):
    return {d: [f for f in os.listdir(os.path.join(path, d)) if f.startswith("part-")] for d in os.listdir(path) if "=" in d}


def test_files_follow_periods_and_sizes(spark):
    """One file per small period, several for the one with a third of the
    rows; at most periods + bytes / target in all."""
    df = spark.range(60_000).repartition(12).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 20).alias("day"), F.sha2(F.col("id").cast("string"), 512).alias("x"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        path = scratch_path(spark, "planned")
        out = write_version(df, path, ["day"])
        files = _files(path)
        total = sum(os.path.getsize(os.path.join(path, d, f)) for d, fs in files.items() for f in fs)
        assert len(files) == 20 and len(files["day=0"]) > 1
        assert sum(map(len, files.values())) <= 2 * (20 + total / (256 << 10)) < 12 * 20
        assert out.count() == 60_000 and out.select("x").distinct().count() == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_payloads_have_a_bounded_size(spark, sf):
    whole = {(r.category, r.url) for r in catalog.catalog_categories(spark, sf).collect()}
    for entries in (1, 3, 1000):
        payloads = catalog.root_payloads(spark, sf, entries)
        assert {(r.category, r.url) for r in catalog.catalog_from_json(payloads).collect()} == whole
    assert catalog.root_payloads(spark, sf, 3).count() > 1


def test_damaged_lines_are_kept_apart(spark):
    lines = ["id,uniq", "1,10", "2,x", "3,30", "4,40,50", "null,60"]
    path = scratch_path(spark, "lines")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    schema = "id bigint, uniq bigint"
    from pyspark.sql.types import StructType

    rows, bad = io.read_csv_quarantined(spark, path, StructType.fromDDL(schema), most_bad=0.5)
    assert sorted((r.id or 0, r.uniq) for r in rows.collect()) == [(0, 60), (1, 10), (3, 30)]
    assert sorted(r.line for r in bad.collect()) == ["2,x", "4,40,50"]
    with pytest.raises(io.TooManyBadRows, match="2 of 5"):
        io.read_csv_quarantined(spark, path, StructType.fromDDL(schema), most_bad=0.1)


def test_hash_keys_keep_values_apart(spark):
    rows = [("a", "b"), ("a\x1fb", ""), ("a", "\x1fb"), (None, "b"), ("\x00", "b"), ("", "b"), ("-:", "b"), ("1:a", "b"), ("a1", ":b")]
    df = spark.createDataFrame(rows, "x string, y string").select(hash_key("x", "y").alias("h"))
    assert df.distinct().count() == len(rows)


def test_menu_documents_survive_odd_names(spark):
    rows = spark.createDataFrame([("v", 's"]:{', 'i":"', 1), ("v", "a", "b", 2), ("v", "a", "a", 3)], "restaurant_name string, section string, item string, price int")
    assert venues.menu_json(rows).first().menu == '{"a":{"a":3,"b":2},"s\\"]:{":{"i\\":\\"":1}}'


def test_divisions_and_casts(spark):
    one = spark.range(1)
    assert one.select(div_round(F.lit(5), F.lit(0)).alias("x")).first().x is None
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        one.select(div_round(F.lit(5), F.lit(0), guarded=False)).collect()
    assert one.select(typed(F.lit("x"), "int", lenient=True).alias("x")).first().x is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one.select(typed(F.lit("x"), "int")).collect()


def test_losses_of_a_merge(spark, sf):
    from martkit.plans import craft

    stage = craft.stage_external_orders(spark, sf, 2).limit(200).cache()
    n = stage.count()
    other = stage.limit(1).withColumn("customer_address", F.lit("elsewhere")).withColumn("order_completion_date", F.lit(None).cast("date"))
    keyless = stage.limit(3).withColumn("craftsman_email", F.lit(None).cast("string"))
    was = {r.rule: r.n_rows for r in craft.merge_losses(stage).collect()}
    now = {r.rule: r.n_rows for r in craft.merge_losses(stage.unionByName(other).unionByName(keyless)).collect()}
    assert n == 200 and {k: now[k] - was[k] for k in now} == {
        "no key d_craftsman": 3, "lost d_craftsman": 0, "no key d_product": 0, "lost d_product": 0,
        "no key d_customer": 0, "lost d_customer": 1, "collapsed f_order": now["collapsed f_order"] - was["collapsed f_order"]}
    assert now["collapsed f_order"] > was["collapsed f_order"] >= 0


def test_rows_without_a_key_are_reported(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, j int")
    assert {(r.k, r.j) for r in null_keys(df, ["k", "j"]).collect()} == {(None, 2), ("b", None)}
