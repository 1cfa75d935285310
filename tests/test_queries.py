"""Driver contract, invariants of the registered queries, and plan checks."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from martkit.plans import orders as od
from martkit.plans.craft import CraftWarehouse, MART_COLUMNS, mart_rows
from martkit.plans.registry import Registry
from martkit.session import scratch_path
from martkit.sources import fixtures as fx


def test_every_query_has_an_oracle():
    # The optional training-data queries have tests of their own.
    marts = [m for m in E._modules() if m.__name__ in E._PLAN_MODULES]
    assert len(marts) == len(E._PLAN_MODULES)
    for m in marts:
        assert set(m.QUERIES) == set(m.ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == MART_COLUMNS
    assert df.count() > 0


@pytest.mark.parametrize("split,touch", [("1990-01-01", True), ("1996-07-01", True), ("2000-01-01", True),
                                         ("2001-06-15", True), ("2000-01-01", False), ("2001-06-15", False)])
def test_incremental_mart_equals_full_recompute(spark, sf, split, touch):
    w = CraftWarehouse(spark, sf, increment_from=split, touch_unchanged=touch)
    l2 = w.load2
    full = mart_rows(l2["f_order"], l2["d_customer"], l2["d_product"])
    inc_rows = w.applied["mart"].drop("id")
    assert inc_rows.exceptAll(full.select(*inc_rows.columns)).count() == 0
    assert full.select(*inc_rows.columns).exceptAll(inc_rows).count() == 0
    ins, upd, marks = w.books["counts"]
    assert ins + upd == w.rows2.count() and marks == (1 if w.rows2.count() else 0)


def test_empty_increment_keeps_mart_and_mark(spark, sf):
    w = CraftWarehouse(spark, sf, increment_from="2100-01-01")
    assert w.books["counts"] == (0, 0, 0)
    assert w.books["marks"].count() == 1
    before = w.run1["mart"]
    after = w.applied["mart"]
    assert after.exceptAll(before.select(*after.columns)).count() == 0
    assert after.count() == before.count()


def test_run_day_is_idempotent(spark, sf):
    log = fx.user_order_log(spark, sf)
    day = log.agg(F.min("date_time")).first()[0].date()
    fact, ret = scratch_path(spark, "t_fact"), scratch_path(spark, "t_ret")
    od.run_day(spark, log, day, fact, ret)

    def state():
        return [sorted(map(str, spark.read.parquet(p).collect())) for p in (fact, ret)]

    first = state()
    od.run_day(spark, log, day, fact, ret)
    assert state() == first and all(first)


def test_conform_increment_dedupes_and_defaults_status(spark, sf):
    log = fx.user_order_log(spark, sf).drop("status")
    twice = log.unionByName(log).withColumn("id", F.col("uniq_id"))
    out = od.conform_increment(twice)
    assert out.count() == log.count()
    assert out.filter(F.col("status") != "shipped").count() == 0


def test_sales_slice_filter_reaches_the_scan(spark, sf):
    log = fx.user_order_log(spark, sf)
    plan = od.sales_fact(log, (dt.date(2024, 1, 3), dt.date(2024, 1, 3)))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "CartesianProduct" not in plan


def test_registry_batches_reject_with_reasons(spark, sf):
    r = Registry(spark, sf)
    sell = r.sell()
    reasons = {row.reason for row in sell.collect()}
    assert {None, "unknown car", "car already sold"} <= reasons
    cars, _ = r.sell_state
    sold_before = cars.filter(F.col("status") == "sold").select(F.col("vin").alias("car_vin"))
    assert sell.filter(F.col("outcome") == "accepted").join(sold_before, "car_vin").count() == 0
    ren = r.rename()
    assert {"unknown key", "new key exists"} <= {row.reason for row in ren.collect()}
    new_cars, new_sales = r.apply_renames()
    accepted = ren.filter(F.col("outcome") == "accepted").select(F.col("new_vin").alias("car_vin"))
    # Renames cascade: every sale still points at an existing car.
    assert new_sales.join(new_cars.select(F.col("vin").alias("car_vin")), "car_vin", "left_anti").count() == 0
    assert accepted.count() > 0


def test_sell_then_revert_restores_the_start(spark, sf):
    from martkit.plans.registry import revert_sales

    r = Registry(spark, sf)
    cars0, sales0 = r.sell_state
    cars1, sales1 = r.apply_sales()
    accepted = r.sell().filter(F.col("outcome") == "accepted").select("sales_number")
    assert accepted.count() > 0 and cars1.exceptAll(cars0).count() > 0
    outcomes, cars2, sales2 = revert_sales(cars1, sales1, accepted)
    assert outcomes.filter(F.col("outcome") != "reverted").count() == 0
    for a, b in ((cars2, cars0), (sales2, sales0)):
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_streaming_ingest_drops_repeats(spark, sf):
    got = E.queries()["stream_increment_ingest"](spark, sf)
    assert got.count() == got.select("uniq_id").distinct().count() == fx.user_order_log(spark, sf).count()


def test_no_cartesian_products_in_plans(spark, sf):
    for key in ["car_sales_fact", "top3_venues_by_type", "largest_menu_with_ties", "weekly_customer_retention"]:
        plan = E.queries()[key](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_insert_absent_avoids_null_aware_broadcast(spark, sf):
    plan = E.queries()["insert_absent_customer"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    anti = [line.strip() for line in plan.splitlines() if "LeftAnti" in line]
    # A hash join's last field is the null-aware flag; SQL NOT IN would print "true".
    assert anti and not any(line.endswith("true") for line in anti)


def test_fact_merge_reads_only_touched_months(spark, sf):
    w = CraftWarehouse(spark, sf, increment_from="2001-06-15")
    (fact, first), months = w.fact1, {r.m for r in w.stage2.select(F.date_format("order_created_date", "yyyy-MM").alias("m")).distinct().collect()}
    touched = w.store.read("f_order", fact.schema, months, first)
    folders = {f.rsplit("/", 2)[1].partition("=")[2] for f in touched.inputFiles()}
    assert folders == {"2001-06"} < months and len(first.folders["f_order"]) > 50
    assert set(w.store.changed_parts("f_order", first, w.fact2[1])) == months
