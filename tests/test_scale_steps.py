"""Steps that must not carry more than they need: narrow rows, one pass, one join."""

import gzip
import os
from datetime import date, datetime

from martkit.operators import incremental as inc
from martkit.operators.batches import components
from martkit.operators.keys import keep_first, keep_last
from martkit.plans import cars, craft
from martkit.plans import registry as reg
from martkit.session import scratch_path
from martkit.sources import fixtures as fx
from martkit.sources import io


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stars_take_no_round(spark):
    stars = [(10 * i, 10 * i + k) for i in range(50) for k in range(1, 4)]
    labels, rounds = components(spark.createDataFrame(stars, "a bigint, b bigint"))
    assert rounds == 0
    assert {r.node: r.label for r in labels.collect()} == {x: 10 * (x // 10) for p in stars for x in p}


def test_components_of_nothing(spark):
    labels, _ = components(spark.createDataFrame([(7, 7)], "a bigint, b bigint"))
    assert labels.count() == 0


def test_delivered_files_are_compressed_and_read_whole(spark):
    path = scratch_path(spark, "csv")
    rows = spark.createDataFrame([(1, "a, b", None), (2, None, 1.5)], "id bigint, name string, x double")
    io.write_csv(rows, path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert sorted(map(tuple, io.read_csv_typed(spark, path, rows.schema).collect())) == [(1, "a, b", None), (2, None, 1.5)]


def test_record_files_keep_their_width(spark, sf):
    path = reg.Registry(spark, sf).write_cars()
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    with gzip.open(os.path.join(path, files[0]), "rt") as f:
        assert {len(line.rstrip("\n")) for line in f} == {io.RECORD_WIDTH}


def test_sell_requests_pass_once_over_the_sales(spark, sf):
    assert _plan(reg.Registry(spark, sf).sell_requests).count("Join ") == 1


def test_a_fact_goes_on_without_the_texts_it_resolved(spark):
    raw = spark.createDataFrame(
        [(1, "B m, red", "Mr. Al Bo", "+1-1", "X"), (2, "B m, blue", "Al Bo", "+1-1", "X"), (3, "C n, red", "Cy Do Jr.", "+2-2", None), (4, "C n, red", "Cy Do", None, None)],
        "id bigint, auto string, person_name string, phone string, brand_origin string",
    ).selectExpr("*", "cast(2.5 as decimal(3,1)) gasoline_consumption", "cast(9 as decimal(9,2)) price", "0 discount", "date'1999-01-01' date")
    shop = cars.CarShop(cars.parse_sales(raw))
    assert shop.resolved.columns == ["id", "car_id", "cc_id", "customer_id", "price", "discount", "date"]
    assert sorted((r.sale_id, r.customer_id) for r in shop.sales.collect()) == [(1, 1), (2, 1), (3, 2)]
    titles = {r.title_id: r.title_name for r in shop.titles.collect()}
    assert sorted((r.first_name, titles.get(r.title_id)) for r in shop.customers.collect()) == [("Al", "Mr."), ("Cy", "Jr.")]


def _tables(spark, customers) -> str:
    d = scratch_path(spark, "tables")
    ts = "timestamp_ntz'1999-05-01 00:00:00'"
    made = {
        "customer": spark.createDataFrame(customers, "c_custkey bigint, c_name string"),
        "orders": spark.range(2).selectExpr("id o_orderkey", "id o_custkey", f"{ts} o_orderdate"),
        "part": spark.range(1).selectExpr("id p_partkey", "'p' p_name", "'Brand#1' p_brand", "'T' p_type", "cast(1.5 as double) p_retailprice"),
        "supplier": spark.range(1).selectExpr("id s_suppkey", "'s' s_name"),
        "lineitem": spark.range(4).selectExpr("id % 2 l_orderkey", "0L l_partkey", "0L l_suppkey", "'F' l_linestatus", "'A' l_returnflag", f"{ts} l_shipdate"),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(os.path.join(d, f"{name}.parquet"))
    return d


def test_stage_needs_no_join_unless_a_customer_has_two_names(spark):
    one = _tables(spark, [(0, "a"), (0, "a"), (1, None), (None, "n"), (None, "m")])
    two = _tables(spark, [(0, "a"), (0, "b"), (1, "c")])
    assert fx.one_name_per_customer(spark, one) and not fx.one_name_per_customer(spark, two)
    for d, joins in ((one, 0), (two, 1)):
        stage = craft.stage_external_orders(spark, d, 1)
        assert _plan(stage).count("Join ") == joins
        orders = craft.external_orders(spark, d, 1)
        by_join = orders.drop("customer_name").join(craft.external_customers(orders, 1), "customer_id").select(*craft.STAGE_COLUMNS)
        assert sorted(map(str, stage.collect())) == sorted(map(str, by_join.collect()))
        assert stage.count() == (6 if joins == 0 else 10)


def test_surrogates_by_source_id_or_by_name(spark):
    dim = spark.createDataFrame([(11, "a", "x"), (12, "b", "x")], "_sid bigint, k1 string, k2 string")
    schema = "src bigint, k1 string, k2 string, v int"
    own = [(1, "a", "x", 1), (2, "b", "x", 2), (3, "a", "x", 3), (4, None, "x", 4), (4, "b", "x", 5), (5, "z", "x", 6)]
    for rows, narrow in ((own, True), ([*own, (1, "b", "x", 7), (None, "a", "x", 8)], False)):
        stage = spark.createDataFrame(rows, schema)
        got = craft.with_surrogate(stage, stage, dim, "src", ["k1", "k2"])
        assert sorted(got.columns) == ["src", "v"]
        sid = {("a", "x"): 11, ("b", "x"): 12}
        assert sorted((r.src, r.v) for r in got.collect()) == sorted((sid[k, m], v) for _, k, m, v in rows if (k, m) in sid)
        condition = [line for line in _plan(got).splitlines() if "Join " in line]
        assert any("k1" in line for line in condition) != narrow


def test_latest_attributes_of_a_key(spark):
    rows = [("k", "a", date(2000, 1, 1)), ("k", "b", date(2000, 1, 2)), ("k", "a", date(2000, 1, 2)), ("m", "a", None), ("m", None, None), (None, "q", date(2000, 1, 1))]
    stage = spark.createDataFrame(rows, "key string, attr string, order_created_date date")
    got = craft.merge_source(stage, ["key"], ["attr"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("k", "b"), ("m", "a"), (None, "q")], key=str)
    # Repeats go before the sorted aggregate.
    assert _plan(got).count("Aggregate ") == 2


def test_changed_rows_with_their_dimension_rows(spark):
    old, new = datetime(2000, 1, 1), datetime(2001, 1, 1)
    fact = spark.createDataFrame([(1, 1, 1, old), (2, 1, 2, old), (3, 2, 1, old), (4, 9, 1, new), (5, 1, 1, new)], "o int, a int, b int, load timestamp_ntz")
    a = spark.createDataFrame([(1, "p", old), (2, "q", new)], "a int, x string, a_load timestamp_ntz")
    b = spark.createDataFrame([(1, old), (2, new)], "b int, b_load timestamp_ntz")
    got = inc.changed_rows(fact, "load", old, [(a, "a", "a_load"), (b, "b", "b_load")], joined=True)
    plain = inc.changed_rows(fact, "load", old, [(a, "a", "a_load"), (b, "b", "b_load")]).join(a, "a").join(b, "b")
    assert sorted((r.o, r.x) for r in got.collect()) == sorted((r.o, r.x) for r in plain.collect()) == [(2, "p"), (3, "q"), (5, "p")]


def test_the_mart_is_written_as_parts_only(spark, sf):
    w = craft.loaded_warehouse(spark, sf)
    assert all("/warehouse-" in f for f in (*w.run1["mart"].inputFiles(), *w.fact1[0].inputFiles()))
    assert w.run1["pointer"].notes["last_id"] == w.run1["mart"].count()


def test_an_order_column_is_carried_once(spark):
    rows = [("k", 1, "a", "p"), ("k", 2, "a", "q"), ("k", 2, "b", None), ("m", None, "z", "r"), (None, 3, "a", "s")]
    df = spark.createDataFrame(rows, "key string, n int, t string, v string")
    last = keep_last(df, ["key"], ["n", "t"])
    assert last.columns == df.columns
    assert sorted(map(tuple, last.collect()), key=str) == sorted([("k", 2, "b", None), ("m", None, "z", "r"), (None, 3, "a", "s")], key=str)
    assert sorted(map(tuple, keep_first(df.drop("v"), ["key"], ["n", "t"]).collect()), key=str) == sorted([("k", 1, "a"), ("m", None, "z"), (None, 3, "a")], key=str)
    carried = _plan(keep_last(df.drop("v"), ["key"], ["n", "t"]))
    assert "_row" not in carried


def test_members_of_a_stage_stand_for_it(spark):
    """Dimension and links from a stage's sources are those from the stage."""
    rows = [(1, "a", "x", date(2000, 1, 1)), (1, "a", "x", date(2000, 1, 3)), (1, "a", "y", date(2000, 1, 2)), (2, "b", None, None), (None, "b", "z", date(1999, 1, 1)), (3, None, "q", None)]
    stage = spark.createDataFrame(rows, "src bigint, k string, attr string, order_created_date date")
    members = craft.sources(stage, "src", ["k"], ["attr"])
    assert members.count() == 5
    merged = [sorted(map(str, craft.merge_source(s, ["k"], ["attr"]).collect())) for s in (stage, members)]
    assert merged[0] == merged[1]
    dim = spark.createDataFrame([(11, "a"), (12, "b")], "_sid bigint, k string")
    links = [sorted(map(str, craft.with_surrogate(stage, s, dim, "src", ["k"]).collect())) for s in (stage, members)]
    assert links[0] == links[1]


def test_the_delta_is_no_table_for_its_keys(spark, sf):
    w = craft.loaded_warehouse(spark, sf)
    keys = w.affected
    assert "delta" not in w.__dict__
    assert not any("customer_address" in line for line in _plan(keys).splitlines() if "Relation" not in line)
    assert sorted(map(tuple, keys.collect())) == sorted(map(tuple, w.delta.select(*craft.MART_KEYS).distinct().collect()))


def test_each_figure_reads_its_own_entries(spark):
    orders = spark.createDataFrame(
        [(1, "2000-01", 1, "t", 5, "done", date(2000, 1, 9), date(2000, 1, 1)), (1, "2000-01", 2, "s", 5, "created", None, date(2000, 1, 1)), (2, "2000-01", 3, None, None, "created", None, date(2000, 1, 1))],
        "customer_id bigint, report_period string, order_id bigint, product_type string, craftsman_id bigint, order_status string, order_completion_date date, order_created_date date",
    ).selectExpr("*", "cast(2.5 as decimal(15,2)) product_price")
    state = craft.mart_figures().contributions(orders)
    got = craft.mart_figures().rows(state, ["top_product_category", "top_craftsman_id"], ["median_days"])
    assert sorted((r.customer_id, r.n, r.top_product_category, r.top_craftsman_id, r.median_days) for r in got.collect()) == [(1, 2, "s", 5, 8.0), (2, 1, None, None, None)]
    aggregates = [line for line in _plan(got).splitlines() if "Aggregate " in line and "percentile" in line]
    assert aggregates and all("min(" not in line for line in aggregates)


def test_merged_state_is_written_as_parts_only(spark, sf):
    w = craft.loaded_warehouse(spark, sf)
    saved = []
    w._save = lambda df, name, save=w._save: (saved.append(name), save(df, name))[1]
    assert w.applied["mart"].count() >= w.run1["mart"].count()
    assert "changed_keys" in saved and "mart_state" not in saved


def test_recorded_sales_are_written_once(spark, sf):
    r = reg.Registry(spark, sf)
    sales = r.sell_state[1]
    assert all("/recorded_sales-" in f for f in sales.inputFiles())
    pre_sold = r.cars.filter("lot % 5 = 0").selectExpr("vin car_vin")
    assert sorted(map(str, sales.collect())) == sorted(map(str, r.sales.join(pre_sold, "car_vin", "left_semi").select(*sales.columns).collect()))
