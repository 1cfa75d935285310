"""Batches judged in order, against sequential brute force; record files."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.operators.batches import Touch, components, final_keys, settle
from martkit.plans import registry as reg
from martkit.session import scratch_path
from martkit.sources.io import RECORD_WIDTH, padded, scan_records


def one_by_one(rows, touches, order, in_use):
    """Brute force: (request, failed, at_start) in any order of equal ones."""
    used = {(space, k) for space, keys in in_use.items() for k in keys}
    start, out = set(used), []
    low = lambda v: (v is not None, v)
    for r in sorted(rows, key=lambda r: [low(r[c]) for c in order]):
        keys = [(t.space, r[t.column]) for t in touches]
        null = next((i for i, k in enumerate(keys) if k[1] is None), None)
        # Where keys are only taken, what fails before the batch is said first.
        taking = all(not t.needs for t in touches)
        before = next((i for i, k in enumerate(keys) if taking and k in start), None)
        now = next((i for i, t in enumerate(touches) if (keys[i] in used) != t.needs), None)
        failed = next((x for x in (null, before, now) if x is not None), None)
        if failed is None:
            for k, t in zip(keys, touches):
                (used.add if t.leaves else used.discard)(k)
        at_start = None if failed is None else null is not None or (keys[failed] in start) != touches[failed].needs
        out.append((*r.values(), failed, at_start))
    return Counter(out)


TAKE = [Touch("a", "x"), Touch("b", "y")]
MOVE = [Touch("a", "x", True, False), Touch("b", "x")]


@pytest.mark.parametrize("touches", [TAKE, MOVE, TAKE[:1]])
@pytest.mark.parametrize("limit", [10**6, 12, 0])
def test_settle_equals_one_by_one(spark, touches, limit):
    """Repeats, nulls, equal order columns, keys that are in use from the
    start; folded at once, by component, and in rounds."""
    for seed, n in ((1, 70), (2, 70)) if limit > 12 else ((3, 26),):
        g = random.Random(seed)
        rows = [{"o": g.choice([None, *range(15)]), "a": g.choice([None, *range(12)]), "b": g.choice([None, *range(12)])} for _ in range(n)]
        rows += rows[: n // 7]
        # Equal order columns must not leave the outcome open.
        order = ["o", "a", "b"]
        in_use = {"x": [0, 3, 5, None], "y": [1, 2]}
        df = spark.createDataFrame([tuple(r.values()) for r in rows], "o int, a int, b int").repartition(3)
        tables = {k: spark.createDataFrame([(v,) for v in vs], "k int") for k, vs in in_use.items()}
        got = settle(df, touches, order, tables, limit).collect()
        assert Counter((r.o, r.a, r.b, r.failed, r.at_start) for r in got) == one_by_one(rows, touches, order, in_use)
        assert len({r._row for r in got}) == len(rows)
    empty = spark.createDataFrame([], "o int, a int, b int")
    assert settle(empty, touches, ["o"], tables, limit).collect() == []


def test_a_long_chain_of_conflicts(spark):
    """Number 1 for cars 1 and 2, car 2 for numbers 1 and 2, and so on: each
    outcome depends on the one before."""
    n = 10_000
    rows = [{"o": i, "a": (i + 1) // 2, "b": i // 2} for i in range(n)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "o int, a int, b int").repartition(4)
    tables = {k: spark.createDataFrame([], "k int") for k in "xy"}
    got = settle(df, TAKE, ["o"], tables, n).collect()
    assert Counter((r.o, r.a, r.b, r.failed, r.at_start) for r in got) == one_by_one(rows, TAKE, ["o"], {})
    edges = spark.range(n - 1).select(F.xxhash64("id").alias("a"), F.xxhash64(F.col("id") + 1).alias("b"))
    labels, rounds = components(edges)
    assert labels.select("label").distinct().count() == 1 and labels.count() == n
    assert rounds <= 2 * 14  # logarithm of 10,000


def test_components_equal_brute_force(spark):
    g = random.Random(3)
    pairs = [(g.randrange(200), g.randrange(200)) for _ in range(120)] + [(7, 7)]
    root = list(range(200))
    for _ in range(200):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint"))[0].collect()
    assert {r.node: r.label for r in got} == {x: root[x] for p in pairs if p[0] != p[1] for x in p}
    assert len(got) == len({r.node for r in got})


def test_final_keys_follow_chains_cycles_and_swaps(spark):
    g, log, used = random.Random(4), [], set(range(20))
    where = {k: k for k in used}
    for row in range(300):
        a, b = g.randrange(40), g.randrange(40)
        if a in used and b not in used:
            log.append((row, a, b))
            used.remove(a)
            used.add(b)
            where = {o: b if k == a else k for o, k in where.items()}
    got, _ = final_keys(spark.createDataFrame(log, "_row bigint, old int, new int").repartition(3))
    moved = {r.key: r.last_key for r in got.collect()}
    assert {o: moved.get(o, o) for o in range(20)} == where and len(moved) <= 20
    chain = spark.range(5000).select(F.col("id").alias("_row"), F.col("id").alias("old"), (F.col("id") + 1).alias("new"))
    got, rounds = final_keys(chain)
    assert [tuple(r) for r in got.collect()] == [(0, 5000)] and rounds <= 14


def _state(spark):
    cars = spark.createDataFrame([("A", reg.AVAILABLE), ("B", reg.AVAILABLE), ("C", reg.SOLD)], "vin string, status string")
    sales = spark.createDataFrame([("S0", "C", dt.date(2020, 1, 1), Decimal("1.00"))], "sales_number string, car_vin string, sales_date date, cost decimal(12,2)")
    return cars, sales


def test_sales_lose_and_double_nothing(spark):
    cars, sales = _state(spark)
    day = lambda n: dt.date(2021, 1, n)
    rows = [("S0", "A", day(1)), ("S2", "A", day(2)), ("S2", "A", day(2)), ("S3", "A", day(3)), ("S2", "B", day(4)), ("S5", "C", day(1)),
            ("S6", "D", day(1)), (None, "B", day(1)), ("S7", None, day(1)), ("S8", "B", None)]
    out = reg.sell(cars, sales, spark.createDataFrame([(*r, Decimal("2.00")) for r in rows], sales.schema))
    assert Counter((r.sales_number, r.car_vin, r.reason) for r in out.collect()) == Counter([
        ("S0", "A", "duplicate sale number"), ("S2", "A", None), ("S2", "A", "car sold in batch"), ("S3", "A", "car sold in batch"),
        ("S2", "B", "car sold in batch"), ("S5", "C", "car already sold"), ("S6", "D", "unknown car"), (None, "B", "no sale number"),
        ("S7", None, "no car"), ("S8", "B", None)])
    new_cars, new_sales = reg.apply_sales(cars, sales, out)
    assert sorted((r.vin, r.status) for r in new_cars.collect()) == [("A", reg.SOLD), ("B", reg.SOLD), ("C", reg.SOLD)]
    assert sorted(r.sales_number for r in new_sales.collect()) == ["S0", "S2", "S8"]


def test_inserts_lose_and_double_nothing(spark):
    table = spark.createDataFrame([("A",), (None,)], "k string")
    rows = [("A", 1), ("B", 2), ("B", 2), ("B", 1), (None, 1), (None, 1)]
    out = reg.insert_keyed(table, spark.createDataFrame(rows, "k string, p int"), "k", ["p"])
    assert Counter((r.k, r.p, r.outcome, r.reason) for r in out.collect()) == Counter([
        ("A", 1, "rejected", "key exists"), ("B", 1, "accepted", None), ("B", 2, "rejected", "duplicate key in batch"),
        ("B", 2, "rejected", "duplicate key in batch"), (None, 1, "rejected", "no key"), (None, 1, "rejected", "no key")])


def test_renames_follow_chains_and_double_nothing(spark):
    cars, sales = _state(spark)
    rows = [(1, "0none", "N"), (2, "A", "N"), (2, "A", "N"), (3, "N", "M"), (4, "B", "A"), (5, "M", "B"), (6, "C", "A"), (7, "C", None), (8, None, "Q"), (9, "C", "C")]
    out = reg.rename(cars, spark.createDataFrame(rows, "n int, vin string, new_vin string"), ["n"])
    assert Counter((r.n, r.reason) for r in out.collect()) == Counter([
        (1, "unknown key"), (2, None), (2, "unknown key"), (3, None), (4, None), (5, None), (6, "new key exists"), (7, "no new key"),
        (8, "no key"), (9, "new key exists")])
    # A went over N and M to B, B to A: a swap.
    new_cars, new_sales = reg.apply_renames(cars.withColumn("was", F.col("vin")), sales, out)
    assert sorted((r.was, r.vin) for r in new_cars.collect()) == [("A", "B"), ("B", "A"), ("C", "C")] and new_sales.first().car_vin == "C"


def test_every_reject_reason_is_in_the_fixture(spark, sf):
    r = reg.Registry(spark, sf)
    assert {x.reason for x in r.sell().select("reason").distinct().collect()} == {
        None, "no car", "unknown car", "car already sold", "car sold in batch", "no sale number", "duplicate sale number", "number taken in batch"}
    assert {x.reason for x in r.rename().select("reason").distinct().collect()} == {None, "no key", "unknown key", "no new key", "new key exists"}
    assert r.sell().count() == r.sell_requests.count() and r.rename().count() == r.rename_requests.count()


def test_long_records_survive_and_damaged_ones_fail(spark):
    schema = T.StructType([T.StructField("vin", T.StringType())])
    path = scratch_path(spark, "records")
    df = spark.createDataFrame([("x" * 600,), ("y",)], "vin string").select(padded(F.to_json(F.struct("vin"))).alias("value"))
    assert sorted(len(r.value) for r in df.collect()) == [RECORD_WIDTH, 610]
    df.write.text(path)
    assert sorted(r.vin for r in scan_records(spark, path, schema).collect()) == ["x" * 600, "y"]
    spark.createDataFrame([('{"vin": "z',)], "value string").write.mode("append").text(path)
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_records(spark, path, schema).collect()


def test_a_table_tells_used_free_and_unknown_keys(spark):
    """A key that the table lacks is unknown; a request comes once for each row
    that the table has of its key."""
    table = spark.createDataFrame([("A", True), ("B", False), ("B", None), ("C", False), (None, True)], "k string, used boolean")
    rows = [(1, "A", "n1"), (2, "B", "n2"), (3, "Z", "n3"), (4, None, "n3"), (5, "C", "n3")]
    df = spark.createDataFrame(rows, "o int, a string, b string")
    for limit in (100, 0):
        got = settle(df, TAKE, ["o"], {"x": table, "y": spark.createDataFrame([], "k string")}, limit).collect()
        assert Counter((r.o, r.failed, r.at_start) for r in got) == Counter(
            [(1, 0, True), (2, None, None), (2, 0, False), (3, 0, None), (4, 0, True), (5, None, None)])
        assert len({r._row for r in got}) == 6


@pytest.mark.parametrize("limit", [10**6, 3, 0])
def test_numbers_grow_among_requests_that_share_keys(spark, limit):
    df = spark.range(200).selectExpr("cast(id * 37 % 200 as int) o", "cast(id % 20 as int) a", "cast(id as int) b").repartition(5)
    got = settle(df, TAKE, ["o"], {k: spark.createDataFrame([], "k int") for k in "xy"}, limit).collect()
    for key in range(20):
        mine = sorted((r for r in got if r.a == key), key=lambda r: r.o)
        assert [r._row for r in mine] == sorted(r._row for r in mine)
        assert [r.failed for r in mine] == [None] + [0] * (len(mine) - 1)


def test_components_of_any_numbering(spark):
    """A path whose nodes are numbered along it takes no more rounds than
    one of random numbers."""
    path = spark.range(3000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    labels, rounds = components(path)
    assert labels.filter("label <> 0").isEmpty() and labels.count() == 3001
    assert rounds <= 2 * 12


def test_rename_requests_pass_once_over_the_cars(spark, sf):
    plan = reg.Registry(spark, sf).rename_requests._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
