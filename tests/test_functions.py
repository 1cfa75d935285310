"""Parsers and exact arithmetic on hand-made cases."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martkit.functions import jsonops as js
from martkit.functions import text as tx
from martkit.functions.numeric import avg_cents, cents, cents_to_decimal, div_round, int_div

NAMES = [
    ("Mr. John Smith Jr.", "Mr.", "John", "Smith"),
    ("Dr. Ann Lee", "Dr.", "Ann", "Lee"),
    ("Kara Jones DVM", "DVM", "Kara", "Jones"),
    ("John Smith MD", None, "John", "Smith"),  # MD is a prefix title only
    ("Missy Elliot", None, "Missy", "Elliot"),  # a title needs a space after it
    ("John Smith III", None, "John", "Smith"),
    ("Mary Ann Smith Jr.", "Jr.", "Mary", "Smith"),  # before a closing title: the last word
    ("Mary Ann Smith", None, "Mary", "Ann"),
    ("Mrs.  Eve   Ray II", "Mrs.", "Eve", "Ray"),
    ("Conan O'Brien", None, "Conan", "O'Brien"),
    ("Mr. Bean", "Mr.", "Bean", "Bean"),
    ("DVM", None, "DVM", "DVM"),  # a title alone is a name
    ("Cher", None, "Cher", "Cher"),  # no second word: the name is kept whole
]


def test_person_parser(spark):
    df = spark.createDataFrame([(n,) for n, *_ in NAMES] + [(None,)], "n string")
    got = df.select("n", tx.person_title("n").alias("t"), tx.first_name("n").alias("f"),
                    tx.last_name("n").alias("l")).collect()
    by = {r.n: (r.t, r.f, r.l) for r in got}
    for n, t, f, last in NAMES:
        assert by[n] == (t, f, last), n
    assert by[None] == (None, None, None)


def test_person_parser_oracle_agrees():
    import duckdb

    for n, t, f, last in NAMES:
        name = "'" + n.replace("'", "''") + "'"
        got = duckdb.connect().execute(f"SELECT {tx.sql_person_title(name)}, {tx.sql_first_name(name)}, {tx.sql_last_name(name)}").fetchone()
        assert got == (t, f, last), n


def test_car_parser(spark):
    df = spark.createDataFrame(
        [("Tesla Model 3, red",), ("Hyundai Elantra GT, blue",), ("BMW, ",), ("Lada",)], "a string")
    got = df.select("a", tx.car_brand("a").alias("b"), tx.car_model("a").alias("m"),
                    tx.car_color("a").alias("c")).collect()
    by = {r.a: (r.b, r.m, r.c) for r in got}
    assert by["Tesla Model 3, red"] == ("Tesla", "Model 3", "red")
    assert by["Hyundai Elantra GT, blue"] == ("Hyundai", "Elantra GT", "blue")
    assert by["BMW, "] == ("BMW,", "BMW", "")
    assert by["Lada"] == ("Lada", "Lada", "")


def test_div_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 2), (4, 0), (None, 3), (1, 3)], "n long, d long")
    got = [r.q for r in df.select(div_round("n", "d").alias("q")).collect()]
    assert got == [3, -3, 4, None, None, 0]
    assert spark.range(1).select(int_div(F.lit(7), F.lit(2))).first()[0] == 3


def test_exact_average_of_halves(spark):
    # 0.125 average of cents (12.5 cents) rounds up to 0.13, as PostgreSQL does.
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.15"),)], "x decimal(6,2)")
    r = df.agg(F.sum(cents("x")).alias("c"), F.count(F.lit(1)).alias("n")).select(
        cents_to_decimal(avg_cents("c", "n"), 10).alias("a")).first()
    assert r.a == Decimal("0.13")


def test_json_operators(spark):
    menus = [
        ("a", '{"Пицца": {"Маргарита": 300, "Пепперони": 400}, "Кофе": {"Латте": 210}}'),
        ("b", '{"Салат": {}}'),
        ("c", None),
    ]
    df = spark.createDataFrame(menus, "v string, menu string")
    keys = {r.v: r.k for r in df.select("v", js.has_key("menu", "Пицца").alias("k")).collect()}
    assert keys == {"a": True, "b": False, "c": None}
    piz = df.select("v", js.member("menu", "Пицца").alias("p"))
    rows = js.each_text(piz, "p", "item", "price").collect()
    assert sorted((r.item, r.price) for r in rows) == [("Маргарита", "300"), ("Пепперони", "400")]
    nested = js.nest(js.each_text(piz, "p", "item", "price"), ["v"], "item", "price", "json").first()
    assert nested.json == '{"Маргарита":"300","Пепперони":"400"}'


def test_menu_renests_with_numeric_prices(spark):
    from decimal import Decimal as D

    from martkit.plans.venues import menu_json

    rows = spark.createDataFrame(
        [("a", "Кофе", "Капучино", D("240.00")), ("a", "Кофе", "Латте", D("210.00")), ("a", "Салат", "Цезарь", D("350.00"))],
        "restaurant_name string, section string, item string, price decimal(10,2)")
    import json

    doc = json.loads(menu_json(rows).first().menu)
    assert doc == {"Кофе": {"Капучино": 240.0, "Латте": 210.0}, "Салат": {"Цезарь": 350.0}}


def test_iso_week_across_year_end(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 12, 31),), (dt.datetime(2021, 1, 1),)], "t timestamp_ntz")
    got = df.select(F.expr("extract(YEAROFWEEK FROM t)").alias("y"), F.weekofyear("t").alias("w")).collect()
    assert [(r.y, r.w) for r in got] == [(2020, 53), (2020, 53)]
