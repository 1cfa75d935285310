"""Restaurant network: venues typed from their JSON menus, managers and
their tenure, daily average checks, and the analytic tasks on top.

Fixes applied on purpose: managers are matched on (name, phone), the
previous-year check is taken per venue key, every ranking has a total order
(ties broken by name), "number of manager changes" is reported as the number
of distinct managers under the name ``manager_count``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import jsonops as js
from ..functions.numeric import avg_cents, cents, cents_to_decimal, div_round, typed
from ..operators.keys import dense_keys, hash_key
from ..operators.merge import update_from, write_version
from ..operators.ranks import with_ranks
from ..session import scratch_path
from ..sources import fixtures as fx

# The venue type enumeration in its declaration order (which
# is also its sort order), and the menu sections that decide a venue's type,
# tested in this order; a venue with none of them is a bar.
VENUE_TYPES = ["coffee_shop", "restaurant", "bar", "pizzeria"]
TYPE_BY_SECTION = [("Пицца", "pizzeria"), ("Кофе", "coffee_shop"), ("Салат", "restaurant")]
DEFAULT_TYPE = "bar"
PIZZA = "Пицца"
COFFEE = "Кофе"
CAPPUCCINO = "Капучино"
PRICE_FACTOR = "1.2"
PHONE_PREFIX = "8-800-2500-"
PHONE_NUMBER_OFFSET = 99
TOP_K = 3
MENU_KEYS = ["restaurant_name", "section", "item"]
# The year left out of the year-over-year view: the reference drops its
# current, incomplete year; 2001 is the incomplete last year of the data.
EXCLUDED_YEAR = 2001


def venue_type(menu: str = "menu"):
    expr = None
    for section, kind in TYPE_BY_SECTION:
        cond = js.has_key(menu, section)
        expr = F.when(cond, kind) if expr is None else expr.when(cond, kind)
    return expr.otherwise(DEFAULT_TYPE)


def type_ordinal(col: str = "restaurant_type"):
    return F.array_position(F.array(*[F.lit(t) for t in VENUE_TYPES]), F.col(col))


class Network:
    def __init__(self, spark: SparkSession, d: str):
        self.menu = fx.raw_menu(spark, d)
        self.sales_raw = fx.raw_cafe_sales(spark, d)

    @cached_property
    def restaurants(self) -> DataFrame:
        r = self.menu.select(F.col("cafe_name").alias("name"), venue_type().alias("restaurant_type"), "menu")
        return dense_keys(r, ["name"], "restaurant_id").select("restaurant_id", "name", "restaurant_type", "menu")

    @cached_property
    def managers(self) -> DataFrame:
        m = self.sales_raw.select(F.col("manager").alias("name"), F.col("manager_phone").alias("phone")).distinct()
        return dense_keys(m, ["name", "phone"], "manager_id").select("manager_id", "name", "phone")

    @cached_property
    def tenure(self) -> DataFrame:
        # Reduce the daily rows to one per (venue, manager) before any join.
        spans = self.sales_raw.groupBy("cafe_name", "manager", "manager_phone").agg(
            F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day")
        )
        r = self.restaurants.select("restaurant_id", F.col("name").alias("cafe_name"))
        m = self.managers.select("manager_id", F.col("name").alias("manager"), F.col("phone").alias("manager_phone"))
        j = spans.join(r, "cafe_name").join(m, ["manager", "manager_phone"])
        return j.groupBy("restaurant_id", "manager_id").agg(
            F.date_sub(F.min("first_day"), 1).alias("hired"), F.max("last_day").alias("fired")
        )

    @cached_property
    def sales(self) -> DataFrame:
        r = self.restaurants.select("restaurant_id", F.col("name").alias("cafe_name"))
        return self.sales_raw.join(r, "cafe_name").select(
            F.col("report_date").alias("date"), "restaurant_id", "avg_check"
        )


def top_venues_by_type(n: Network, k: int = TOP_K) -> DataFrame:
    """Top ``k`` venues by average check per type.  Spark plans the
    ``row_number() <= k`` filter as a partial window group limit, so each map
    task ships at most ``k`` rows per type."""
    avg = n.sales.groupBy("restaurant_id").agg(F.sum(cents("avg_check")).alias("c"), F.count(F.lit(1)).alias("n"))
    v = avg.join(n.restaurants, "restaurant_id").select(
        F.col("name").alias("restaurant_name"), "restaurant_type", avg_cents("c", "n").alias("avg_c")
    )
    w = Window.partitionBy("restaurant_type").orderBy(F.desc("avg_c"), "restaurant_name")
    top = v.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.orderBy(type_ordinal(), F.desc("avg_c"), "restaurant_name").select(
        "restaurant_name", "restaurant_type", cents_to_decimal("avg_c", 12).alias("average_check")
    )


def yoy_avg_check_change(spark: SparkSession, n: Network, excluded_year: int = EXCLUDED_YEAR) -> DataFrame:
    """Yearly average check per venue, the previous available year's value
    and the change in percent; stored as a snapshot (materialized view)."""
    yearly = (
        n.sales.filter((F.col("date") < F.lit(f"{excluded_year}-01-01").cast("date")) | (F.col("date") > F.lit(f"{excluded_year}-12-31").cast("date")))
        .groupBy(F.year("date").alias("year"), "restaurant_id")
        .agg(F.sum(cents("avg_check")).alias("c"), F.count(F.lit(1)).alias("n"))
        .select("year", "restaurant_id", avg_cents("c", "n").alias("cur_c"))
    )
    w = Window.partitionBy("restaurant_id").orderBy("year")
    lagged = yearly.withColumn("prev_c", F.lag("cur_c").over(w))
    out = lagged.join(n.restaurants, "restaurant_id").select(
        F.col("year").cast("int").alias("year"),
        F.col("name").alias("restaurant_name"),
        "restaurant_type",
        cents_to_decimal("cur_c", 12).alias("current_year_avg_check"),
        cents_to_decimal("prev_c", 12).alias("previous_year_avg_check"),
        cents_to_decimal(div_round((F.col("cur_c") - F.col("prev_c")) * 10000, "prev_c"), 12).alias("change_pct"),
    )
    return write_version(out, scratch_path(spark, "yoy_avg_check_changes"))


def manager_churn_top(n: Network, k: int = TOP_K) -> DataFrame:
    cnt = n.tenure.groupBy("restaurant_id").agg(F.count_distinct("manager_id").alias("manager_count"))
    j = cnt.join(n.restaurants, "restaurant_id").select(F.col("name").alias("restaurant_name"), "manager_count")
    return j.orderBy(F.desc("manager_count"), "restaurant_name").limit(k)


def pizza_items(n: Network) -> DataFrame:
    piz = n.restaurants.filter(F.col("restaurant_type") == "pizzeria").select(
        F.col("name").alias("restaurant_name"), js.member("menu", PIZZA).alias("pizza")
    )
    return js.each_text(piz, "pizza", "pizza_name", "price_text").select(
        "restaurant_name", "pizza_name", "price_text"
    )


def menu_ranks(n: Network) -> DataFrame:
    """Every pizzeria's place by its number of pizzas, with and without gaps
    after ties."""
    counts = pizza_items(n).groupBy("restaurant_name").agg(F.count_distinct("pizza_name").alias("pizza_count"))
    return with_ranks(counts, ["pizza_count"], True, "menu_rank", "menu_dense_rank")


def largest_menu_with_ties(n: Network) -> DataFrame:
    """Pizzerias with the most pizzas, all of them when several tie.  Joined
    to the global maximum (an equi-join on a one-row aggregate) instead of a
    dense rank over one partition."""
    counts = pizza_items(n).groupBy("restaurant_name").agg(F.count_distinct("pizza_name").alias("pizza_count"))
    top = counts.agg(F.max("pizza_count").alias("pizza_count"))
    return counts.join(F.broadcast(top), "pizza_count").select("restaurant_name", "pizza_count")


def priciest_item_per_venue(n: Network, lenient: bool = False) -> DataFrame:
    """Most expensive pizza per pizzeria (ties: first name), as a min over a
    struct (map-side partial aggregation, no per-venue sort).  A price that is
    no number fails the query; if ``lenient``, that item is left out."""
    items = pizza_items(n).select("restaurant_name", "pizza_name", typed("price_text", "int", lenient).alias("price"))
    items = items.filter("price IS NOT NULL")
    best = items.groupBy("restaurant_name").agg(F.min(F.struct(-F.col("price"), F.col("pizza_name"))).alias("b"))
    return best.select(
        "restaurant_name", F.lit(PIZZA).alias("dish_type"),
        F.col("b.pizza_name").alias("pizza_name"), (-F.col("b.col1")).cast("int").alias("price"),
    )


def menu_rows(n: Network) -> DataFrame:
    """Menus as rows (restaurant, section, item, price)."""
    r = n.restaurants.select(F.col("name").alias("restaurant_name"), "restaurant_type", "menu")
    sections = js.each_text(r, "menu", "section", "items")
    return js.each_text(sections, "items", "item", "price_text").select(
        "restaurant_name", "restaurant_type", "section", "item",
        F.col("price_text").cast("decimal(10,2)").alias("price"),
    )


def menu_price_update(n: Network) -> DataFrame:
    """+20 % on the cappuccino of every coffee shop that sells one, as
    ``UPDATE … FROM`` the updated items; the new menu state as rows
    (``menu_json`` re-nests them at the sink)."""
    rows = menu_rows(n)
    hit = (F.col("restaurant_type") == "coffee_shop") & (F.col("section") == COFFEE) & (F.col("item") == CAPPUCCINO)
    updates = rows.filter(hit).select(
        *MENU_KEYS, (F.col("price") * F.lit(PRICE_FACTOR).cast("decimal(2,1)")).cast("decimal(10,2)").alias("price")
    )
    return update_from(rows.select(*MENU_KEYS, "price"), updates, MENU_KEYS, ["price"])


def menu_json(rows: DataFrame) -> DataFrame:
    """Menu rows -> one JSON document per venue, sections and items by name,
    prices as JSON numbers."""
    items = F.map_from_entries(F.array_sort(F.collect_list(F.struct("item", "price"))))
    sections = rows.groupBy("restaurant_name", "section").agg(items.alias("items"))

    def by_name(a: Column, b: Column) -> Column:
        return F.when(a["section"] < b["section"], -1).when(a["section"] > b["section"], 1).otherwise(0)

    entries = F.array_sort(F.collect_list(F.struct("section", "items")), by_name)
    return sections.groupBy("restaurant_name").agg(F.to_json(F.map_from_entries(entries)).alias("menu"))


def menu_documents(n: Network) -> DataFrame:
    """The menus after the price update, as JSON documents again."""
    return menu_json(menu_price_update(n))


def venue_hash_keys(n: Network) -> DataFrame:
    """A key that follows from the natural key alone: the same in every run
    and on every machine, with no lookup (in place of random identifiers)."""
    return n.restaurants.select("name", hash_key("name", "restaurant_type").alias("venue_key"))


def manager_phone_array(n: Network) -> DataFrame:
    """Add ``phone_numbers``, set it to ``[generated, old]`` with
    ``UPDATE … FROM`` the numbered managers, drop ``phone``.  The generated
    number follows the managers' name order (ties by phone), keyed without
    a global window."""
    numbered = dense_keys(n.managers, ["name", "phone"], "manager_number", start=PHONE_NUMBER_OFFSET + 1)
    generated = numbered.select(
        "manager_id",
        F.array(F.concat_ws("", F.lit(PHONE_PREFIX), F.col("manager_number").cast("string")), F.col("phone")).alias(
            "phone_numbers"),
    )
    with_col = n.managers.withColumn("phone_numbers", F.lit(None).cast("array<string>"))
    return update_from(with_col, generated, ["manager_id"], ["phone_numbers"]).drop("phone")


QUERIES = {
    "venue_classify_menu": lambda sp, d: Network(sp, d).restaurants,
    "manager_dim": lambda sp, d: Network(sp, d).managers,
    "manager_tenure": lambda sp, d: Network(sp, d).tenure,
    "venue_sales_load": lambda sp, d: Network(sp, d).sales,
    "top3_venues_by_type": lambda sp, d: top_venues_by_type(Network(sp, d)),
    "yoy_avg_check_change": lambda sp, d: yoy_avg_check_change(sp, Network(sp, d)),
    "manager_churn_top3": lambda sp, d: manager_churn_top(Network(sp, d)),
    "largest_menu_with_ties": lambda sp, d: largest_menu_with_ties(Network(sp, d)),
    "priciest_item_per_venue": lambda sp, d: priciest_item_per_venue(Network(sp, d)),
    "menu_price_update": lambda sp, d: menu_price_update(Network(sp, d)),
    "menu_documents": lambda sp, d: menu_documents(Network(sp, d)),
    "menu_ranks": lambda sp, d: menu_ranks(Network(sp, d)),
    "venue_hash_keys": lambda sp, d: venue_hash_keys(Network(sp, d)),
    "manager_phone_array": lambda sp, d: manager_phone_array(Network(sp, d)),
}

# ---------------------------------------------------------------- oracle


def _has(j: str, k: str) -> str:
    return f"list_contains(json_keys({j}), '{k}')"


_TYPE = (
    "CASE "
    + " ".join(f"WHEN {_has('menu', s)} THEN '{t}'" for s, t in TYPE_BY_SECTION)
    + f" ELSE '{DEFAULT_TYPE}' END"
)
_CTES = fx.duck_with("raw_menu", "raw_cafe_sales") + f""",
restaurants AS (SELECT CAST(row_number() OVER (ORDER BY cafe_name) AS BIGINT) AS restaurant_id, cafe_name AS name,
    {_TYPE} AS restaurant_type, menu FROM raw_menu),
managers AS (SELECT CAST(row_number() OVER (ORDER BY name, phone) AS BIGINT) AS manager_id, name, phone
    FROM (SELECT DISTINCT manager AS name, manager_phone AS phone FROM raw_cafe_sales)),
tenure AS (SELECT r.restaurant_id, m.manager_id, CAST(min(s.report_date) - INTERVAL 1 DAY AS DATE) AS hired,
    max(s.report_date) AS fired
    FROM raw_cafe_sales s JOIN restaurants r ON r.name = s.cafe_name
    JOIN managers m ON m.name = s.manager AND m.phone = s.manager_phone GROUP BY 1, 2),
sales AS (SELECT s.report_date AS date, r.restaurant_id, s.avg_check FROM raw_cafe_sales s JOIN restaurants r ON s.cafe_name = r.name),
pizza AS (SELECT r.name AS restaurant_name, json_extract(r.menu, '$."{PIZZA}"') AS p FROM restaurants r WHERE restaurant_type = 'pizzeria'),
pizza_items AS (SELECT restaurant_name, k AS pizza_name, json_extract_string(p, '$."' || k || '"') AS price_text
    FROM (SELECT restaurant_name, p, unnest(json_keys(p)) AS k FROM pizza))
"""
_AVGC = "CASE WHEN sum(CAST(round(avg_check * 100) AS BIGINT)) >= 0 THEN (2 * sum(CAST(round(avg_check * 100) AS BIGINT)) + count(*)) // (2 * count(*)) END"


def _dec(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,0)) / 100 AS DECIMAL(12,2))"


_MENU = f""", s AS (SELECT name AS restaurant_name, restaurant_type, sec, json_extract(menu, '$."' || sec || '"') AS items
    FROM (SELECT *, unnest(json_keys(menu)) AS sec FROM restaurants)),
i AS (SELECT restaurant_name, restaurant_type, sec AS section, it AS item,
    CAST(json_extract_string(items, '$."' || it || '"') AS DECIMAL(10,2)) AS price
    FROM (SELECT *, unnest(json_keys(items)) AS it FROM s)),
priced AS (SELECT restaurant_name, section, item,
  CASE WHEN restaurant_type = 'coffee_shop' AND section = '{COFFEE}' AND item = '{CAPPUCCINO}'
       THEN CAST(price * {PRICE_FACTOR} AS DECIMAL(10,2)) ELSE price END AS price FROM i)
"""

ORACLE = {
    "venue_classify_menu": _CTES + "SELECT * FROM restaurants",
    "manager_dim": _CTES + "SELECT * FROM managers",
    "manager_tenure": _CTES + "SELECT * FROM tenure",
    "venue_sales_load": _CTES + "SELECT * FROM sales",
    "top3_venues_by_type": _CTES
    + f""", a AS (SELECT r.name AS restaurant_name, r.restaurant_type, {_AVGC} AS avg_c
    FROM sales s JOIN restaurants r USING (restaurant_id) GROUP BY r.restaurant_id, r.name, r.restaurant_type),
ranked AS (SELECT *, row_number() OVER (PARTITION BY restaurant_type ORDER BY avg_c DESC, restaurant_name) AS rk FROM a)
SELECT restaurant_name, restaurant_type, {_dec('avg_c')} AS average_check FROM ranked WHERE rk <= {TOP_K}""",
    "yoy_avg_check_change": _CTES
    + f""", y AS (SELECT CAST(extract(year FROM date) AS INTEGER) AS year, restaurant_id, {_AVGC} AS cur_c
    FROM sales WHERE extract(year FROM date) != {EXCLUDED_YEAR} GROUP BY 1, 2),
l AS (SELECT *, lag(cur_c) OVER (PARTITION BY restaurant_id ORDER BY year) AS prev_c FROM y)
SELECT l.year, r.name AS restaurant_name, r.restaurant_type, {_dec('cur_c')} AS current_year_avg_check,
  {_dec('prev_c')} AS previous_year_avg_check,
  {_dec("CASE WHEN prev_c IS NULL OR prev_c = 0 THEN NULL ELSE sign(cur_c - prev_c) * ((2 * abs(cur_c - prev_c) * 10000 + prev_c) // (2 * prev_c)) END")} AS change_pct
FROM l JOIN restaurants r USING (restaurant_id)""",
    "manager_churn_top3": _CTES
    + f"""SELECT r.name AS restaurant_name, count(DISTINCT t.manager_id) AS manager_count
FROM tenure t JOIN restaurants r USING (restaurant_id) GROUP BY r.restaurant_id, r.name
ORDER BY manager_count DESC, restaurant_name LIMIT {TOP_K}""",
    "menu_ranks": _CTES
    + """, c AS (SELECT restaurant_name, count(DISTINCT pizza_name) AS pizza_count FROM pizza_items GROUP BY 1)
SELECT *, rank() OVER (ORDER BY pizza_count DESC) AS menu_rank, dense_rank() OVER (ORDER BY pizza_count DESC) AS menu_dense_rank FROM c""",
    "largest_menu_with_ties": _CTES
    + """, c AS (SELECT restaurant_name, count(DISTINCT pizza_name) AS pizza_count FROM pizza_items GROUP BY 1)
SELECT restaurant_name, pizza_count FROM c WHERE pizza_count = (SELECT max(pizza_count) FROM c)""",
    "priciest_item_per_venue": _CTES
    + f""", i AS (SELECT restaurant_name, pizza_name, CAST(price_text AS INTEGER) AS price,
    row_number() OVER (PARTITION BY restaurant_name ORDER BY CAST(price_text AS INTEGER) DESC, pizza_name) AS rk FROM pizza_items)
SELECT restaurant_name, '{PIZZA}' AS dish_type, pizza_name, price FROM i WHERE rk = 1""",
    "menu_price_update": _CTES + _MENU + "SELECT * FROM priced",
    "menu_documents": _CTES + _MENU
    + """, sec AS (SELECT restaurant_name, section, string_agg('"' || item || '":' || price, ',' ORDER BY item) AS items
  FROM priced GROUP BY ALL)
SELECT restaurant_name, '{' || string_agg('"' || section || '":{' || items || '}', ',' ORDER BY section) || '}' AS menu
FROM sec GROUP BY restaurant_name""",
    "venue_hash_keys": _CTES + "SELECT name, sha256(length(name) || ':' || name || length(restaurant_type) || ':' || restaurant_type) AS venue_key FROM restaurants",
    "manager_phone_array": _CTES
    + f"""SELECT manager_id, name,
  ['{PHONE_PREFIX}' || CAST(row_number() OVER (ORDER BY name, phone) + {PHONE_NUMBER_OFFSET} AS VARCHAR), phone] AS phone_numbers
FROM managers""",
}
