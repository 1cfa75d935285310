"""Car registry (cars, models, sales) kept in fixed-width JSON record files,
with its keyed operations re-aimed as set-oriented batch operators.

The reference changes one record at a time through an index; here a batch
of requests is validated against the table with joins and each request
gets an outcome and a reason.  Only accepted requests change state, and all
checks run before any change (a rejected sale leaves the car untouched).

A batch gives what the same requests give one after the other in a stated
order (``operators/batches.settle``): a car is sold once and a sale number used
once, an equal request is a request of its own, a request without a key is
rejected, and a rename sees the keys as the renames before it left them, so
chains, swaps and cycles are followed.  Every batch operator returns one
outcome per request and the new state of the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.batches import Touch, final_keys, settle
from ..operators.merge import write_version
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.io import RECORD_WIDTH, TEXT_CODEC, TOMBSTONE, padded, scan_records

# Car states.
AVAILABLE, SOLD = "available", "sold"
TOP_MODELS = 3
ISO_TS = "yyyy-MM-dd'T'HH:mm:ss"

#: The fixtures' conflicts stay in blocks of this many cars; so many open a chain.
BLOCK, CHAIN = 200, 20

CAR_SCHEMA = T.StructType([
    T.StructField("vin", T.StringType()), T.StructField("model", T.LongType()),
    T.StructField("price", T.StringType()), T.StructField("date_start", T.StringType()),
    T.StructField("status", T.StringType()),
])
SALE_SCHEMA = T.StructType([
    T.StructField("sales_number", T.StringType()), T.StructField("car_vin", T.StringType()),
    T.StructField("sales_date", T.StringType()), T.StructField("cost", T.StringType()),
])


def _block() -> Column:
    return F.floor((F.col("car_no") - 1) / BLOCK)


def _vin_of(car_no: Column) -> Column:
    return F.concat(F.lit("VIN"), F.lpad(car_no.cast("string"), 10, "0"))


def car_record(df: DataFrame) -> Column:
    """Decimal -> string, timestamp -> ISO text, enum -> its value."""
    return F.to_json(F.struct(
        "vin", "model", F.col("price").cast("string").alias("price"),
        F.date_format("date_start", ISO_TS).alias("date_start"), "status",
    ))


def sale_record() -> Column:
    return F.to_json(F.struct(
        "sales_number", "car_vin", F.date_format("sales_date", "yyyy-MM-dd").alias("sales_date"),
        F.col("cost").cast("string").alias("cost"),
    ))


def typed_cars(raw: DataFrame) -> DataFrame:
    return raw.select(
        "vin", "model", F.col("price").cast("decimal(10,2)").alias("price"),
        F.to_timestamp_ntz("date_start").alias("date_start"), "status",
    )


def typed_sales(raw: DataFrame) -> DataFrame:
    return raw.select(
        "sales_number", "car_vin", F.col("sales_date").cast("date").alias("sales_date"),
        F.col("cost").cast("decimal(12,2)").alias("cost"),
    )


def revert_sales(cars: DataFrame, sales: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Revert sales by number: (outcomes, new cars, new sales).  A known sale
    is deleted and its car becomes available again; an unknown number is
    rejected and changes nothing."""
    known = sales.select("sales_number", "car_vin", F.lit(True).alias("_known"))
    j = requests.select("sales_number").distinct().join(known, "sales_number", "left")
    reason = F.when(F.col("_known").isNull(), "unknown sale")
    outcomes = j.select("sales_number", F.when(reason.isNull(), "reverted").otherwise("rejected").alias("outcome"),
                        reason.alias("reason"))
    gone = j.filter(F.col("_known").isNotNull()).select("sales_number", "car_vin")
    new_sales = sales.join(gone.select("sales_number"), "sales_number", "left_anti").select(*sales.columns)
    freed = gone.select(F.col("car_vin").alias("vin"), F.lit(True).alias("_freed")).distinct()
    new_cars = (
        cars.join(freed, "vin", "left")
        .withColumn("status", F.when(F.col("_freed").isNotNull(), AVAILABLE).otherwise(F.col("status")))
        .select(*cars.columns)
    )
    return outcomes, new_cars, new_sales


def _judged(settled: DataFrame, reasons: list[Column]) -> DataFrame:
    """Settled requests with ``outcome`` and ``reason`` (one per touch)."""
    reason = F.coalesce(*[F.when(F.col("failed") == i, r) for i, r in enumerate(reasons)])
    return settled.withColumn("reason", reason).withColumn("outcome", F.when(F.col("failed").isNull(), "accepted").otherwise("rejected"))


def insert_keyed(table: DataFrame, requests: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Requests with the outcome of inserting them by ``key`` in ``order``."""
    settled = settle(requests, [Touch(key, "key")], order, {"key": table.select(key)})
    reason = F.when(F.col(key).isNull(), "no key").when(F.col("at_start"), "key exists").otherwise("duplicate key in batch")
    return _judged(settled, [reason])


SELL_ORDER = ["sales_date", "sales_number", "car_vin"]


def sell(cars: DataFrame, sales: DataFrame, requests: DataFrame) -> DataFrame:
    """Outcomes of selling cars, requests taken by date, number and car."""
    settled = settle(
        requests, [Touch("car_vin", "car"), Touch("sales_number", "number")], SELL_ORDER,
        {"car": cars.select("vin", (F.col("status") == SOLD).alias("used")), "number": sales.select("sales_number")},
    )
    car = (
        F.when(F.col("car_vin").isNull(), "no car").when(F.col("at_start").isNull(), "unknown car")
        .when(F.col("at_start"), "car already sold").otherwise("car sold in batch")
    )
    number = (
        F.when(F.col("sales_number").isNull(), "no sale number").when(F.col("at_start"), "duplicate sale number")
        .otherwise("number taken in batch")
    )
    return _judged(settled, [car, number])


def apply_sales(cars: DataFrame, sales: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New (cars, sales): accepted sales enter the sales table and mark
    their car sold; rejected requests change nothing."""
    won = outcomes.filter("outcome = 'accepted'")
    new_sales = sales.unionByName(won.select(*sales.columns))
    sold = won.select(F.col("car_vin").alias("vin"), F.lit(True).alias("_sold"))
    new_cars = cars.join(sold, "vin", "left").withColumn(
        "status", F.when(F.col("_sold").isNotNull(), SOLD).otherwise(F.col("status"))).select(*cars.columns)
    return new_cars, new_sales


def rename(cars: DataFrame, requests: DataFrame, order: list[str]) -> DataFrame:
    """Outcomes of renaming keys, requests taken in ``order``."""
    settled = settle(requests, [Touch("vin", "vin", True, False), Touch("new_vin", "vin")], order, {"vin": cars.select("vin")})
    old = F.when(F.col("vin").isNull(), "no key").otherwise("unknown key")
    return _judged(settled, [old, F.when(F.col("new_vin").isNull(), "no new key").otherwise("new key exists")])


def apply_renames(cars: DataFrame, sales: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New (cars, sales): a car stands under the last key of its chain of
    accepted renames, and so do its sales."""
    log = outcomes.filter(F.col("outcome") == "accepted").select("_row", F.col("vin").alias("old"), F.col("new_vin").alias("new"))
    m = final_keys(log)[0]
    m = write_version(m.select(F.col("key").alias("vin"), "last_key"), scratch_path(cars.sparkSession, "renamed"))
    new_cars = cars.join(m, "vin", "left").withColumn("vin", F.coalesce("last_key", "vin")).select(*cars.columns)
    new_sales = (
        sales.join(m.withColumnRenamed("vin", "car_vin"), "car_vin", "left")
        .withColumn("car_vin", F.coalesce("last_key", "car_vin")).select(*sales.columns)
    )
    return new_cars, new_sales


class Registry:
    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self.cars = fx.registry_cars(spark, d)
        self.models = fx.registry_models(spark, d)
        self.sales = fx.registry_sales(spark, d)

    # ------------------------------------------------------------ files

    def serialize_cars(self) -> DataFrame:
        return self.cars.select("vin", padded(car_record(self.cars)).alias("line"))

    def write_cars(self) -> str:
        path = scratch_path(self.spark, "cars_records")
        self.serialize_cars().select(F.col("line").alias("value")).write.text(path, compression=TEXT_CODEC)
        return path

    # ------------------------------------------------------------ reads

    def by_status(self, status: str = AVAILABLE) -> DataFrame:
        return self.cars.filter(F.col("status") == status).select(
            "vin", "model", "price", "date_start", "status").orderBy("vin")

    def full_info(self) -> DataFrame:
        first_sale = self.sales.groupBy("car_vin").agg(
            F.min(F.struct("sales_date", "sales_number", "cost")).alias("s"))
        j = (
            self.cars.join(self.models, self.cars.model == self.models.id)
            .join(first_sale, F.col("vin") == F.col("car_vin"), "left")
        )
        sold = F.col("status") == SOLD
        return j.select(
            "vin", F.col("name").alias("car_model_name"), F.col("brand").alias("car_model_brand"),
            "price", "date_start", "status",
            F.when(sold, F.col("s.sales_date")).alias("sales_date"),
            F.when(sold, F.col("s.cost")).alias("sales_cost"),
        )

    def top_models(self, k: int = TOP_MODELS) -> DataFrame:
        per_model = (
            self.sales.join(self.cars.select("vin", "model"), F.col("car_vin") == F.col("vin"))
            .groupBy("model").agg(F.count(F.lit(1)).alias("sales_number"))
        )
        j = per_model.join(self.models, per_model.model == self.models.id)
        return j.orderBy(F.desc("sales_number"), "name", "brand").limit(k).select(
            F.col("name").alias("car_model_name"), "brand", "sales_number")

    # ------------------------------------------------------------ batches

    @cached_property
    def keyed_insert_requests(self) -> DataFrame:
        """Existing table: cars with lot <= 25.  Requests: every car, the cars
        with lot divisible by 10 again at a higher price, those with lot
        divisible by 15 once more as they are, and those with lot 7 without a
        key."""
        again = self.cars.filter(F.col("lot") % 10 == 0).withColumn("price", F.col("price") + F.lit(1))
        equal = self.cars.filter(F.col("lot") % 15 == 0)
        keyless = self.cars.filter(F.col("lot") == 7).withColumn("vin", F.lit(None).cast("string"))
        return self.cars.unionByName(again).unionByName(equal).unionByName(keyless).select(
            "vin", "model", F.col("price").cast("decimal(12,2)").alias("price"), "status")

    @cached_property
    def inserted(self) -> DataFrame:
        table = self.cars.filter(F.col("lot") <= 25).select("vin")
        return insert_keyed(table, self.keyed_insert_requests, "vin", ["price", "model", "status"])

    def keyed_insert(self) -> DataFrame:
        return self.inserted.select("vin", "price", "outcome", "reason")

    def keyed_insert_state(self) -> DataFrame:
        """The table after the batch: its cars and the accepted requests."""
        table = self.cars.filter(F.col("lot") <= 25).select("vin", "model", F.col("price").cast("decimal(12,2)").alias("price"), "status")
        return table.unionByName(self.inserted.filter("outcome = 'accepted'").select(*table.columns))

    @cached_property
    def sell_state(self) -> tuple[DataFrame, DataFrame]:
        """Before the batch: cars with lot divisible by 5 are sold and have
        their sale recorded, every other car is available."""
        pre_sold = F.col("lot") % 5 == 0
        cars = self.cars.withColumn("status", F.when(pre_sold, SOLD).otherwise(AVAILABLE))
        sales = self.sales.join(self.cars.filter(pre_sold).select(F.col("vin").alias("car_vin")), "car_vin", "left_semi")
        # Written once: the requests, the outcomes and the new state read it.
        return cars, write_version(sales, scratch_path(self.spark, "recorded_sales"))

    @cached_property
    def sell_requests(self) -> DataFrame:
        """Every recorded sale; again, unchanged, that of cars with lot
        divisible by 12; under an unknown car for lot divisible by 7; without a
        car or a number for lot 9 and 8; for unsold cars with lot % 6 = 1 an
        earlier request under a number that is taken, and for those with lot % 8
        = 3 an earlier one that all of a block make under one new number; and
        in each block a chain in which a number competes for two cars and a car
        for two numbers."""
        cars, sales = self.sell_state
        taken = sales.agg(F.min("sales_number")).first()[0] or "S-NONE"
        mine = self.sales.join(self.cars.select(F.col("vin").alias("car_vin"), "lot", "car_no"), "car_vin")

        def of(where: Column, number=F.col("sales_number"), car=F.col("car_vin"), days: int = 0) -> Column:
            return F.when(where, F.struct(
                number.cast("string").alias("sales_number"), car.cast("string").alias("car_vin"),
                F.date_sub("sales_date", days).alias("sales_date"), "cost"))

        lot, unsold, none = F.col("lot"), F.col("lot") % 5 != 0, F.lit(None)
        asked = [
            of(F.lit(True)),
            of(lot % 12 == 0),
            of(lot % 7 == 0, F.concat("sales_number", F.lit("-U")), F.concat(F.lit("UNKNOWN-"), "car_vin")),
            of(lot == 9, car=none),
            of(lot == 8, number=none),
            of(unsold & (lot % 6 == 1), F.lit(taken), days=1),
            of(unsold & (lot % 8 == 3), F.concat(F.lit("S-SAME-"), _block().cast("string")), days=2),
        ]
        # All requests that a sale makes come from one pass over the sales.
        asked = [mine.select(F.explode(F.array(*asked)).alias("r")).filter("r IS NOT NULL").select("r.*")]
        chain = self.cars.filter((F.col("car_no") - 1) % BLOCK < CHAIN)
        for step in (0, 1):
            asked.append(chain.select(
                F.concat(F.lit("C"), F.col("car_no").cast("string")).alias("sales_number"), _vin_of(F.col("car_no") + step).alias("car_vin"),
                F.date_add(F.lit("1990-01-01").cast("date"), F.pmod(F.col("car_no") * 7 + step * 3, F.lit(11)).cast("int")).alias("sales_date"),
                F.col("price").cast("decimal(12,2)").alias("cost")))
        out = asked[0]
        for more in asked[1:]:
            out = out.unionByName(more)
        return out

    @cached_property
    def sold(self) -> DataFrame:
        cars, sales = self.sell_state
        return sell(cars, sales, self.sell_requests)

    def sell(self) -> DataFrame:
        return self.sold.select("sales_number", "car_vin", "sales_date", "outcome", "reason")

    @cached_property
    def rename_requests(self) -> DataFrame:
        """Renames with the number of the call: lot % 9 = 0 to two fresh keys
        each, lot % 11 = 0 to the next car's key, lot % 13 = 0 from a key that
        does not exist, lot % 10 = 4 all of a block to one new key, lot % 12 = 5
        twice the same, lot 7 and 8 without a key, lot % 14 = 3 a chain of three
        and back, and in lot % 16 = 1 a swap with the next car."""
        c = self.cars.withColumn("next", _vin_of(F.col("car_no") + 1)).withColumn("inner", F.col("car_no") % BLOCK != 0)
        lot, vin, none = F.col("lot"), F.col("vin"), F.lit(None).cast("string")

        def key(mark: str) -> Column:
            return F.concat(F.lit(mark), F.col("car_no").cast("string"))

        def of(where: Column, call: int, old: Column, new: Column) -> Column:
            return F.when(where, F.struct((F.col("car_no") * 10 + call).alias("call"), old.alias("vin"), new.alias("new_vin")))

        hop, swap = lot % 14 == 3, F.col("inner") & (lot % 16 == 1)
        asked = [
            of(lot % 9 == 0, 5, vin, key("NEW")), of(lot % 9 == 0, 2, vin, key("ALT")),
            of((lot % 11 == 0) & F.col("inner"), 6, vin, F.col("next")),
            of(lot % 13 == 0, 1, key("X"), key("Y")),
            of(lot % 10 == 4, 3, vin, F.concat(F.lit("ONE"), _block().cast("string"))),
            of(lot % 12 == 5, 4, vin, key("EQ")), of(lot % 12 == 5, 4, vin, key("EQ")),
            of(lot == 7, 1, none, key("N")), of(lot == 8, 1, vin, none),
            of(hop, 1, vin, key("H1-")), of(hop, 2, key("H1-"), key("H2-")), of(hop, 3, key("H2-"), key("H3-")), of(hop, 7, key("H3-"), vin),
            of(swap, 4, vin, key("T")), of(swap, 8, F.col("next"), vin), of(swap, 9, key("T"), F.col("next")),
        ]
        # All requests that a car makes come from one pass over the cars.
        return c.select(F.explode(F.array(*asked)).alias("r")).filter("r IS NOT NULL").select("r.*")

    @cached_property
    def renamed(self) -> DataFrame:
        return rename(self.cars, self.rename_requests, ["call", "vin", "new_vin"])

    def rename(self) -> DataFrame:
        return self.renamed.select("call", "vin", "new_vin", "outcome", "reason")

    def apply_renames(self) -> tuple[DataFrame, DataFrame]:
        """New cars and sales: accepted renames cascade to the sales."""
        return apply_renames(self.cars, self.sales, self.renamed)

    @cached_property
    def revert_requests(self) -> DataFrame:
        """Reverts: the sales of cars with lot divisible by 4, and unknown
        numbers for unsold cars with lot divisible by 4."""
        l4 = self.cars.filter(F.col("lot") % 4 == 0)
        known = self.sales.join(l4.select(F.col("vin").alias("car_vin")), "car_vin", "left_semi").select("sales_number")
        unknown = l4.filter(F.col("status") == AVAILABLE).select(F.concat(F.lit("S"), F.col("car_no").cast("string")).alias("sales_number"))
        return known.unionByName(unknown).distinct()

    def revert(self) -> DataFrame:
        return revert_sales(self.cars, self.sales, self.revert_requests)[0]

    def apply_sales(self) -> tuple[DataFrame, DataFrame]:
        """New (cars, sales): accepted sales enter the sales table and mark
        their car sold; rejected requests change nothing."""
        return apply_sales(*self.sell_state, self.sold)

    def write_sales_after_revert(self) -> str:
        """The sales file with every reverted sale's record replaced by a
        tombstone (a record is never moved)."""
        rev = self.revert().filter(F.col("outcome") == "reverted").select("sales_number", F.lit(True).alias("_gone"))
        s = self.sales.join(rev, "sales_number", "left")
        line = F.when(F.col("_gone").isNotNull(), F.lit(TOMBSTONE)).otherwise(sale_record())
        path = scratch_path(self.spark, "sales_records")
        s.select(padded(line).alias("value")).write.text(path, compression=TEXT_CODEC)
        return path

    def scan_sales(self) -> DataFrame:
        return typed_sales(scan_records(self.spark, self.write_sales_after_revert(), SALE_SCHEMA))

    def scan_cars(self) -> DataFrame:
        return typed_cars(scan_records(self.spark, self.write_cars(), CAR_SCHEMA))


def _renamed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return Registry(spark, d).apply_renames()


def _reverted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    r = Registry(spark, d)
    return revert_sales(r.cars, r.sales, r.revert_requests)


QUERIES = {
    "registry_serialize": lambda sp, d: Registry(sp, d).serialize_cars(),
    "registry_scan": lambda sp, d: Registry(sp, d).scan_sales(),
    "registry_scan_cars": lambda sp, d: Registry(sp, d).scan_cars(),
    "cars_by_status": lambda sp, d: Registry(sp, d).by_status(),
    "car_full_info": lambda sp, d: Registry(sp, d).full_info(),
    "top3_models": lambda sp, d: Registry(sp, d).top_models(),
    "keyed_insert_batch": lambda sp, d: Registry(sp, d).keyed_insert(),
    "keyed_insert_state": lambda sp, d: Registry(sp, d).keyed_insert_state(),
    "sell_cars_batch": lambda sp, d: Registry(sp, d).sell(),
    "sell_cars_state": lambda sp, d: Registry(sp, d).apply_sales()[0].select("vin", "status"),
    "sell_sales_state": lambda sp, d: Registry(sp, d).apply_sales()[1],
    "rename_keys_batch": lambda sp, d: Registry(sp, d).rename(),
    "rename_cars_state": lambda sp, d: _renamed(sp, d)[0].select("vin", "model", "status"),
    "rename_sales_state": lambda sp, d: _renamed(sp, d)[1].select("sales_number", "car_vin"),
    "revert_sales_batch": lambda sp, d: Registry(sp, d).revert(),
    "revert_cars_state": lambda sp, d: _reverted(sp, d)[1].select("vin", "status"),
    "revert_sales_state": lambda sp, d: _reverted(sp, d)[2].select("sales_number", "car_vin"),
}

# ---------------------------------------------------------------- oracle

_CTES = fx.duck_with("registry_cars", "registry_sales")
_RECURSIVE = "WITH RECURSIVE" + _CTES.removeprefix("WITH")
_OUT = "CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome"


_GRP = f"(car_no - 1) // {BLOCK}"


def _sell_sql() -> str:
    """One after the other: a recursion per block of cars takes its next
    request and carries the cars and numbers that are taken."""
    part = "SELECT {} AS sales_number, {} AS car_vin, sales_date - {} AS sales_date, cost, car_no FROM mine WHERE {}"
    asked = [
        ("sales_number", "car_vin", 0, "true"), ("sales_number", "car_vin", 0, "lot % 12 = 0"),
        ("sales_number || '-U'", "'UNKNOWN-' || car_vin", 0, "lot % 7 = 0"), ("sales_number", "NULL", 0, "lot = 9"), ("NULL", "car_vin", 0, "lot = 8"),
        ("(SELECT min(sales_number) FROM sales)", "car_vin", 1, "lot % 5 <> 0 AND lot % 6 = 1"),
        (f"'S-SAME-' || CAST({_GRP} AS VARCHAR)", "car_vin", 2, "lot % 5 <> 0 AND lot % 8 = 3"),
    ]
    chain = [f"""SELECT 'C' || car_no, 'VIN' || lpad(CAST(car_no + {k} AS VARCHAR), 10, '0'),
  DATE '1990-01-01' + CAST((car_no * 7 + {k} * 3) % 11 AS INTEGER), CAST(price AS DECIMAL(12,2)), car_no
  FROM registry_cars WHERE (car_no - 1) % {BLOCK} < {CHAIN}""" for k in (0, 1)]  # fmt: skip
    return f""", cars AS (SELECT vin, CASE WHEN lot % 5 = 0 THEN '{SOLD}' ELSE '{AVAILABLE}' END AS status FROM registry_cars),
sales AS (SELECT s.* FROM registry_sales s WHERE car_vin IN (SELECT vin FROM registry_cars WHERE lot % 5 = 0)),
mine AS (SELECT s.*, c.lot, c.car_no FROM registry_sales s JOIN registry_cars c ON s.car_vin = c.vin),
req AS ({" UNION ALL ".join([*(part.format(*x) for x in asked), *chain])}),
seen AS (SELECT sales_number, car_vin, sales_date, cost, {_GRP} AS grp, CASE
  WHEN car_vin IS NULL THEN 'no car' WHEN c.vin IS NULL THEN 'unknown car' WHEN sales_number IS NULL THEN 'no sale number'
  WHEN c.status = '{SOLD}' THEN 'car already sold'
  WHEN sales_number IN (SELECT sales_number FROM sales) THEN 'duplicate sale number' END AS reason FROM req LEFT JOIN cars c ON c.vin = car_vin),
fair AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY sales_date, sales_number, car_vin) AS i FROM seen WHERE reason IS NULL),
run AS (SELECT DISTINCT grp, 0::BIGINT AS i, []::VARCHAR[] AS used, ''::VARCHAR AS sales_number, ''::VARCHAR AS car_vin,
    NULL::DATE AS sales_date, NULL::DECIMAL(12,2) AS cost, NULL::VARCHAR AS reason FROM fair
  UNION ALL SELECT grp, i, CASE WHEN why IS NULL THEN list_concat(used, ['c' || car_vin, 'n' || sales_number]) ELSE used END,
    sales_number, car_vin, sales_date, cost, why FROM (
    SELECT q.*, r.used, CASE WHEN list_contains(r.used, 'c' || q.car_vin) THEN 'car sold in batch'
      WHEN list_contains(r.used, 'n' || q.sales_number) THEN 'number taken in batch' END AS why FROM run r JOIN fair q ON q.grp = r.grp AND q.i = r.i + 1)),
sell AS (SELECT sales_number, car_vin, sales_date, cost, {_OUT}, reason FROM (
  SELECT sales_number, car_vin, sales_date, cost, reason FROM seen WHERE reason IS NOT NULL
  UNION ALL SELECT sales_number, car_vin, sales_date, cost, reason FROM run WHERE i > 0))
"""


def _rename_sql() -> str:
    """One after the other, per block of cars: the recursion carries where
    the record of each key that a request names stands."""
    key = lambda mark: f"'{mark}' || car_no"
    nxt, inner = "'VIN' || lpad(CAST(car_no + 1 AS VARCHAR), 10, '0')", f"car_no % {BLOCK} <> 0"
    hop, swap = "lot % 14 = 3", f"{inner} AND lot % 16 = 1"
    asked = [
        ("lot % 9 = 0", 5, "vin", key("NEW")), ("lot % 9 = 0", 2, "vin", key("ALT")), (f"lot % 11 = 0 AND {inner}", 6, "vin", nxt),
        ("lot % 13 = 0", 1, key("X"), key("Y")), ("lot % 10 = 4", 3, "vin", f"'ONE' || CAST({_GRP} AS VARCHAR)"),
        ("lot % 12 = 5", 4, "vin", key("EQ")), ("lot % 12 = 5", 4, "vin", key("EQ")), ("lot = 7", 1, "NULL", key("N")), ("lot = 8", 1, "vin", "NULL"),
        (hop, 1, "vin", key("H1-")), (hop, 2, key("H1-"), key("H2-")), (hop, 3, key("H2-"), key("H3-")), (hop, 7, key("H3-"), "vin"),
        (swap, 4, "vin", key("T")), (swap, 8, nxt, "vin"), (swap, 9, key("T"), nxt),
    ]
    union = " UNION ALL ".join(f"SELECT car_no * 10 + {n} AS call, {old} AS vin, {new} AS new_vin, {_GRP} AS grp FROM registry_cars WHERE {w}" for w, n, old, new in asked)
    return f""", req AS ({union}),
fair AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY call, vin, new_vin) AS i FROM req WHERE vin IS NOT NULL AND new_vin IS NOT NULL),
named AS (SELECT DISTINCT grp, k FROM (SELECT grp, vin AS k FROM fair UNION ALL SELECT grp, new_vin FROM fair) WHERE k IN (SELECT vin FROM registry_cars)),
run AS (SELECT f.grp, 0::BIGINT AS i, coalesce((SELECT list({{'o': k, 'k': k}}) FROM named n WHERE n.grp = f.grp), []) AS st, 0::BIGINT AS call,
    ''::VARCHAR AS vin, ''::VARCHAR AS new_vin, NULL::VARCHAR AS reason FROM (SELECT DISTINCT grp FROM fair) f
  UNION ALL SELECT grp, i, CASE WHEN why IS NULL THEN list_transform(st, lambda x: CASE WHEN x.k = vin THEN {{'o': x.o, 'k': new_vin}} ELSE x END) ELSE st END,
    call, vin, new_vin, why FROM (
    SELECT q.*, r.st, CASE WHEN NOT list_contains(list_transform(r.st, lambda x: x.k), q.vin) THEN 'unknown key'
      WHEN list_contains(list_transform(r.st, lambda x: x.k), q.new_vin) THEN 'new key exists' END AS why FROM run r JOIN fair q ON q.grp = r.grp AND q.i = r.i + 1)),
ren AS (SELECT call, vin, new_vin, {_OUT}, reason FROM (SELECT call, vin, new_vin, reason FROM run WHERE i > 0
  UNION ALL SELECT call, vin, new_vin, CASE WHEN vin IS NULL THEN 'no key' ELSE 'no new key' END FROM req WHERE vin IS NULL OR new_vin IS NULL)),
moved AS (SELECT unnest(st, recursive := true) FROM (SELECT st, i = max(i) OVER (PARTITION BY grp) AS last FROM run) WHERE last)
"""


ORACLE = {
    "registry_serialize": _CTES
    + f"""SELECT vin, rpad(json_object('vin', vin, 'model', model, 'price', CAST(price AS VARCHAR),
  'date_start', strftime(date_start, '%Y-%m-%dT%H:%M:%S'), 'status', status)::VARCHAR, {RECORD_WIDTH}, ' ') AS line
FROM registry_cars""",
    "registry_scan_cars": _CTES + "SELECT vin, model, price, date_start, status FROM registry_cars",
    "registry_scan": _CTES
    + """SELECT * FROM registry_sales WHERE car_vin NOT IN (SELECT vin FROM registry_cars WHERE lot % 4 = 0)""",
    "cars_by_status": _CTES + f"SELECT vin, model, price, date_start, status FROM registry_cars WHERE status = '{AVAILABLE}'",
    "car_full_info": _CTES
    + f"""SELECT c.vin, m.name AS car_model_name, m.brand AS car_model_brand, c.price, c.date_start, c.status,
  CASE WHEN c.status = '{SOLD}' THEN s.sales_date END AS sales_date, CASE WHEN c.status = '{SOLD}' THEN s.cost END AS sales_cost
FROM registry_cars c JOIN registry_models m ON c.model = m.id
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY car_vin ORDER BY sales_date, sales_number) AS rn
           FROM registry_sales) WHERE rn = 1) s ON s.car_vin = c.vin""",
    "top3_models": _CTES
    + f"""SELECT m.name AS car_model_name, m.brand, count(*) AS sales_number
FROM registry_sales s JOIN registry_cars c ON s.car_vin = c.vin JOIN registry_models m ON c.model = m.id
GROUP BY m.id, m.name, m.brand ORDER BY sales_number DESC, car_model_name, m.brand LIMIT {TOP_MODELS}""",
    "keyed_insert_batch": _CTES
    + f""", req AS (SELECT vin, model, price, status FROM registry_cars
  UNION ALL SELECT vin, model, price + 1, status FROM registry_cars WHERE lot % 10 = 0
  UNION ALL SELECT vin, model, price, status FROM registry_cars WHERE lot % 15 = 0
  UNION ALL SELECT NULL, model, price, status FROM registry_cars WHERE lot = 7),
r AS (SELECT *, CASE WHEN vin IS NULL THEN 'no key' WHEN vin IN (SELECT vin FROM registry_cars WHERE lot <= 25) THEN 'key exists'
       WHEN row_number() OVER (PARTITION BY vin ORDER BY price, model, status) > 1 THEN 'duplicate key in batch' END AS reason
  FROM req)
SELECT vin, CAST(price AS DECIMAL(12,2)) AS price, {_OUT}, reason FROM r""",
    "keyed_insert_state": _CTES
    + """SELECT vin, model, CAST(price AS DECIMAL(12,2)) AS price, status FROM registry_cars""",
    "sell_cars_batch": _RECURSIVE + _sell_sql() + "SELECT sales_number, car_vin, sales_date, outcome, reason FROM sell",
    "sell_cars_state": _RECURSIVE + _sell_sql()
    + f"SELECT vin, CASE WHEN vin IN (SELECT car_vin FROM sell WHERE outcome = 'accepted') THEN '{SOLD}' ELSE status END AS status FROM cars",
    "sell_sales_state": _RECURSIVE + _sell_sql()
    + """SELECT sales_number, car_vin, sales_date, cost FROM sales
UNION ALL SELECT sales_number, car_vin, sales_date, cost FROM sell WHERE outcome = 'accepted'""",
    "rename_keys_batch": _RECURSIVE + _rename_sql() + "SELECT * FROM ren",
    "rename_cars_state": _RECURSIVE + _rename_sql()
    + "SELECT coalesce(m.k, c.vin) AS vin, c.model, c.status FROM registry_cars c LEFT JOIN moved m ON m.o = c.vin",
    "rename_sales_state": _RECURSIVE + _rename_sql()
    + "SELECT s.sales_number, coalesce(m.k, s.car_vin) AS car_vin FROM registry_sales s LEFT JOIN moved m ON m.o = s.car_vin",
    "revert_cars_state": _CTES
    + f"""SELECT vin, CASE WHEN lot % 4 = 0 AND vin IN (SELECT car_vin FROM registry_sales) THEN '{AVAILABLE}' ELSE status END AS status FROM registry_cars""",
    "revert_sales_state": _CTES
    + """SELECT sales_number, car_vin FROM registry_sales ANTI JOIN (SELECT vin AS car_vin FROM registry_cars WHERE lot % 4 = 0) USING (car_vin)""",
    "revert_sales_batch": _CTES
    + f""", req AS (SELECT DISTINCT sales_number FROM (
  SELECT sales_number FROM registry_sales WHERE car_vin IN (SELECT vin FROM registry_cars WHERE lot % 4 = 0)
  UNION ALL SELECT 'S' || CAST(car_no AS VARCHAR) FROM registry_cars WHERE lot % 4 = 0 AND status = '{AVAILABLE}'))
SELECT sales_number, CASE WHEN sales_number IN (SELECT sales_number FROM registry_sales) THEN 'reverted' ELSE 'rejected' END AS outcome,
  CASE WHEN sales_number IN (SELECT sales_number FROM registry_sales) THEN NULL ELSE 'unknown sale' END AS reason FROM req""",
}
