"""Daily order pipeline: increment -> staging -> dims -> signed fact -> weekly
retention mart.  Every step is a function of DataFrames and a business date
argument; any scheduler can call ``run_day``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import ntz
from ..functions.numeric import cents, cents_to_decimal
from ..operators.keys import keep_first
from ..operators.merge import by_period, insert_absent, write_version
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources.io import read_increment_csv, write_csv

ORDER_LOG_COLUMNS = [
    "uniq_id", "date_time", "city_id", "city_name", "customer_id", "first_name", "last_name",
    "item_id", "item_name", "quantity", "payment_amount", "status",
]
# "First" row of a duplicated uniq_id: the file order is not a table property,
# so it is pinned down as a total order over the row's columns.
DEDUPE_ORDER = ["date_time", "payment_amount", "item_id", "customer_id", "quantity", "status", "city_id"]


# ---------------------------------------------------------------- staging


def conform_increment(inc: DataFrame) -> DataFrame:
    """Drop the source row id, keep the first row per ``uniq_id``, default
    ``status`` to ``'shipped'`` when the file has no such column."""
    if "id" in inc.columns:
        inc = inc.drop("id")
    if "status" not in inc.columns:
        inc = inc.withColumn("status", F.lit("shipped"))
    return keep_first(inc, ["uniq_id"], [c for c in DEDUPE_ORDER if c in inc.columns]).select(
        *[c for c in ORDER_LOG_COLUMNS if c in inc.columns]
    )


def append_staging(df: DataFrame, path: str) -> int:
    """Append to the staging table; the row count comes from an observation
    of the same write (no second scan)."""
    from pyspark.sql import Observation

    obs = Observation("staging_append")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(obs.get["rows"])


def conform_order_increment(spark: SparkSession, d: str) -> DataFrame:
    log = fx.user_order_log(spark, d)
    # The delivered increment: the log with a source row id, delivered twice
    # (a repeated delivery), as the CSV file the pipeline downloads.
    delivered = log.withColumn("id", F.col("uniq_id")).unionByName(log.withColumn("id", F.col("uniq_id") + 1))
    inc_path = scratch_path(spark, "increment")
    write_csv(delivered.select("id", *ORDER_LOG_COLUMNS), inc_path)
    inc = read_increment_csv(spark, inc_path)
    staging = scratch_path(spark, "staging_user_order_log")
    append_staging(conform_increment(inc), staging)
    return spark.read.parquet(staging).select(*ORDER_LOG_COLUMNS)


# ---------------------------------------------------------------- dims


def _existing_dims_cutoff(log: DataFrame) -> DataFrame:
    """Dimension rows already loaded before the current run: the first half
    of the log's days (the pipeline runs day by day)."""
    return log.filter(F.col("date_time") < F.lit("2024-01-15").cast("timestamp_ntz"))


def conform_without_status(spark: SparkSession, d: str) -> DataFrame:
    """An early delivery, whose file has no ``status``: every row is shipped."""
    log = fx.user_order_log(spark, d).drop("status")
    return conform_increment(log.unionByName(log).withColumn("id", F.col("uniq_id")))


def _dim_city(log: DataFrame) -> DataFrame:
    return log.groupBy("city_id").agg(F.min("city_name").alias("city_name"))


def _dim_customer(log: DataFrame) -> DataFrame:
    return log.groupBy("customer_id").agg(
        F.min("first_name").alias("first_name"), F.min("last_name").alias("last_name"),
        F.max("city_id").alias("city_id"),
    )


def _dim_item(log: DataFrame) -> DataFrame:
    return log.groupBy("item_id").agg(F.min("item_name").alias("item_name"))


def insert_absent_city(spark: SparkSession, d: str) -> DataFrame:
    log = fx.user_order_log(spark, d)
    existing = _dim_city(_existing_dims_cutoff(log))
    return insert_absent(existing, log, "city_id", [F.min("city_name").alias("city_name")])


def insert_absent_customer(spark: SparkSession, d: str) -> DataFrame:
    log = fx.user_order_log(spark, d)
    existing = _dim_customer(_existing_dims_cutoff(log))
    return insert_absent(
        existing, log, "customer_id",
        [F.min("first_name").alias("first_name"), F.min("last_name").alias("last_name"),
         F.max("city_id").alias("city_id")],
    )


def insert_absent_item(spark: SparkSession, d: str) -> DataFrame:
    log = fx.user_order_log(spark, d)
    existing = _dim_item(_existing_dims_cutoff(log))
    return insert_absent(existing, log, "item_id", [F.min("item_name").alias("item_name")])


# ---------------------------------------------------------------- fact


def calendar(log: DataFrame) -> DataFrame:
    """``d_calendar(date_id, date_actual)`` over the log's date span."""
    span = log.agg(F.min("date_time").cast("date").alias("lo"), F.max("date_time").cast("date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date_actual"))
    return days.select(F.date_format("date_actual", "yyyyMMdd").cast("int").alias("date_id"), "date_actual")


def sales_fact(log: DataFrame, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Signed sales rows (refunds negative) for the days in ``days``
    (inclusive range; ``None`` = all days, i.e. a back-fill)."""
    src = between_days(log, days) if days is not None else log
    # One row per day of the rows in hand; AQE decides how to join it.
    cal = calendar(src)
    refunded = F.col("status") == "refunded"
    j = src.join(cal, src.date_time.cast("date") == cal.date_actual, "left")
    return j.select(
        "date_id", "item_id", "customer_id", "city_id",
        F.when(refunded, -F.col("quantity")).otherwise(F.col("quantity")).alias("quantity"),
        F.when(refunded, -F.col("payment_amount")).otherwise(F.col("payment_amount")).alias("payment_amount"),
        "status",
        F.col("date_time").cast("date").alias("sale_date"),
    )


def daily_sales_slice(spark: SparkSession, d: str) -> DataFrame:
    """Back-fill of ``f_sales`` over every day of the log, written with
    dynamic partition overwrite per day, so a re-run replaces, not appends."""
    log = fx.user_order_log(spark, d)
    path = scratch_path(spark, "f_sales")
    out = write_version(sales_fact(log), path, ["sale_date"])
    return out.select("date_id", "item_id", "customer_id", "city_id", "quantity", "payment_amount", "status")


# ---------------------------------------------------------------- retention


def weekly_retention(log: DataFrame) -> DataFrame:
    """Retention metrics per (item, ISO year, ISO week).

    Level 1 per (item, customer, week): orders, refunds, revenue, refunded
    money.  Level 2 per (item, week): customers that are new (one order, no
    refund), returning (several orders, no refund) or refunded.  Both levels
    aggregate partially before their shuffle, so a hot item is combined on
    the map side.  ``refund_amount`` is the reference's ``customers_refunded``
    (money); ``refund_count`` is the documented count of refunds.
    """
    refunded = F.col("status") == "refunded"
    not_refunded = F.col("status") != "refunded"
    lvl1 = log.groupBy(
        "item_id", "customer_id",
        F.expr("extract(YEAROFWEEK FROM date_time)").cast("int").alias("period_year"),
        F.weekofyear("date_time").cast("int").alias("period_id"),
    ).agg(
        F.count_distinct("uniq_id").alias("order_count"),
        F.sum(F.when(refunded, 1).otherwise(0)).alias("refund_count"),
        F.sum(F.when(not_refunded, cents("payment_amount")).otherwise(0)).alias("revenue_c"),
        F.sum(F.when(refunded, cents("payment_amount")).otherwise(0)).alias("refund_c"),
    )
    new = (F.col("order_count") == 1) & (F.col("refund_count") == 0)
    ret = (F.col("order_count") > 1) & (F.col("refund_count") == 0)
    ref = F.col("refund_count") > 0
    # customer_id is a grouping key of level 1, so count(when(...)) over it
    # equals COUNT(DISTINCT CASE ... END) without a second distinct pass.
    lvl2 = lvl1.groupBy("item_id", "period_year", "period_id").agg(
        F.count(F.when(new, F.col("customer_id"))).alias("new_customers_count"),
        F.count(F.when(ret, F.col("customer_id"))).alias("returning_customers_count"),
        F.count(F.when(ref, F.col("customer_id"))).alias("refunded_customers_count"),
        F.sum(F.when(new, F.col("revenue_c")).otherwise(0)).alias("new_c"),
        F.sum(F.when(ret, F.col("revenue_c")).otherwise(0)).alias("ret_c"),
        F.sum("refund_c").alias("refund_c"),
        F.sum("refund_count").alias("refund_count"),
    )
    return lvl2.select(
        "new_customers_count", "returning_customers_count", "refunded_customers_count",
        F.lit("weekly").alias("period_name"), "period_year", "period_id", "item_id",
        cents_to_decimal("new_c", 12).alias("new_customers_revenue"),
        cents_to_decimal("ret_c", 12).alias("returning_customers_revenue"),
        cents_to_decimal("refund_c", 12).alias("refund_amount"),
        F.col("refund_count").cast("bigint").alias("refund_count"),
    )


def weekly_customer_retention(spark: SparkSession, d: str) -> DataFrame:
    """All weeks of the log, written with partition overwrite per
    (ISO year, week): a daily re-run replaces its week instead of appending
    another copy."""
    log = fx.user_order_log(spark, d)
    path = scratch_path(spark, "f_customer_retention")
    cols = weekly_retention(log).columns
    out = write_version(weekly_retention(log), path, ["period_year", "period_id"])
    return out.withColumn("period_year", F.col("period_year").cast("int")).withColumn(
        "period_id", F.col("period_id").cast("int")).select(*cols)


def week_of(ds: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the ISO week of ``ds``."""
    monday = ds - dt.timedelta(days=ds.weekday())
    return monday, monday + dt.timedelta(days=6)


def between_days(log: DataFrame, days: tuple[dt.date, dt.date]) -> DataFrame:
    """Rows of an inclusive range of days, as a half-open timestamp range:
    Parquet statistics prune row groups."""
    lo, hi = days
    return log.filter((F.col("date_time") >= ntz(lo)) & (F.col("date_time") < ntz(hi + dt.timedelta(days=1))))


def run_day(spark: SparkSession, log: DataFrame, ds: dt.date, fact_path: str, retention_path: str) -> None:
    """One scheduled day: the day's fact partition and its week's retention
    partition are overwritten (idempotent re-runs)."""
    day = by_period(sales_fact(log, (ds, ds)), ["sale_date"])
    day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sale_date").parquet(fact_path)
    week = by_period(weekly_retention(between_days(log, week_of(ds))), ["period_year", "period_id"])
    week.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period_year", "period_id").parquet(
        retention_path
    )


# The business date of the registered one-day runs.
RUN_DATE = dt.date(2024, 1, 10)


def sales_of_one_day(spark: SparkSession, d: str, ds: dt.date = RUN_DATE) -> DataFrame:
    """The fact rows that the run of one business date writes."""
    out = sales_fact(fx.user_order_log(spark, d), (ds, ds))
    return out.select("date_id", "item_id", "customer_id", "city_id", "quantity", "payment_amount", "status")


def retention_of_one_week(spark: SparkSession, d: str, ds: dt.date = RUN_DATE) -> DataFrame:
    """The retention rows that the run of one business date writes."""
    return weekly_retention(between_days(fx.user_order_log(spark, d), week_of(ds)))


# ---------------------------------------------------------------- oracle

_LOG = fx.duck_with("user_order_log")
_CUT = "date_time < TIMESTAMP '2024-01-15 00:00:00'"


def _retention_sql(rows: str) -> str:
    """A customer's kind is found per row with windows over its (item, week),
    one row per customer is marked, and a single grouping adds up."""
    return _LOG + f""", tagged AS (
  SELECT item_id, isoyear(date_time) AS y, week(date_time) AS w, payment_amount AS paid, status = 'refunded' AS back,
    bool_or(status = 'refunded') OVER mine AS ever_back,
    min(uniq_id) OVER mine <> max(uniq_id) OVER mine AS several,
    row_number() OVER (PARTITION BY item_id, isoyear(date_time), week(date_time), customer_id ORDER BY uniq_id, payment_amount) = 1 AS mark
  FROM user_order_log WHERE {rows}
  WINDOW mine AS (PARTITION BY item_id, isoyear(date_time), week(date_time), customer_id))
SELECT item_id, CAST(y AS INTEGER) AS period_year, CAST(w AS INTEGER) AS period_id, 'weekly' AS period_name,
  CAST(count_if(mark AND NOT ever_back AND NOT several) AS BIGINT) AS new_customers_count,
  CAST(count_if(mark AND NOT ever_back AND several) AS BIGINT) AS returning_customers_count,
  CAST(count_if(mark AND ever_back) AS BIGINT) AS refunded_customers_count,
  CAST(coalesce(sum(paid) FILTER (WHERE NOT ever_back AND NOT several), 0) AS DECIMAL(12,2)) AS new_customers_revenue,
  CAST(coalesce(sum(paid) FILTER (WHERE NOT ever_back AND several), 0) AS DECIMAL(12,2)) AS returning_customers_revenue,
  CAST(coalesce(sum(paid) FILTER (WHERE back), 0) AS DECIMAL(12,2)) AS refund_amount, CAST(count_if(back) AS BIGINT) AS refund_count
FROM tagged GROUP BY item_id, y, w"""


ORACLE = {
    "weekly_customer_retention": _retention_sql("true"),
    "retention_of_one_week": _retention_sql(f"CAST(date_time AS DATE) BETWEEN DATE '{week_of(RUN_DATE)[0]}' AND DATE '{week_of(RUN_DATE)[1]}'"),
    "sales_of_one_day": _LOG + f"""
SELECT CAST(year(date_time) * 10000 + month(date_time) * 100 + day(date_time) AS INTEGER) AS date_id, item_id, customer_id, city_id,
  (1 - 2 * CAST(status = 'refunded' AS INTEGER)) * quantity AS quantity,
  CAST((1 - 2 * CAST(status = 'refunded' AS INTEGER)) * payment_amount AS DECIMAL(10,2)) AS payment_amount, status
FROM user_order_log WHERE CAST(date_time AS DATE) = DATE '{RUN_DATE}'""",
    "daily_sales_slice": _LOG + """
SELECT CAST(strftime(CAST(date_time AS DATE), '%Y%m%d') AS INTEGER) AS date_id, item_id, customer_id, city_id,
  CASE WHEN status = 'refunded' THEN -quantity ELSE quantity END AS quantity,
  CASE WHEN status = 'refunded' THEN -payment_amount ELSE payment_amount END AS payment_amount, status
FROM user_order_log""",
    "conform_order_increment": _LOG + "SELECT * FROM user_order_log",
    "conform_without_status": _LOG + "SELECT * REPLACE ('shipped' AS status) FROM user_order_log",
    "insert_absent_city": _LOG + f""",
existing AS (SELECT city_id, min(city_name) AS city_name FROM user_order_log WHERE {_CUT} GROUP BY city_id)
SELECT * FROM existing UNION ALL
SELECT city_id, min(city_name) FROM user_order_log WHERE city_id NOT IN (SELECT city_id FROM existing) GROUP BY city_id""",
    "insert_absent_customer": _LOG + f""",
existing AS (SELECT customer_id, min(first_name) AS first_name, min(last_name) AS last_name, max(city_id) AS city_id
             FROM user_order_log WHERE {_CUT} GROUP BY customer_id)
SELECT * FROM existing UNION ALL
SELECT customer_id, min(first_name), min(last_name), max(city_id) FROM user_order_log
WHERE customer_id NOT IN (SELECT customer_id FROM existing) GROUP BY customer_id""",
    "insert_absent_item": _LOG + f""",
existing AS (SELECT item_id, min(item_name) AS item_name FROM user_order_log WHERE {_CUT} GROUP BY item_id)
SELECT * FROM existing UNION ALL
SELECT item_id, min(item_name) FROM user_order_log WHERE item_id NOT IN (SELECT item_id FROM existing) GROUP BY item_id""",
}

QUERIES = {
    "weekly_customer_retention": weekly_customer_retention,
    "daily_sales_slice": daily_sales_slice,
    "sales_of_one_day": sales_of_one_day,
    "retention_of_one_week": retention_of_one_week,
    "conform_order_increment": conform_order_increment,
    "conform_without_status": conform_without_status,
    "insert_absent_city": insert_absent_city,
    "insert_absent_customer": insert_absent_customer,
    "insert_absent_item": insert_absent_item,
}
