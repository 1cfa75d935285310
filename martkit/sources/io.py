"""File sources and sinks: typed CSV, delivered increments, fixed-width JSON
lines, raw text landing.  All reads use an explicit schema (no inference
pass over the data)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# CSV dialect of the reference's import (header, comma, the
# word null for missing values) and the record layout of its registry files
# (500 characters of JSON padded with spaces, then a newline; "{}" marks a
# deleted record).
CSV_NULL = "null"
CSV_DELIMITER = ","
RECORD_WIDTH = 500
TOMBSTONE = "{}"
# Text files are written compressed (padding and repeated fields take next to
# nothing then); Spark reads them by their ending.
TEXT_CODEC = "gzip"

_CORRUPT = "_corrupt_record"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

RAW_SALES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("auto", T.StringType()),
        T.StructField("gasoline_consumption", T.DecimalType(3, 1)),
        T.StructField("price", T.DecimalType(9, 2)),
        T.StructField("date", T.DateType()),
        T.StructField("person_name", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("discount", T.IntegerType()),
        T.StructField("brand_origin", T.StringType()),
    ]
)

ORDER_INCREMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("uniq_id", T.LongType()),
        T.StructField("date_time", T.TimestampNTZType()),
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("item_id", T.IntegerType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("payment_amount", T.DecimalType(10, 2)),
        T.StructField("status", T.StringType()),
    ]
)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", CSV_DELIMITER)
        .option("nullValue", CSV_NULL)
        .option("timestampNTZFormat", TS_FORMAT)
        .option("compression", TEXT_CODEC)
        .csv(path)
    )


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """``COPY … FROM … WITH CSV HEADER DELIMITER ',' NULL 'null'``.

    ``FAILFAST`` raises on a malformed row like the database import does;
    ``PERMISSIVE`` keeps going and nulls the bad fields.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", CSV_DELIMITER)
        .option("nullValue", CSV_NULL)
        .option("timestampNTZFormat", TS_FORMAT)
        .option("mode", mode)
        .csv(path)
    )


class TooManyBadRows(ValueError):
    """A delivery has a larger share of damaged lines than it may have."""


def read_csv_quarantined(spark: SparkSession, path: str, schema: T.StructType, most_bad: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """(rows, damaged lines) of one read of a delivery.

    A line whose fields do not fit the schema goes, as it is, to the second
    table (column ``line``); every other line is a typed row of the first.  Both
    are counted while the read is written once; more than the share
    ``most_bad`` of damaged lines fails the import.
    """
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    read = (
        spark.read.schema(marked).option("header", True).option("sep", CSV_DELIMITER).option("nullValue", CSV_NULL)
        .option("timestampNTZFormat", TS_FORMAT).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    )
    seen = Observation("delivery")
    staged = scratch_path(spark, "delivery")
    read.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col(_CORRUPT).isNotNull()).alias("bad")).write.parquet(staged)
    n, bad = seen.get["n"], seen.get["bad"]
    if bad > most_bad * n:
        raise TooManyBadRows(f"{bad} of {n} lines of {path} do not fit the schema")
    kept = spark.read.schema(marked).parquet(staged)
    return kept.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT), kept.filter(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("line"))


def read_increment_csv(spark: SparkSession, path: str) -> DataFrame:
    """One or many delivered increment files (a folder or a glob)."""
    return read_csv_typed(spark, path, ORDER_INCREMENT_SCHEMA)


# ---------------------------------------------------------------- JSON lines


def padded(record: Column) -> Column:
    """A JSON record filled up with spaces to the record width.  A longer
    record is written whole: padding never cuts."""
    return F.when(F.length(record) < RECORD_WIDTH, F.rpad(record, RECORD_WIDTH, " ")).otherwise(record)


def scan_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read JSON record lines of any length, skipping ``{}`` tombstones.

    A damaged line fails the scan (``FAILFAST``) instead of becoming a row
    of nulls.
    """
    raw = spark.read.text(path).select(F.trim("value").alias("line"))
    live = raw.filter(F.col("line") != TOMBSTONE)
    return live.select(F.from_json("line", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
