"""Catalog listing and raw landing of delivered web payloads.

The reference lists the categories of a remote catalog and saves one raw
text file per category.  The HTTP client is not built; the delivered pages
stand in for the payloads, their host being the category.  Landing writes
the raw bodies partitioned by category (a small category is one file, a large
one is split by size) and reads them back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import by_period
from ..session import scratch_path
from ..sources import fixtures as fx

# Record separator between landed bodies: bodies keep their own newlines.
LINE_SEP = "\x1e"
PAYLOAD_ENTRIES = 1000


def catalog_categories(spark: SparkSession, d: str) -> DataFrame:
    """One catalog entry per category: its first URL and its page count."""
    pages = fx.page_hosts(spark, d)
    return pages.groupBy("category").agg(F.min("url").alias("url"), F.count(F.lit(1)).alias("n_pages"))


def catalog_from_json(root: DataFrame, body: str = "body") -> DataFrame:
    """A root payload ``{"category": "url", ...}`` -> rows (category, url)."""
    return root.select(F.explode(F.from_json(body, "map<string,string>")).alias("category", "url"))


def root_payloads(spark: SparkSession, d: str, entries: int = PAYLOAD_ENTRIES) -> DataFrame:
    """The catalog as delivered: JSON objects of ``"category": "url"`` members,
    about ``entries`` in each, so their number grows with the catalog and
    their size does not."""
    listed = catalog_categories(spark, d)
    payloads = max(1, -(-listed.count() // entries))
    members = F.map_from_entries(F.collect_list(F.struct("category", "url")))
    return listed.groupBy(F.pmod(F.xxhash64("category"), F.lit(payloads)).alias("payload")).agg(F.to_json(members).alias("body"))


def catalog_rows(spark: SparkSession, d: str) -> DataFrame:
    return catalog_from_json(root_payloads(spark, d))


def land(pages: DataFrame, path: str) -> None:
    by_period(pages.select("category", "body"), ["category"]).write.mode("overwrite").partitionBy("category").option(
        "lineSep", LINE_SEP
    ).text(path)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    # The schema names the partition column's type: no type inference.
    return (
        spark.read.schema("value string, category string").option("lineSep", LINE_SEP)
        .text(path)
        .select("category", F.col("value").alias("body"))
    )


def land_by_category(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    land(fx.page_hosts(spark, d), path)
    # Two sums over digests tell the bodies themselves, whatever their order.
    digest = [F.conv(F.substring(F.md5("body"), 1 + 8 * k, 8), 16, 10).cast("bigint") for k in (0, 1)]
    return read_landed(spark, path).groupBy("category").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum(F.length("body")).alias("n_chars"),
        F.sum(digest[0]).alias("digest_1"), F.sum(digest[1]).alias("digest_2"),
    )


QUERIES = {
    "catalog_categories": catalog_categories,
    "catalog_rows": catalog_rows,
    "land_by_category": land_by_category,
}

_CTES = fx.duck_with("page_hosts")
ORACLE = {
    "catalog_categories": _CTES + "SELECT category, min(url) AS url, count(*) AS n_pages FROM page_hosts GROUP BY category",
    "catalog_rows": _CTES + "SELECT category, min(url) AS url FROM page_hosts GROUP BY category",
    "land_by_category": _CTES
    + """SELECT category, count(*) AS n_pages, CAST(sum(length(body)) AS BIGINT) AS n_chars,
  CAST(sum(CAST('0x' || substr(md5(body), 1, 8) AS BIGINT)) AS BIGINT) AS digest_1,
  CAST(sum(CAST('0x' || substr(md5(body), 9, 8) AS BIGINT)) AS BIGINT) AS digest_2 FROM page_hosts GROUP BY category""",
}
