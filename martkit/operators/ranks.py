"""Global ranks without a single-partition window over the data.

``with_ranks`` numbers rows by their place in an order: equal rows share a
place, ``rank`` leaves gaps after them and ``dense_rank`` does not.  Rows are
range-partitioned and sorted (equal ones over as many partitions as they fill)
and written once.  A partition is ranked by itself; what it needs from the ones
before it is one row per partition: how many rows and different values they
hold, and, if its first value began earlier, where.  Those few rows are
accumulated and broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .merge import write_version


def with_ranks(
    df: DataFrame, order: Sequence[str], descending: bool = False, rank: str = "rank", dense: str = "dense_rank", num_partitions: int | None = None
) -> DataFrame:
    """``df`` with its ``rank`` and ``dense_rank`` by the columns ``order``
    (nulls first, or last if ``descending``)."""
    by = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    keys = [*by, F.col("_tie").asc()]
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(num_partitions, *keys) if num_partitions else tied.repartitionByRange(*keys)
    placed = ranged.sortWithinPartitions(*keys).drop("_tie").withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id())
    placed = write_version(placed, scratch_path(df.sparkSession, "ranks"))
    inside = Window.partitionBy("_part").orderBy(*by)
    local = placed.withColumn("_r", F.rank().over(inside).cast("bigint")).withColumn("_d", F.dense_rank().over(inside).cast("bigint"))

    value = F.struct(*order)
    parts = local.groupBy("_part").agg(
        F.count(F.lit(1)).alias("n"), F.max("_r").alias("last_at"), F.max("_d").alias("values"),
        F.min_by(value, "_pos").alias("first"), F.max_by(value, "_pos").alias("last"),
    )  # one row per partition
    along = Window.orderBy("_part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    parts = (
        parts.withColumn("joined", F.col("first").eqNullSafe(F.lag("last").over(along)))
        .withColumn("rows", F.coalesce(F.sum("n").over(before), zero))
        .withColumn("began", F.when((F.col("values") > 1) | ~F.col("joined"), F.col("rows") + F.col("last_at")))
        .withColumn("first_at", F.when(F.col("joined"), F.last("began", ignorenulls=True).over(before)).otherwise(F.col("rows") + 1))
        .withColumn("seen", F.coalesce(F.sum("values").over(before), zero) - F.sum(F.col("joined").cast("bigint")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    )
    out = local.join(F.broadcast(parts.select("_part", "rows", "first_at", "seen")), "_part")
    place = F.when(F.col("_d") == 1, F.col("first_at")).otherwise(F.col("rows") + F.col("_r"))
    return out.select(*df.columns, place.alias(rank), (F.col("seen") + F.col("_d")).alias(dense))
