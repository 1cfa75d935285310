"""Surrogate keys and keep-first de-duplication.

``dense_keys`` numbers rows 1..n (or from any start) in a total order without
a single-partition window: rows are range-partitioned and sorted, each
partition's row count is computed (one small row per partition), the
running offsets are built over those few rows and broadcast back.  The data
itself is never moved to one task.  The range-partitioned, sorted rows are
written once as a table below the shared checkpoint folder (with their
partition number and position), so the counting pass and the numbering
pass read the same boundaries even if an executor is lost in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import TABLE_CODEC, scratch_path

ColumnLike = Column | str


def _cols(order: Sequence[ColumnLike]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def dense_keys(
    df: DataFrame,
    order: Sequence[ColumnLike],
    key_col: str,
    start: int | Column = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``key_col`` = position of the row in ``order`` plus ``start - 1``.

    ``order`` should be a total order (natural key) for keys to be stable
    between runs.  ``start`` may be a literal or a one-row aggregate column
    such as ``max(existing) + 1`` given as an int computed by the caller.
    """
    spark = df.sparkSession
    cols = _cols(order)
    path = scratch_path(spark, "dense_keys")
    # Without an explicit count AQE may merge adjacent ranges for a small
    # input; merged partitions stay contiguous and in order.
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    (
        ranged
        .sortWithinPartitions(*cols)
        .withColumn("_mk_pid", F.spark_partition_id())
        .withColumn("_mk_pos", F.monotonically_increasing_id())
        .write.parquet(path, compression=TABLE_CODEC)
    )
    ordered = spark.read.parquet(path)
    # One row per partition: bounded by the partition count, not the data.
    per_part = ordered.groupBy("_mk_pid").agg(
        F.count(F.lit(1)).alias("_mk_n"), F.min("_mk_pos").alias("_mk_base")
    )
    w = Window.orderBy("_mk_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_mk_off", F.coalesce(F.sum("_mk_n").over(w), F.lit(0)))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (
        ordered.join(F.broadcast(offsets.select("_mk_pid", "_mk_off", "_mk_base")), "_mk_pid")
        .withColumn(
            key_col,
            (F.col("_mk_off") + F.col("_mk_pos") - F.col("_mk_base") + start_col).cast("bigint"),
        )
        .drop("_mk_pid", "_mk_pos", "_mk_off", "_mk_base")
    )


def hash_key(*cols: ColumnLike) -> Column:
    """A deterministic key from natural-key columns: SHA-256 of their texts,
    each after its length, so no value can run into the next; a null has no
    length and differs from every text."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-:")) for c in _cols(cols)]
    return F.sha2(F.concat(*parts), 256)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike], pick=F.min) -> DataFrame:
    """One row per ``keys``: the first in ``order`` (a total order).

    Implemented as ``min`` of a struct (order columns first, then the row),
    which Spark aggregates partially on the map side, so a key that holds a
    large share of the rows is reduced before the shuffle instead of being
    sorted in one task as ``row_number()`` would do.
    """
    order_cols = _cols(order)
    # A column of the order is carried once, as such.
    names = [c if isinstance(c, str) else None for c in order]
    payload = [c for c in df.columns if c not in keys and c not in names]
    ranked = df.select(
        *keys,
        F.struct(
            *[c.alias(f"_o{i}") for i, c in enumerate(order_cols)],
            *([F.struct(*payload).alias("_row")] if payload else []),
        ).alias("_k"),
    )
    best = ranked.groupBy(*keys).agg(pick("_k").alias("_k"))

    def of(c: str) -> Column:
        if c in keys:
            return F.col(c)
        field = F.col("_k").getField(f"_o{names.index(c)}") if c in names else F.col("_k").getField("_row").getField(c)
        return field.alias(c)

    return best.select(*[of(c) for c in df.columns])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """One row per ``keys``: the last in ``order`` (see ``keep_first``)."""
    return keep_first(df, keys, order, F.max)
