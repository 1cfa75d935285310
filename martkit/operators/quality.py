"""Data-quality rules as DataFrame plans (constraints that Parquet tables
do not enforce).  Each rule returns its violations; ``summarize`` turns a
set of rules into one ``(rule, severity, n_bad)`` row each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARNING = "ERROR", "WARNING"


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count (partial
    aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a whole natural key, which a merge leaves out."""
    bad = F.lit(False)
    for k in keys:
        bad = bad | F.col(k).isNull()
    return df.filter(bad)


def lost_versions(df: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """``keys`` and ``n_lost``: how many different attribute sets of a key a
    merge with one row per key does not take."""
    versions = df.groupBy(*keys, *attrs).agg(F.count(F.lit(1)).alias("n"))
    return versions.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n_lost")).filter("n_lost > 0")


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null reference has no parent row."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def reference_counts(references: Sequence[tuple[str, str, str, str, str]], tables: dict[str, DataFrame]) -> DataFrame:
    """``(rule, n_bad)`` of all references in one pass.

    ``references`` are (rule, child, foreign key, parent, key).  Each child
    is scanned once for all of its foreign keys and each parent once for all
    of its keys; the (rule, value) pairs of both are stacked and reduced in one
    aggregation, so a value that many rows hold is one partial row per task.
    """
    spark = next(iter(tables.values())).sparkSession
    stacked = None
    for table in dict.fromkeys(t for r in references for t in (r[1], r[3])):
        pairs = [
            F.struct(F.lit(i).alias("i"), F.col(col).cast("string").alias("value"), F.lit(own).alias("here"))
            for i, (_, child, fk, parent, pk) in enumerate(references)
            for own, t, col in ((False, child, fk), (True, parent, pk)) if t == table
        ]
        rows = tables[table].select(F.explode(F.array(*pairs)).alias("x")).select("x.*").filter("value IS NOT NULL")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    values = stacked.groupBy("i", "value").agg(F.count_if(~F.col("here")).alias("n"), F.max("here").alias("known"))
    bad = values.groupBy("i").agg(F.sum(F.when(~F.col("known"), F.col("n")).otherwise(0)).alias("n_bad"))
    rules = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(r[0]).alias("rule")) for i, r in enumerate(references)]))
    return spark.range(1).select(rules).join(bad, "i", "left").select("rule", F.coalesce("n_bad", F.lit(0).cast("bigint")).alias("n_bad"))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for every column, in one scan."""
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", "null_count")


def any_null(df: DataFrame) -> DataFrame:
    """Rows with a null in any column (the table's NOT NULL constraints)."""
    cond = F.lit(False)
    for c in df.columns:
        cond = cond | F.col(c).isNull()
    return df.filter(cond)


def domain_violations(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*allowed))


def bound_violations(df: DataFrame, cond_ok: Column) -> DataFrame:
    """Rows where ``cond_ok`` is false (null counts as a violation)."""
    return df.filter(~F.coalesce(cond_ok, F.lit(False)))


def fits_decimal(col: str, precision: int, scale: int) -> Column:
    return F.col(col).isNull() | F.col(col).try_cast(f"decimal({precision},{scale})").isNotNull()


def count_rows(df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """``(rule, severity, n_bad)`` of any number of row rules in one scan;
    each rule's column is true for a bad row."""
    counts = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)])
    rows = [F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"), F.col(f"r{i}").alias("n_bad")) for i, (n, s, _) in enumerate(rules)]
    return counts.select(F.inline(F.array(*rows)))


def summarize(rules: Sequence[tuple[str, str, DataFrame]]) -> DataFrame:
    """One ``(rule, severity, n_bad)`` row per rule (each a global count)."""
    out = None
    for name, severity, bad in rules:
        row = bad.agg(F.count(F.lit(1)).alias("n_bad")).select(
            F.lit(name).alias("rule"), F.lit(severity).alias("severity"), "n_bad"
        )
        out = row if out is None else out.unionByName(row)
    return out
