"""A mart kept by signed contributions.

A mart row that shows sums, the most frequent value and the median of its
source rows cannot be corrected from the row itself when a source row changes.
It can from the counts behind it.  ``contributions`` turns a source row into
what it adds to its mart row: summands, and one entry per counted value.  The
image of a row before a change contributes with sign -1, the image after it
with sign +1; ``merged`` adds contributions to a state, where what has come to
nought is dropped; ``Figures.rows`` reads the mart's figures from the state.  So a
change costs what it touches, in any number and order of batches.

The state is two tables per key: one row of sums, and one row per counted value
(``kind``, ``text`` or ``num``, ``n``).  All merging is partial aggregation, so
a key that holds a third of all changes is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTED = ["kind", "text", "num"]


@dataclass(frozen=True)
class Figures:
    """What a source row contributes to its key: ``sums`` (name -> number),
    ``counted`` (kind -> text or number, null: no entry)."""

    keys: tuple[str, ...]
    sums: dict[str, Column]
    counted: dict[str, tuple[str, Column]]

    def contributions(self, rows: DataFrame, sign: int = 1) -> tuple[DataFrame, DataFrame]:
        """(sums, counts) of ``rows``, one row per key or per key and value.
        ``n`` counts the rows of a key."""
        both = rows.select(
            *self.keys,
            *[F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")).alias(name) for name, c in self.sums.items()],
            F.array(*[
                F.struct(
                    F.lit(kind).alias("kind"),
                    (c.cast("string") if where == "text" else F.lit(None).cast("string")).alias("text"),
                    (c.cast("bigint") if where == "num" else F.lit(None).cast("bigint")).alias("num"),
                )
                for kind, (where, c) in self.counted.items()
            ]).alias("_values"),
        )
        sums = both.groupBy(*self.keys).agg(
            (F.count(F.lit(1)) * sign).alias("n"), *[(F.sum(name) * sign).cast("bigint").alias(name) for name in self.sums])
        each = both.select(*self.keys, F.explode("_values").alias("v")).select(*self.keys, "v.*").filter("text IS NOT NULL OR num IS NOT NULL")
        counts = each.groupBy(*self.keys, *COUNTED).agg((F.count(F.lit(1)) * sign).alias("n"))
        return sums, counts

    def merged(self, *states: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
        """The sum of states; a key without rows and a value without rows go."""
        sums, counts = states[0]
        for s, c in states[1:]:
            sums, counts = sums.unionByName(s), counts.unionByName(c)
        sums = sums.groupBy(*self.keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n", *self.sums)]).filter("n <> 0")
        counts = counts.groupBy(*self.keys, *COUNTED).agg(F.sum("n").cast("bigint").alias("n")).filter("n <> 0")
        return sums, counts

    def rows(self, state: tuple[DataFrame, DataFrame], modes: Sequence[str], medians: Sequence[str]) -> DataFrame:
        """The sums with, per key, the most frequent value of each kind of
        ``modes`` (ties: the smallest) and the median of each of ``medians``."""
        sums, counts = state
        picks = {kind: F.min(F.when(F.col("kind") == kind, F.struct((-F.col("n")).alias("m"), F.col(self.counted[kind][0]).alias("v")))).getField("v") for kind in modes}
        middles = {kind: F.expr(f"percentile(CASE WHEN kind = '{kind}' THEN num END, 0.5, n)") for kind in medians}
        out = sums
        # Each reads the entries of its kinds only: the medians' aggregate keeps a
        # map per key, which would else hold up the modes' many entries.
        for figures in (picks, middles):
            if figures:
                mine = counts.filter(F.col("kind").isin(list(figures))).groupBy(*self.keys).agg(*[f.alias(kind) for kind, f in figures.items()])
                out = out.join(mine, list(self.keys), "left")
        return out


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows of ``after`` that are new or differ from ``before`` in ``values``:
    ``keys``, ``new_*``, ``old_*`` and ``known`` (there is an old image)."""
    old = before.select(*keys, *[F.col(v).alias(f"old_{v}") for v in values], F.lit(True).alias("known"))
    j = after.select(*keys, *[F.col(v).alias(f"new_{v}") for v in values]).join(old, list(keys), "left")
    same = F.col("known").isNotNull()
    for v in values:
        same = same & F.col(f"old_{v}").eqNullSafe(F.col(f"new_{v}"))
    return j.filter(~same).withColumn("known", F.col("known").isNotNull())


def image(changed: DataFrame, side: str, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One side (``old`` or ``new``) of changed rows."""
    rows = changed.filter("known") if side == "old" else changed
    return rows.select(*keys, *[F.col(f"{side}_{v}").alias(v) for v in values])
