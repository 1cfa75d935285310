"""Row-level changes on plain Parquet tables, as DataFrame plans.

Parquet tables have no ``MERGE``/``UPDATE``; every operator here returns the
*new table state* as a DataFrame.  ``write_version`` then writes it to a new
directory (never over the one being read); ``upsert_version`` replaces the
touched parts of a versioned table (``operators/versions``).

* ``insert_absent``  - null-aware ``INSERT … WHERE k NOT IN (SELECT k …)``
* ``upsert``         - type-1 ``MERGE`` on a natural key with surrogate keys
* ``update_from``    - ``UPDATE … FROM``: left join + ``coalesce``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import TABLE_CODEC
from .keys import dense_keys
from .versions import DEALT, Pointer, Versions, parts_of


def not_in(source: DataFrame, probe_key: str, target: DataFrame, target_key: str) -> DataFrame:
    """Rows of ``source`` whose ``probe_key`` is NOT IN ``target.target_key``.

    SQL three-valued semantics without Catalyst's null-aware anti join, which
    is always broadcast (unsafe for a large dimension):

    * a null in the target list -> no row qualifies;
    * empty target -> every row qualifies, null probe keys included;
    * otherwise -> non-null probe keys absent from the target (shuffle or
      broadcast anti join, as AQE decides from the runtime size).

    The first two cases are decided from one aggregate row.
    """
    stats = target.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(target_key).isNull()).alias("n_null")
    ).first()
    if stats["n_null"] > 0:
        return source.limit(0)
    if stats["n"] == 0:
        return source
    keys = target.select(F.col(target_key).alias("_ni_k"))
    return source.filter(F.col(probe_key).isNotNull()).join(
        keys, F.col(probe_key) == F.col("_ni_k"), "left_anti"
    )


def insert_absent(
    target: DataFrame, source: DataFrame, key: str, aggs: Sequence[Column]
) -> DataFrame:
    """Target plus one row per absent key of ``source`` (``aggs`` per key).

    ``aggs`` choose the attribute when a key arrives with several values
    (one row per key instead of one per (key, attribute)).
    """
    absent = not_in(source, key, target, key)
    new_rows = absent.groupBy(key).agg(*aggs)
    return target.unionByName(new_rows.select(*target.columns))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    surrogate: str,
    load_col: str | None = None,
    load_ts: Column | None = None,
    key_start: int | None = None,
    touch_unchanged: bool = True,
) -> DataFrame:
    """Type-1 merge of ``source`` into ``target`` on natural ``keys``.

    ``source`` must hold one row per key (see ``keys.keep_last``).  A source row
    with a null key is left out: null keys never match in SQL, so it would be
    inserted again by every run (``quality.null_keys`` reports such rows).  Matched rows take the source's
    attributes and a new ``load_ts``; unmatched source rows get surrogate keys
    continuing after ``max(target.surrogate)`` in natural-key order; target
    rows not in the source are kept unchanged.  ``key_start`` overrides the
    first new key when ``target`` is only a slice of the table (see
    ``upsert_version``).  ``touch_unchanged=True`` stamps every matched
    row with ``load_ts`` (what ``MERGE … WHEN MATCHED THEN UPDATE`` does);
    ``False`` keeps the old load time when no attribute changed, so a later
    high-water-mark delta only carries real changes.
    """
    attrs = [c for c in target.columns if c not in (*keys, surrogate) and c != load_col]
    named = F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()
    s = source.filter(named).select(*keys, *attrs)
    mine = s.select(*keys, *[F.col(a).alias(f"_s_{a}") for a in attrs], F.lit(True).alias("_s"))
    kept = target.join(mine, list(keys), "left")
    merged_cols = [F.when(F.col("_s").isNotNull(), F.col(f"_s_{a}")).otherwise(F.col(a)).alias(a) for a in attrs]
    if load_col:
        stamp = F.col("_s").isNotNull()
        if not touch_unchanged:
            same = F.lit(True)
            for a in attrs:
                same = same & F.col(f"_s_{a}").eqNullSafe(F.col(a))
            stamp = stamp & ~same
        merged_cols.append(F.when(stamp, load_ts).otherwise(F.col(load_col)).alias(load_col))
    kept = kept.select(*keys, surrogate, *merged_cols)
    new = s.join(target.select(*keys), list(keys), "left_anti")
    if load_col:
        new = new.withColumn(load_col, load_ts)
    if key_start is None:
        key_start = (target.agg(F.max(surrogate)).first()[0] or 0) + 1
    new_keyed = dense_keys(new, list(keys), surrogate, start=key_start)
    return kept.unionByName(new_keyed).select(*target.columns)


def upsert_version(
    store: Versions,
    table: str,
    schema,
    source: DataFrame,
    keys: Sequence[str],
    surrogate: str,
    part: Column,
    load_col: str,
    load_ts: Column,
    touch_unchanged: bool = True,
) -> Pointer:
    """``upsert`` of a versioned table that reads and writes only the parts
    the source touches; readers see the old version until the new one is whole.

    The last surrogate key is a note of the pointer, so no scan looks for it;
    the new one comes from the rows just written.
    """
    upon = store.current()
    parts = parts_of(source, part)
    merged = upsert(store.read(table, schema, parts, upon), source, keys, surrogate, load_col, load_ts,
                    key_start=upon.notes.get(f"last_{surrogate}", 0) + 1, touch_unchanged=touch_unchanged)
    staged = store.stage(upon, {table: (merged, part)}, parts)
    last = store.read(table, schema, parts, staged).agg(F.max(surrogate)).first()[0] or 0
    staged.notes[f"last_{surrogate}"] = max(last, upon.notes.get(f"last_{surrogate}", 0))
    return store.publish(staged)


def update_from(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """``UPDATE target SET cols = u.cols FROM updates u WHERE keys match``."""
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols], F.lit(True).alias("_u"))
    j = target.join(u, list(keys), "left")
    out = [
        F.when(F.col("_u").isNotNull(), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in target.columns
    ]
    return j.select(*out)


def by_period(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows dealt for a write that is partitioned by ``cols``: a small period
    is one file, a large one as many as the advisory partition size makes of
    it (the REBALANCE hint, from the sizes that the shuffle measured), so
    the files are about periods + bytes / target, not tasks times periods.
    ``DEALT`` shuffle partitions keep large periods apart; small ones are
    merged again at run time."""
    return df.hint("rebalance", DEALT, *[F.col(c) for c in cols])


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a new table version and return a scan of it.

    Writing cuts the lineage (a written table in the shared folder), and the
    returned scan is what later steps read.
    """
    if partition_by:
        by_period(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path, compression=TABLE_CODEC)
    else:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path, compression=TABLE_CODEC)
    # The known schema: no inference pass, and an empty version reads fine.
    return df.sparkSession.read.schema(df.schema).parquet(path)
