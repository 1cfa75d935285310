"""Sharding over fixed virtual slots.

Every record hashes into one of ``n_slots`` virtual slots.  Bytes and rows
are aggregated per slot (at most ``n_slots`` rows, whatever the input), and a
versioned slot-to-shard map says which shard holds a slot.  Version 0 deals
the slots round robin; ``rebalance`` edits a map into the next version by
moving single slots (or exchanging two) between the heaviest and the lightest
shard until their bytes are near equal, so that a rebalanced record moves
only when its slot does.  ``save_map`` and ``load_map`` keep all versions as
a Parquet table; ``assign`` takes the map in force from there, places the
records by its edit and stores that as the next version.

A record's slot is decided by its id.  An id with more than 1/``n_slots`` of all
rows (null included) is dealt over the slots by id and text, and an (id, text)
pair with more than that by a row number that is written once; at most
``n_slots`` of either can exist, so their list is broadcast.  So no slot holds
much more than a hundredth of a shard, whatever repeats.

A record's number in its shard (``slot_in_shard``, gapless from 0) is the
number of rows in the earlier slots of the shard plus its number in its own
slot, so no task ever sorts more than one slot.

Edge cases: a null text has no bytes, CRC 0 and the fixed overhead as its
size; null ids hash like any other value and come first in their slot;
repeated rows land in one slot and take consecutive numbers unless they are
more than 1/``n_slots`` of all; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import written

N_SLOTS = 8192
ROW_OVERHEAD = 16


def slot_of(key: Column, n_slots: int = N_SLOTS) -> Column:
    """The virtual slot of a record, decided by its key alone."""
    return F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int")


def initial_map(n_shards: int, n_slots: int = N_SLOTS) -> list[int]:
    """Version 0: slot number -> shard, dealt round robin."""
    return [s % n_shards for s in range(n_slots)]


def rebalance(slot_map: list[int], slot_bytes: dict[int, int], n_shards: int, spread: float = 0.001) -> list[int]:
    """The next version of a slot map.

    Edits are made while the heaviest shard exceeds the lightest by more
    than ``spread`` of a mean shard: the slot, or the exchange of two slots,
    that comes nearest to halving their difference.  Each edit shrinks the sum
    of squared shard sizes, so the loop ends.  The work depends on the number
    of slots, a constant, and not on the data.
    """
    out = list(slot_map)
    held: list[dict[int, int]] = [{} for _ in range(n_shards)]
    for slot, shard in enumerate(out):
        if slot_bytes.get(slot):
            held[shard][slot] = slot_bytes[slot]
    load = [sum(h.values()) for h in held]
    mean = sum(load) / n_shards
    for _ in range(4 * len(out)):
        light = min(range(n_shards), key=load.__getitem__)
        edit = None
        # The heaviest shard may be one slot that cannot move; try the next.
        for heavy in sorted(range(n_shards), key=load.__getitem__, reverse=True):
            gap = load[heavy] - load[light]
            if gap <= spread * mean:
                break
            swaps = sorted((b, s) for s, b in held[light].items())
            best = (gap / 2, None, None)
            for s, b in held[heavy].items():
                if abs(b - gap / 2) < best[0]:
                    best = (abs(b - gap / 2), s, None)
                lo, hi = 0, len(swaps)  # the partner whose size is nearest to b - gap / 2
                while lo < hi:
                    mid = (lo + hi) // 2
                    lo, hi = (mid + 1, hi) if swaps[mid][0] < b - gap / 2 else (lo, mid)
                for other, t in swaps[max(0, lo - 1) : lo + 1]:
                    if abs(b - other - gap / 2) < best[0]:
                        best = (abs(b - other - gap / 2), s, t)
            if best[1] is not None:
                edit = (heavy, best[1], best[2])
                break
        if edit is None:
            break
        heavy, s, t = edit
        for slot, a, b in ((s, heavy, light), *(((t, light, heavy),) if t is not None else ())):
            size = held[a].pop(slot)
            held[b][slot] = size
            load[a] -= size
            load[b] += size
            out[slot] = b
    return out


def map_column(slot_map: list[int], slot: Column) -> Column:
    """The shard of a slot; the map is one constant of ``n_slots`` numbers."""
    table = F.split(F.lit(",".join(map(str, slot_map))), ",").cast("array<int>")
    return F.element_at(table, slot + 1)


def save_map(spark, path: str, version: int, slot_map: list[int]) -> None:
    """Append one version of a slot map to the Parquet table at ``path``."""
    slots = spark.range(len(slot_map)).select(F.lit(version).alias("version"), F.col("id").cast("int").alias("slot"))
    slots.withColumn("shard", map_column(slot_map, F.col("slot"))).coalesce(1).write.mode("append").parquet(path)


def saved_versions(spark, path: str) -> list[int]:
    """The versions stored at ``path``, none where there is no table yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return []
    return [r[0] for r in spark.read.parquet(path).select("version").distinct().orderBy("version").collect()]


def load_map(spark, path: str, version: int | None = None) -> list[int]:
    """One version of a saved slot map, the newest unless named."""
    saved = spark.read.parquet(path)
    if version is None:
        version = saved.agg(F.max("version")).first()[0]
    rows = saved.filter(F.col("version") == version).orderBy("slot").select("shard").collect()  # n_slots rows
    return [r[0] for r in rows]


def _dealt(recs: DataFrame, n_slots: int) -> DataFrame:
    """``recs`` (doc_id, size, text_crc32, row) with their virtual slot."""
    total = recs.count()

    def frequent(*keys: str) -> DataFrame:
        found = recs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * n_slots > total)
        return F.broadcast(found.select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_hot_" + keys[-1])))

    ids, texts = frequent("doc_id"), frequent("doc_id", "text_crc32")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    by_id = recs.join(ids, same, "left").drop("_doc_id")
    by_text = by_id.join(texts, same & (F.col("text_crc32") == F.col("_text_crc32")), "left").drop("_doc_id", "_text_crc32")
    slot = (
        F.when(F.col("_hot_text_crc32"), slot_of(F.struct("doc_id", "text_crc32", "row"), n_slots))
        .when(F.col("_hot_doc_id"), slot_of(F.struct("doc_id", "text_crc32"), n_slots))
        .otherwise(slot_of(F.col("doc_id"), n_slots))
    )
    return by_text.select("doc_id", "size", "text_crc32", slot.alias("virtual_slot"))


def assign(
    docs: DataFrame,
    n_shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    n_slots: int = N_SLOTS,
    map_path: str | None = None,
) -> tuple[DataFrame, str]:
    """(rows with shard and number in it, the path of the slot map's versions).

    The newest map at ``map_path`` is in force (version 0, dealt round robin,
    where there is none yet); its rebalanced edit is stored as the next version
    and places the rows.
    """
    spark = docs.sparkSession
    path = map_path or os.path.join(ensure_checkpoint_dir(spark), "martkit-llm", f"slot-map-{uuid.uuid4().hex}")
    raw = F.encode(F.col(text_col).cast("string"), "UTF-8")
    numbered = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(raw), F.lit(0)).cast("bigint") + ROW_OVERHEAD).alias("size"),
            F.coalesce(F.crc32(raw), F.lit(0).cast("bigint")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-records",
    )
    recs = written(_dealt(numbered, n_slots), "shard-slots")
    per_slot = recs.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    stats = {r["virtual_slot"]: (r["b"], r["n"]) for r in per_slot.collect()}  # n_slots rows at most
    if not saved_versions(spark, path):
        save_map(spark, path, 0, initial_map(n_shards, n_slots))
    version = max(saved_versions(spark, path))
    save_map(spark, path, version + 1, rebalance(load_map(spark, path, version), {s: b for s, (b, _) in stats.items()}, n_shards))
    after = load_map(spark, path)

    first, filled = [], [0] * n_shards  # rows of the shard in earlier slots
    for slot, shard in enumerate(after):
        first.append(filled[shard])
        filled[shard] += stats.get(slot, (0, 0))[1]
    starts = F.split(F.lit(",".join(map(str, first))), ",").cast("array<bigint>")
    within = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    placed = recs.withColumn("_n", within).select(
        "doc_id",
        "size",
        "text_crc32",
        map_column(after, F.col("virtual_slot")).alias("shard"),
        (F.element_at(starts, F.col("virtual_slot") + 1) + F.col("_n") - 1).alias("slot_in_shard"),
        "virtual_slot",
    )
    return placed, path
