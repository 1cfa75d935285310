"""Prefix trie of conversations, rolled up by depth bands.

A node is a distinct sequence of first turns; its members are the
conversations that start with it.  A conversation's path is cut into bands of
``HEIGHT`` depths, one row per conversation and band, so no array outgrows a
band and no conversation has to lie in one task.

* *Node keys.*  Inside a band each prefix is an MD5 chain over its turns.  A
  full band ends in one digest; those digests are a sequence again, 1/HEIGHT as
  long, whose prefix keys come from the same step.  A node's key joins the key
  of the bands before it with its place in its own band.  Equal keys at one
  depth mean equal prefixes (128-bit digests).
* *Ownership.*  The smallest member of a node names it, so (smallest member,
  depth) identifies a node, and the owner's own path holds all its ancestors.
* *Depth-band rollup.*  A node's values go to its ancestors inside its band
  only (summed along the owner's path first, so a band row gives at most HEIGHT
  rows).  That completes every band root for its own band.  The band roots form
  a tree that is 1/HEIGHT as deep and is rolled up in the same way; the totals
  of its nodes then go down to the HEIGHT ancestors of the band above.  A trie
  of depth D takes log(D) / log(HEIGHT) levels, and no level explodes a row
  more than HEIGHT times.

All sums are combined on the map side, so a first turn or a conversation that
a third of all rows share costs a partial row per task.  A parent with more
than 1/``HOT_SHARE`` of all nodes as children is broadcast to them (there are
fewer than ``HOT_SHARE`` such parents); the others are joined by key.  The ids
of the conversations that end at a node are gathered in blocks of at most
``ID_BLOCK`` ids, and the digest reads a node's blocks in order, one at a time.

Edge cases: rows without a conversation id belong to no conversation and are
left out; a null turn comes first; equal turns are ordered by role and text (in
UTF-8 order), repeated rows are turns of their own; null roles and texts are
empty; an empty table has no conversation and so no node, not even a root;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

HEIGHT = 16
HOT_SHARE = 1000
ID_BLOCK = 4096
#: A rebuilt conversation takes its first turns from the first one of its block.
BLOCK, MOST_SHARED = 20, 4


def _chained(before: Column, turn: Column) -> Column:
    return F.unhex(F.md5(F.concat(before, turn)))


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def turns_in_place(conversations: DataFrame) -> DataFrame:
    """(conv, part, i, turn, words) of every turn: its place ``i`` in its
    conversation, a digest of role and text, and the text's words.

    The turns are sorted over all partitions and written once; a conversation
    may span many of them, and its places are counted from the numbers of its
    turns per partition.
    """
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"),
        F.col("turn").alias("at"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("spread"),  # parts even rows that are equal
    )
    order = [F.col("conv"), F.col("at").asc_nulls_first(), F.col("role"), F.col("text"), F.col("spread")]
    turn = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    ordered = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("pos"),
            F.unhex(F.md5(turn)).alias("turn"),
            _words(F.col("text")).alias("words"),
        ),
        "trie-turns",
    )
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        ordered.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    )
    return ordered.join(parts, ["conv", "part"]).select(
        "conv", "part", (F.col("before") + F.col("pos") - F.col("first")).alias("i"), "turn", "words"
    )


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv, length, depth, turn, words): every conversation rebuilt from
    the first h turns of its block's first one (h = CRC-32 of its id, modulo
    4) and its own turns after its first h; depth 0 is the textless root."""
    turns = written(turns_in_place(conversations), "trie-places")
    shared = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(MOST_SHARED)).cast("int")
    heads = turns.filter(F.col("i") < MOST_SHARED - 1).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("i", "turn", "words"))).alias("head"))
    parts = turns.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    convs = parts.groupBy("conv").agg(F.sum("n").alias("n")).withColumn("h", shared)
    convs = (
        convs.withColumn("base", F.col("conv") - F.col("conv") % BLOCK)
        .join(heads.withColumnRenamed("conv", "base"), "base", "left")
        .withColumn("head", F.when(F.col("head").isNull(), F.expr("array()")).otherwise(F.expr("slice(head, 1, h)")))
        .withColumn("took", F.size("head"))
        .withColumn("length", F.col("took") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    convs = written(convs.select("conv", "h", "head", "took", "length"), "trie-conversations")
    nothing = F.unhex(F.lit(""))
    root = convs.select("conv", "length", F.lit(0).cast("bigint").alias("depth"), nothing.alias("turn"), F.lit(0).cast("bigint").alias("words"))
    taken = convs.select("conv", "length", F.posexplode("head").alias("i", "x")).select(
        "conv", "length", (F.col("i") + 1).cast("bigint").alias("depth"), "x.turn", "x.words")
    # A long conversation meets its row of ``convs`` once per partition, not once per turn.
    placed = parts.select("conv", "part").join(convs.select("conv", "h", "took", "length"), "conv")
    own = turns.join(placed, ["conv", "part"]).filter(F.col("i") >= F.col("h")).select(
        "conv", "length", (F.col("took") + F.col("i") - F.col("h") + 1).cast("bigint").alias("depth"), "turn", "words")
    return root.unionByName(taken).unionByName(own)


def _keyed(bands: DataFrame, top: int) -> DataFrame:
    """``bands`` (conv, band, turns) with ``keys``: the key of the prefix that
    ends at each place of the band.  ``top`` is the largest band."""
    chain = F.aggregate(
        "turns", F.array(F.unhex(F.lit(""))), lambda acc, x: F.concat(acc, F.array(_chained(F.element_at(acc, -1), x)))
    )
    inner = bands.withColumn("inner", F.slice(chain, 2, HEIGHT))
    if top == 0:
        return inner.withColumnRenamed("inner", "keys")
    full = inner.filter(F.size("inner") == HEIGHT).select("conv", F.col("band").alias("depth"), F.element_at("inner", -1).alias("turn"))
    above = _keyed(_banded(full), top // HEIGHT)
    heads = above.select("conv", F.col("band").alias("up"), F.posexplode("keys").alias("j", "head")).select(
        "conv", (F.col("up") * HEIGHT + F.col("j") + 1).alias("band"), "head")
    return inner.join(heads, ["conv", "band"], "left").withColumn(
        "keys", F.when(F.col("head").isNull(), F.col("inner")).otherwise(F.transform("inner", lambda x: _chained(F.col("head"), x)))
    ).drop("inner", "head")


def _banded(rows: DataFrame) -> DataFrame:
    """One row per conversation and band, with its turns in order."""
    return (
        rows.groupBy("conv", (F.floor(F.col("depth") / HEIGHT)).alias("band"))
        .agg(F.sort_array(F.collect_list(F.struct("depth", "turn"))).alias("r"))
        .select("conv", "band", F.col("r.turn").alias("turns"))
    )


def _totals(paths: DataFrame, nodes: DataFrame, top: int) -> DataFrame:
    """(key, leaves, saved) summed over each node's subtree.  ``paths``: (conv,
    band, keys); ``nodes``: (key, conv, band, slot, leaves, saved) under the
    node's owner."""
    held = nodes.groupBy("conv", "band").agg(F.collect_list(F.struct("slot", "leaves", "saved")).alias("held"))

    def below(name: str, slot: Column) -> Column:
        return F.aggregate("held", F.lit(0).cast("bigint"), lambda s, v: s + F.when(v["slot"] >= slot, v[name]).otherwise(F.lit(0).cast("bigint")))

    up = paths.join(held, ["conv", "band"]).select(F.explode(F.transform(
        "keys", lambda k, slot: F.struct(k.alias("key"), below("leaves", slot).alias("leaves"), below("saved", slot).alias("saved")))).alias("x"))

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    inside = summed(up.select("x.*"))
    if top == 0:
        return inside
    inside = written(inside, "trie-bands")
    high = paths.select("conv", F.col("band").alias("depth"), F.element_at("keys", 1).alias("turn"))
    high = _banded(high).withColumnRenamed("turns", "keys")
    roots = nodes.filter("slot = 0").select("key", "conv", "band").join(inside, "key")
    roots = written(roots, "trie-roots")
    lifted = roots.select(
        "key", "conv", F.floor(F.col("band") / HEIGHT).alias("band"), (F.col("band") % HEIGHT).cast("int").alias("slot"), "leaves", "saved")
    whole = _totals(high, lifted, top // HEIGHT)
    over = roots.filter("band > 0").select("key", "conv", (F.col("band") - 1).alias("band")).join(whole, "key").drop("key")
    passed = paths.join(over, ["conv", "band"]).select(F.explode("keys").alias("key"), "leaves", "saved")
    return summed(inside.unionByName(passed))


def _digests(batches):
    """SHA-256 of each key's blocks of ids, which come sorted."""
    import pandas as pd

    key = digest = None
    for batch in batches:
        out = []
        for k, ids in zip(batch["key"], batch["ids"]):
            if k != key:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pd.DataFrame(out, columns=["key", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "ends_sha256"])


def trie(rows: DataFrame) -> DataFrame:
    """The trie over ``rows`` (conv, length, depth, turn, words), one per
    conversation and depth 0 to its length: (conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node."""
    rows = written(rows, "trie-rows")
    longest = rows.agg(F.max("length")).first()[0] or 0
    top = longest // HEIGHT
    keyed = _keyed(_banded(rows), top)
    more = rows.groupBy("conv", (F.floor(F.col("depth") / HEIGHT)).alias("band"), "length").agg(
        F.sort_array(F.collect_list(F.struct("depth", "words"))).alias("w"))
    paths = written(keyed.join(more, ["conv", "band"]).select("conv", "band", "length", "keys", F.col("w.words").alias("words")), "trie-paths")

    ends = paths.filter(F.col("band") == F.floor(F.col("length") / HEIGHT)).select(F.element_at("keys", -1).alias("key"), "conv")
    blocks = ends.groupBy("key", F.floor(F.col("conv") / ID_BLOCK).alias("block")).agg(
        F.concat_ws(",", F.sort_array(F.collect_list("conv")).cast("array<string>")).alias("ids"))
    digests = blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInPandas(_digests, "key binary, ends_sha256 string")

    last = paths.select("conv", (F.col("band") + 1).alias("band"), F.element_at("keys", -1).alias("before"))
    linked = paths.join(last, ["conv", "band"], "left") if top else paths.withColumn("before", F.lit(None).cast("binary"))
    flat = linked.select("conv", "band", "before", "keys", F.posexplode(F.arrays_zip("keys", "words")).alias("slot", "x")).select(
        "conv", "band", "slot", F.col("x.keys").alias("key"), F.col("x.words").alias("words"),
        F.when(F.col("slot") == 0, F.col("before")).otherwise(F.expr("keys[slot - 1]")).alias("parent"))
    nodes = flat.groupBy("key", "parent", "band", "slot", "words").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"))
    nodes = written(nodes, "trie-nodes")
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))), "trie-children")

    valued = nodes.select(
        "key", "conv", "band", "slot", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = _totals(paths.select("conv", "band", "keys"), valued, top)

    hot = F.col("n_children") * HOT_SHARE > nodes.count()
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"), hot.alias("hot"))
    many = parents.filter("hot").drop("hot")  # fewer than HOT_SHARE rows: their children are distinct nodes
    seen = nodes.join(F.broadcast(many), "parent", "left")
    settled = F.col("parent").isNull() | F.col("parent_conv_id").isNotNull()
    rest = seen.filter(~settled).drop("parent_conv_id").join(parents.filter("NOT hot").drop("hot"), "parent")
    return (
        seen.filter(settled).unionByName(rest)
        .join(totals, "key")
        .join(digests, "key", "left")
        .select(
            F.col("conv").alias("conv_id"),
            (F.col("band") * HEIGHT + F.col("slot")).alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )


# CRC-32 of a decimal number, bit by bit over its characters.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))))"""

ORACLE = f"""
WITH own AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce("text", '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, t, {_CRC} % {MOST_SHARED} AS h FROM own),
whole AS (SELECT h.c, list_concat(coalesce(b.t, [])[1:h.h], h.t[h.h + 1:]) AS p
  FROM h LEFT JOIN own b ON b.c = h.c - h.c % {BLOCK}),
member AS (SELECT c, p[1:d] AS k, d, d = len(p) AS ends FROM whole, unnest(range(0, len(p) + 1)) AS u(d)),
node AS (SELECT k, d, min(c) AS rep, count(*) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS e,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(k[d].t, '[^\\x20\\x09-\\x0D]+')) END AS w
  FROM member GROUP BY k, d),
kids AS (SELECT a.k, a.d, count(b.k) AS kids FROM node a LEFT JOIN node b ON b.d = a.d + 1 AND b.k[1:a.d] = a.k GROUP BY a.k, a.d),
v AS (SELECT n.*, kids.kids FROM node n JOIN kids ON kids.d = n.d AND kids.k = n.k)
SELECT a.rep AS conv_id, a.d AS depth, any_value(p.rep) AS parent_conv_id, any_value(a.n) AS n_convs, any_value(a.kids) AS n_children,
  count(*) FILTER (s.kids = 0) AS n_leaves, CAST(sum((s.n - 1) * s.w) AS BIGINT) AS saved_tokens, any_value(a.e) AS ends_sha256
FROM v a JOIN v s ON s.d >= a.d AND s.k[1:a.d] = a.k LEFT JOIN v p ON p.d = a.d - 1 AND p.k = a.k[1:p.d]
GROUP BY a.rep, a.d
"""
