"""Similarity self-join of word n-gram sets by chosen paths.

Sets of distinct ``n``-word shingles with Jaccard similarity of at least
``threshold`` are linked.  Equal sets are one member from the start (with a
count), so copies are never compared.  The join then has two parts.

*Candidates.*  A set is embedded as ``width`` MinHash tokens (i, h_i).  In
every run a set starts at the root; at a node one or two coordinates are
sampled (1 / threshold on average, decided by the node alone) and the set
follows the child of each sampled token, so two sets with similarity s stay
together in s / threshold children a level.  Nodes with at most ``small`` sets
are compared by brute force on their sketches; larger nodes are split again.
Before that each set of a large node is compared with one pivot: by
the triangle inequality of the Jaccard distance, a set that is close to the
pivot has all its partners in the pivot's component and needs no further
search, so that a crowd of near copies is not carried down.  This goes on until
every node is small, or comparing all sets of the nodes that are not takes at
most ``COMPARED`` comparisons a set of the input; these nodes are then
brute-forced in pairs of blocks, which costs in proportion to the input.  From
level ``depth`` on every node samples two coordinates, so the chance that a pair
stays together does not fall to nothing however deep the recursion gets.  Where
a level no longer shrinks what is large (sets that agree in all that is sampled
without being close) blocks are all that is left.  Runs are repeated until a pair at the
threshold meets with probability ``recall`` at any depth (`runs_needed`).
Nothing is capped.

*Links.*  The sketch bound is generous, so linked sets are in one candidate
component.  Inside a component all pairs are compared exactly: a large
component is dealt into classes of set size (linked sets are in one class or
in neighbouring ones) and blocks of bounded weight, and each pair of blocks
is one unit of work.  A unit gives each member's number of links and a
spanning forest of them, never the pairs.

The result has a row per document: ``class_id`` (smallest id of its connected
class), ``class_size`` and ``n_links`` (documents, copies included, that are
similar to it).

Shingles are of lower-case words (split at ASCII white space); a text with
fewer than ``n`` words is one shingle.  Edge cases: null and empty texts have
no shingle, equal one another and nothing else; null ids are kept and have
the class id of their class's other members, or null; repeated rows are
copies; ties cannot occur (class ids are minima); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Remembered, give_back, in_runs, kept_alone
from .common import written

N = 5
THRESHOLD = 0.8
WIDTH = 128
SMALL = 100
DEPTH = 4
COMPARED = 100
RECALL = 0.9999
#: Sketch similarity from which sets are candidates; from which a set is close
#: to a pivot; and from which it gets an edge to the pivot.  A partner of a
#: close set has a Jaccard similarity of 0.55 or more to the pivot.  The
#: standard error of a sketch is 0.035 at 0.8 and 0.044 at 0.55.
LOOSE, CLOSE = 0.62, 0.75
PIVOT_LOOSE = 0.4
#: Shingles and sets that a block holds at most on average.
BLOCK_WEIGHT, BLOCK_SETS = 1_000_000, 512

_MASK = (1 << 64) - 1


def runs_needed(recall: float, threshold: float, depth: int) -> int:
    """Runs until a pair at the threshold meets, however deep the small
    nodes lie: a pair stays together for ever below level ``depth``, where all
    nodes sample two coordinates, with the chance m = 1 - (1 - t m)**2."""
    two = 1 / threshold - 1  # share of nodes that sample two coordinates
    meet = (2 * threshold - 1) / threshold**2
    for _ in range(depth):
        miss = 1 - threshold * meet
        meet = 1 - ((1 - two) * miss + two * miss * miss)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


# --- shingles and sketches -------------------------------------------------


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, n: int):
        self.n = n
        self.known = Remembered(xxhash.xxh3_64_digest, 50_000)

    def set_of(self, text: str) -> np.ndarray:
        return self._shingles(np.frombuffer(self.known.joined(text.lower().encode("utf-8").split()), np.uint64))

    def _shingles(self, w: np.ndarray) -> np.ndarray:
        if not len(w):
            return w
        n = min(self.n, len(w))
        h = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - n + 1 + i]
            h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return np.unique(h)


def _coefficients(width: int) -> tuple[np.ndarray, np.ndarray]:
    g = np.random.default_rng(20_240_501)
    return g.integers(0, 1 << 31, width, np.uint32) * np.uint32(2) + np.uint32(1), g.integers(0, 1 << 32, width, np.uint32)


def minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 8192):
        np.minimum(best, (a[:, None] * x[None, at : at + 8192] + b[:, None]).min(axis=1), out=best)
    return best


def _first_picks(runs: int, width: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, coordinate, coordinate below it) of the nodes two levels below
    the roots.  Each node samples one coordinate, or two of them as often as
    makes 1 / threshold on average."""
    g = np.random.default_rng(7)
    two = 1 / threshold - 1
    picks, nodes = [], 0

    def sampled():
        nonlocal nodes
        nodes += 1
        return g.choice(width, 2 if nodes * two % 1 < two else 1, replace=False)

    for r in range(runs):
        picks += [(r, c, below) for c in sampled() for below in sampled()]
    run, at, below = np.array(picks).T
    return run.astype(np.uint64), at, below


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def node_ids(h: np.ndarray, run: np.ndarray, at: np.ndarray, below: np.ndarray) -> np.ndarray:
    """The paths that a set with MinHash tokens ``h`` follows."""
    x = _mixed((run * np.uint64(0xC2B2AE3D27D4EB4F)) ^ ((at.astype(np.uint64) << np.uint64(32)) | h[at]))
    return _mixed(x ^ ((below.astype(np.uint64) << np.uint64(32)) | h[below])).view(np.int64)


_SKETCH = "doc_id bigint, th bigint, sethash binary, n_shingles bigint, sketch binary, nodes array<bigint>"


def _sketches(batches: Iterator[pd.DataFrame], n: int, width: int, runs: int, threshold: float) -> Iterator[pd.DataFrame]:
    shingler = kept_alone(("shingles", n), lambda: Shingler(n))
    a, b = _coefficients(width)
    run, at, below = _first_picks(runs, width, threshold)
    for batch in batches:
        texts = batch["text"].tolist()
        for lo, hi in in_runs(texts, 1_000_000):
            rows = []
            for s in map(shingler.set_of, texts[lo:hi]):
                sketch, nodes = b"", []
                if len(s):
                    h = minhash(s, a, b)
                    sketch = ((h * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()
                    nodes = node_ids(h, run, at, below)
                rows.append((xxhash.xxh3_128_digest(s.tobytes()), len(s), sketch, nodes))
            part = batch.iloc[lo:hi]
            out = pd.DataFrame(rows, columns=["sethash", "n_shingles", "sketch", "nodes"])
            out.insert(0, "th", part["th"].to_numpy())
            out.insert(0, "doc_id", part["doc_id"].array)
            yield out
    give_back()


# --- brute force in small nodes ----------------------------------------------


def _forest(pairs_a: np.ndarray, pairs_b: np.ndarray, size: int) -> np.ndarray:
    """The smallest position of each position's component."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[pairs_a], root[pairs_b])
        new = root.copy()
        np.minimum.at(new, pairs_a, low)
        np.minimum.at(new, pairs_b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The groups of rows in batches that are sorted by ``key``."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        values = batch[key].to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        starts = [0, *cuts]
        for lo, hi in zip(starts[:-1], starts[1:], strict=True):
            yield batch.iloc[lo:hi]
        rest = batch.iloc[starts[-1] :] if len(batch) else rest
    if rest is not None and len(rest):
        yield rest


def _similar_sketches(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions a < b of sketches that agree in enough places."""
    need = least * x.shape[1]
    found_a, found_b = [], []
    for i in range(len(x) - 1):
        same = np.count_nonzero(x[i + 1 :] == x[i], axis=1)
        hit = np.flatnonzero(same >= need)
        found_a.append(np.full(len(hit), i))
        found_b.append(hit + i + 1)
    return np.concatenate(found_a or [np.empty(0, int)]), np.concatenate(found_b or [np.empty(0, int)])


def _brute(batches: Iterator[pd.DataFrame], width: int, least: float) -> Iterator[pd.DataFrame]:
    """A spanning forest of the candidates of each node."""
    held: list[tuple] = []
    known: set = set()
    for g in _groups(batches, "node"):
        ids = g["rep"].to_numpy()
        x = np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(len(g), width)
        a, b = _similar_sketches(x, least)
        if len(a):
            root = _forest(a, b, len(g))
            for i in np.flatnonzero(root != np.arange(len(g))):
                e = (int(ids[root[i]]), int(ids[i]))
                if e[0] != e[1] and e not in known:
                    known.add(e)
                    held.append(e)
        if len(held) >= 20_000:
            yield pd.DataFrame(held, columns=["a", "b"])
            held, known = [], set()
    yield pd.DataFrame(held, columns=["a", "b"]).astype("int64")
    give_back()


def _by_pivot(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for g in batches:
        x = np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(-1, width)
        y = np.frombuffer(b"".join(g["pivot_sketch"]), np.uint8).reshape(-1, width)
        yield g.assign(likeness=(x == y).mean(axis=1) if len(g) else 0.0)


def _brute_nodes(rows: DataFrame, width: int, least: float) -> DataFrame:
    dealt = rows.select("node", "rep", "sketch").repartition("node").sortWithinPartitions("node", "rep")
    return dealt.mapInPandas(lambda it: _brute(it, width, least), "a bigint, b bigint")


def _children(rows: DataFrame, width: int, share: float) -> DataFrame:
    """The next level below the nodes of ``rows``, of which the ``share``
    samples two coordinates."""

    def child(k: int):
        at = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(width)).cast("int")
        return F.xxhash64("node", at, F.substring("sketch", at + 1, F.lit(1)))

    second = F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(1000)) < int(1000 * share)
    nodes = F.when(second, F.array_distinct(F.array(child(0), child(1)))).otherwise(F.array(child(0)))
    return rows.select("rep", "sketch", F.explode(nodes).alias("node"))


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """Rows of the nodes with two sets or more, with their number."""
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return written(rows.join(sizes, "node"), name)


def _pivoted(large: DataFrame, width: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(edges, rest): each large node's sets against the node's first set.

    A set close to the pivot is done: all its partners get an edge to the
    pivot as well (triangle inequality).  The rest is to be searched further.
    """
    pivots = large.groupBy("node").agg(F.min("rep").alias("pivot"))
    sketch = large.select("node", F.col("rep").alias("pivot"), F.col("sketch").alias("pivot_sketch"))
    paired = large.select("node", "rep", "sketch").join(pivots.join(sketch, ["node", "pivot"]), "node")
    schema = "node bigint, rep bigint, sketch binary, pivot bigint, pivot_sketch binary, likeness double"
    compared = written(
        paired.select("node", "rep", "sketch", "pivot", "pivot_sketch").mapInPandas(lambda it: _by_pivot(it, width), schema).drop("pivot_sketch"),
        name,
    )
    others = compared.filter(F.col("rep") != F.col("pivot"))
    edges = others.filter(F.col("likeness") >= PIVOT_LOOSE).select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    return edges, others.filter(F.col("likeness") < CLOSE).select("node", "rep", "sketch")


def candidates(reps: DataFrame, width: int, threshold: float, small: int, depth: int) -> DataFrame:
    """(a, b): edges that connect all sets that may be linked.

    ``reps`` has ``rep``, ``sketch`` and ``nodes`` (the second level: nearly
    every child of a root would be split).
    """
    rows = reps.select("rep", "sketch", F.explode("nodes").alias("node"))
    edges, level, before, n_sets = [], 2, math.inf, reps.count()
    while True:
        level_rows = _counted(rows, f"paths-{level}")
        edges.append(_brute_nodes(level_rows.filter(F.col("size") <= small), width, LOOSE))
        large = level_rows.filter(F.col("size") > small)
        if large.isEmpty():
            return _distinct(edges)
        near, rest = _pivoted(large, width, f"pivots-{level}")
        edges.append(near)
        rest_rows = _counted(rest, f"rest-{level}")
        edges.append(_brute_nodes(rest_rows.filter(F.col("size") <= small), width, LOOSE))
        large = rest_rows.filter(F.col("size") > small)
        work = large.agg(F.sum("size")).first()[0] or 0  # comparisons that brute force would take
        if not work:
            return _distinct(edges)
        if work <= COMPARED * n_sets or level > depth and work > 0.9 * before:
            break
        before, share = work, 1 / threshold - 1 if level < depth else 1.0
        rows, level = _children(large, width, share), level + 1
    blocks = F.ceil(F.col("size") / small)
    own = F.pmod(F.xxhash64("rep", "node"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("other")
    pairs = large.select("*", own.alias("own"), other)
    node = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    edges.append(_brute_nodes(pairs.select(node.alias("node"), "rep", "sketch"), width, LOOSE))
    return _distinct(edges)


def _distinct(edges: list[DataFrame]) -> DataFrame:
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out.distinct()


# --- connected components ---------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component.

    Each pass takes the smallest label among a node's neighbours, then the
    label of that label; both are minima combined before the shuffle.  Passes
    go on until nothing changes.
    """
    both = written(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        root_of = labels.select(F.col("node").alias("b"), F.col("root").alias("seen"))
        heard = both.join(root_of, "b").groupBy("a").agg(F.min("seen").alias("seen"))
        lower = labels.join(heard.withColumnRenamed("a", "node"), "node").select(
            "node", "root", F.least("root", "seen").alias("low")
        )
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("next"))
        new = written(
            lower.join(jump, "low", "left").select("node", F.least("low", F.coalesce("next", "low")).alias("root"), F.col("root").alias("old")),
            "labels",
        )
        if new.filter(F.col("root") != F.col("old")).isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")


# --- exact links ----------------------------------------------------------------


def _linked(sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions a < b of all pairs with Jaccard of at least ``threshold``."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    owner = np.repeat(np.arange(len(sets)), sizes[order])
    values, column, count = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    width = (int(shared.sum()) + 63) // 64
    bits = np.zeros((len(sets), max(width, 1)), np.uint64)
    c = place[column[keep]]
    np.bitwise_or.at(bits, (owner[keep], c >> 6), np.uint64(1) << (c & 63).astype(np.uint64))
    n = sizes[order]
    a, b = [], []
    for i in range(len(sets) - 1):
        last = np.searchsorted(n, n[i] / threshold, side="right")  # no larger set can be linked
        if last <= i + 1:
            continue
        both = np.bitwise_count(bits[i + 1 : last] & bits[i]).sum(axis=1, dtype=np.int64)
        hit = np.flatnonzero(both >= threshold * (n[i] + n[i + 1 : last] - both) - 1e-9)
        a.append(np.full(len(hit), i))
        b.append(hit + i + 1)
    none = [np.empty(0, int)]
    x, y = order[np.concatenate(a or none)], order[np.concatenate(b or none)]
    return np.minimum(x, y), np.maximum(x, y)


_LINKS = "rep bigint, root bigint, links bigint"


def _units(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Per unit: each linked member's links and the root of its forest."""
    for g in _groups(batches, "unit"):
        g = g.drop_duplicates("rep")
        sets = [np.frombuffer(s, np.uint64) for s in g["shingles"]]
        ids, copies, side = (g[c].to_numpy() for c in ("rep", "copies", "side"))
        if len(g) < 2:
            continue
        a, b = _linked(sets, threshold)
        if len(g) and side.min() >= 0:  # only pairs across the two blocks
            across = side[a] != side[b]
            a, b = a[across], b[across]
        if not len(a):
            continue
        links = np.bincount(a, copies[b], len(g)) + np.bincount(b, copies[a], len(g))
        root = _forest(a, b, len(g))
        at = np.flatnonzero(links)
        yield pd.DataFrame({"rep": ids[at], "root": ids[root[at]], "links": links[at].astype(np.int64)})
    give_back()


def _shingle_rows(batches: Iterator[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
    shingler = kept_alone(("shingles", n), lambda: Shingler(n))
    for batch in batches:
        texts = batch["text"].tolist()
        for lo, hi in in_runs(texts, 1_000_000):
            part = batch.iloc[lo:hi].drop(columns="text")
            yield part.assign(shingles=[shingler.set_of(t).tobytes() for t in texts[lo:hi]])
    give_back()


def links(members: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """Exact links inside candidate components, as rows of ``_LINKS``.

    ``members`` has ``rep``, ``doc_id``, ``th``, ``root`` (the component),
    ``n_shingles`` and ``copies``; ``texts`` has ``doc_id``, ``th``, ``text``.
    """
    per = members.groupBy("root").agg(F.sum("n_shingles").alias("weight"), F.count(F.lit(1)).alias("sets"))
    whole = (F.col("weight") <= BLOCK_WEIGHT) & (F.col("sets") <= BLOCK_SETS)
    scale = F.when(whole, F.lit(0)).otherwise(F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(1 / threshold) + 1e-9) + 1)
    classed = members.join(per, "root").withColumn("scale", scale.cast("bigint"))
    held = classed.groupBy("root", "scale").agg(
        F.greatest(F.ceil(F.sum("n_shingles") / BLOCK_WEIGHT), F.ceil(F.count(F.lit(1)) / BLOCK_SETS)).alias("blocks")
    )
    up = held.filter("scale > 0").select("root", (F.col("scale") - 1).alias("scale"), F.col("blocks").alias("above"))
    down = held.filter("scale > 0").select("root", (F.col("scale") + 1).alias("scale"), F.col("blocks").alias("below"))
    dealt = classed.join(held.join(up, ["root", "scale"], "left").join(down, ["root", "scale"], "left"), ["root", "scale"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    zero = F.lit(0).cast("bigint")
    nothing = F.array().cast("array<struct<unit:bigint,side:int>>")

    def unit(a, b, c, d, side):
        return F.struct(F.xxhash64("root", a, b, c, d).alias("unit"), side.cast("int").alias("side"))

    scale, block, none = F.col("scale"), F.col("block"), F.lit(-1)
    same = F.transform(
        F.sequence(zero, F.col("blocks") - 1),
        lambda o: unit(scale, F.least(block, o), scale, F.greatest(block, o), F.when(o == block, none).otherwise((block > o).cast("int"))),
    )
    above = F.transform(F.sequence(zero, F.col("above") - 1), lambda o: unit(scale, block, scale + 1, o, F.lit(0)))
    below = F.transform(F.sequence(zero, F.col("below") - 1), lambda o: unit(scale - 1, o, scale, block, F.lit(1)))
    units = F.concat(same, F.coalesce(F.when(F.col("above").isNotNull(), above), nothing), F.coalesce(F.when(F.col("below").isNotNull(), below), nothing))

    right = texts.select(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"), "text")
    on = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th"))
    withtext = dealt.select("rep", "doc_id", "th", "copies", units.alias("units")).join(right, on).select("rep", "copies", "units", "text")
    sets = written(
        withtext.mapInPandas(
            lambda it: _shingle_rows(it, n), "rep bigint, copies bigint, units array<struct<unit:bigint,side:int>>, shingles binary"
        ),
        "member-sets",
    )
    spread = sets.select("rep", "copies", "shingles", F.explode("units").alias("u")).select("u.unit", "u.side", "rep", "copies", "shingles")
    ordered = spread.repartition("unit").sortWithinPartitions("unit", "rep")
    return ordered.mapInPandas(lambda it: _units(it, threshold), _LINKS)


# --- the operator ------------------------------------------------------------------


def similar_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = N,
    threshold: float = THRESHOLD,
    width: int = WIDTH,
    small: int = SMALL,
    depth: int = DEPTH,
    recall: float = RECALL,
) -> DataFrame:
    """(doc_id, th, class_id, class_size, n_links, class_row) of every document.

    ``th`` is the 64-bit hash of the text (null as empty), which with the id
    names a row of ``docs``; ``class_row`` names the class also where its ids
    are null.
    """
    runs = runs_needed(recall, threshold, depth)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).withColumn("th", F.xxhash64("text"))
    sketched = written(
        rows.mapInPandas(lambda it: _sketches(it, n, width, runs, threshold), _SKETCH).withColumn("row", F.monotonically_increasing_id()),
        "sketches",
    )
    copies = sketched.groupBy("sethash").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies"))
    first = sketched.select(F.col("row").alias("rep"), "doc_id", "th", "n_shingles", "sketch", "nodes")
    reps = written(copies.join(first, "rep"), "sets")

    found = components(candidates(reps.filter("n_shingles > 0"), width, threshold, small, depth))
    members = reps.join(found.withColumnRenamed("node", "rep"), "rep")
    linked = written(links(members.select("rep", "doc_id", "th", "root", "n_shingles", "copies"), rows, n, threshold), "links")
    classes = components(linked.filter("rep <> root").select(F.col("root").alias("a"), F.col("rep").alias("b")))
    degree = linked.groupBy("rep").agg(F.sum("links").alias("links"))

    of_rep = (
        reps.select("rep", "sethash", "copies", "doc_id")
        .join(classes.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
    )
    of_doc = sketched.select("doc_id", "th", "sethash").join(
        of_rep.select("sethash", "root", "copies", F.coalesce("links", F.lit(0)).alias("links")), "sethash"
    )
    of_class = of_doc.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return of_doc.join(of_class, "root").select(
        "doc_id", "th", "class_id", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("root").alias("class_row")
    )


def first_of_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one document of each class: the smallest id,
    then text hash.  Of rows that repeat both, the smallest in all columns stays."""
    found = similar_classes(docs, id_col, text_col, **options)
    first = found.groupBy("class_row").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    times = found.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("times"))
    kept = first.select(F.col("first.doc_id").alias("doc"), F.col("first.th").alias("th")).join(
        times.select(F.col("doc_id").alias("d"), F.col("th").alias("t"), "times"), F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    )
    kept = kept.select("doc", "th", "times")
    # One column holds the whole row, so no name of the input can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    th = F.xxhash64(F.coalesce(F.col("row")[text_col].cast("string"), F.lit("")))
    on = F.col("row")[id_col].cast("bigint").eqNullSafe(F.col("doc")) & (th == F.col("th"))
    rows = rows.join(kept, on)
    once = rows.filter("times = 1").select("row")
    repeated = rows.filter("times > 1").groupBy("doc", "th").agg(F.min("row").alias("row")).select("row")
    return once.unionByName(repeated).select("row.*")


#: The same rows in DuckDB by brute force: all pairs that share a shingle.
ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 10 * c >= 8 * (x.n + y.n - c)
  UNION ALL SELECT x.doc_id, y.doc_id FROM w x JOIN w y ON len(x.w) = 0 AND len(y.w) = 0 AND x.doc_id < y.doc_id),
two_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, two_way.b FROM reach JOIN two_way ON two_way.a = reach.other),
degree AS (SELECT a AS doc_id, count(*) AS n_links FROM two_way GROUP BY a)
SELECT doc_id, min(other) AS class_id, count(*) AS class_size, coalesce(any_value(n_links), 0) AS n_links
FROM reach LEFT JOIN degree USING (doc_id) GROUP BY doc_id
"""
