"""Batches of requests that are settled as if they came one after the other.

A request touches keys.  Each touch needs its key to be in use or to be free
and, if the whole request is accepted, leaves it in use or free: a sale needs
its car and its number free and leaves both in use; a rename needs the old key
in use and the new one free and leaves them the other way round.  A request is
accepted when all its touches find what they need at its turn; a rejected one
changes nothing.

``settle`` writes the requests once, with a number of their own, looks up per
key whether it is in use and how many requests touch it (one aggregate of
requests and tables per space), and then splits the work by what can affect
what:

* a request that shares no key is settled from the tables alone, as is, where
  every touch takes a free key, one whose key is in use from the start;
* the others are parted into the connected components of requests that share
  keys (``components``, over the requests that share two keys or more; not
  needed while all of them together are at most ``FOLD_LIMIT``); a component of
  at most ``FOLD_LIMIT`` requests is read in order by one pass that remembers
  the state of its keys, and only there the order is made by sorting;
* a larger component is numbered in its order and settled in rounds of joins,
  each of which decides every request that is first for all its keys (and,
  where keys are only ever taken, rejects all on a key that has been taken).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .merge import write_version

#: Requests that share keys and that one task may read in order.
FOLD_LIMIT = 500_000


class Touch(NamedTuple):
    """``column`` names a key of ``space``; ``needs`` and ``leaves``: whether
    the key is in use before and after."""

    column: str
    space: str
    needs: bool = False
    leaves: bool = True


def in_sequence(requests: DataFrame, order: Sequence[str]) -> DataFrame:
    """``requests`` with ``_row``, a number that grows along ``order`` (equal
    requests in any order, fixed by writing them once)."""
    cols = [*order, "_tie"]
    ranged = requests.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*cols).sortWithinPartitions(*cols)
    numbered = ranged.drop("_tie").withColumn("_row", F.monotonically_increasing_id())
    return write_version(numbered, scratch_path(requests.sparkSession, "batch"))


def _shuffled(x: Column, n: int, back: bool = False) -> Column:
    """Another number for every number, in an order of its own for every ``n``
    (0: as they are), so that no numbering of the nodes is bad in all rounds.
    ``back``: the number that it was made of (a Feistel network of two steps)."""
    if not n:
        return x

    def mixed(half: Column, step: int) -> Column:
        return F.xxhash64(half, F.lit(2 * n + step)).bitwiseAND(0xFFFFFFFF)

    high, low = F.shiftrightunsigned(x, 32), x.bitwiseAND(0xFFFFFFFF)
    if back:
        low = low.bitwiseXOR(mixed(high, 1))
        high = high.bitwiseXOR(mixed(low, 0))
    else:
        high = high.bitwiseXOR(mixed(low, 0))
        low = low.bitwiseXOR(mixed(high, 1))
    return F.shiftleft(high, 32).bitwiseOR(low)


def components(edges: DataFrame, least: bool = True) -> tuple[DataFrame, int]:
    """((node, label) of every node, rounds) for ``edges`` (a, b) of numbers.
    ``least``: the label is the smallest node, else any node of the component.

    A round sends every node to the least of its neighbours and itself (in an
    order that changes from round to round), and from there once more, and the
    edges between what remains go on: the graph shrinks by a share of its
    nodes in every round.  Minima are combined on the map side; stars around
    their smallest node need no round beyond the first pass (0).
    """
    spark = edges.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        return write_version(df, scratch_path(spark, "components"))

    def between(a: str, b: str) -> list[Column]:
        return [F.greatest(a, b).alias("u"), F.least(a, b).alias("v")]

    now = kept(edges.filter("a <> b").select(*between("a", "b")).distinct())
    steps, rounds = [], 0
    while True:
        ends = now.select(F.explode(F.array(
            F.struct(F.col("u").alias("node"), F.col("v").alias("other")), F.struct(F.col("v").alias("node"), F.col("u").alias("other")))).alias("e"))
        first = ends.select("e.node", _shuffled(F.col("e.other"), rounds).alias("other")).groupBy("node").agg(F.min("other").alias("other"))
        step = kept(first.select("node", _shuffled(F.least("other", _shuffled(F.col("node"), rounds)), rounds, back=True).alias("to")))
        step = kept(step.join(step.select(F.col("node").alias("to"), F.col("to").alias("further")), "to").select("node", F.col("further").alias("to")))
        steps.append(step)
        sides = [step.select(F.col("node").alias(end), F.col("to").alias(to)) for end, to in (("u", "a"), ("v", "b"))]
        now = kept(now.join(sides[0], "u").join(sides[1], "v").filter("a <> b").select(*between("a", "b")).distinct())
        if now.isEmpty():
            break
        rounds += 1
    labels = steps[-1].select("node", F.col("to").alias("label"))
    for step in reversed(steps[:-1]):
        labels = step.join(labels.withColumnRenamed("node", "to"), "to", "left").select("node", F.coalesce("label", "to").alias("label"))
    if least and rounds:
        labels = kept(labels)
        labels = labels.join(labels.groupBy("label").agg(F.min("node").alias("least")), "label").select("node", F.col("least").alias("label"))
    return labels, rounds


def _fold(batches: Iterator, touches: list[Touch], columns: list[str]) -> Iterator:
    """Requests sorted by (component, order), settled one by one: their
    ``columns`` with ``failed`` and ``at_start``."""
    import pyarrow as pa

    spaces = list(dict.fromkeys(t.space for t in touches))
    steps = [(i, spaces.index(t.space), t.needs, t.leaves) for i, t in enumerate(touches)]
    label, state = None, [{} for _ in spaces]
    for batch in batches:
        keys = [batch.column(f"_k{i}").to_pylist() for i, *_ in steps]
        start = [batch.column(f"_u{i}").to_pylist() for i, *_ in steps]
        failed, at_start = [], []
        for row, here in enumerate(batch.column("_label").to_pylist()):
            if here != label:
                label, state = here, [{} for _ in spaces]
            for i, space, needs, _ in steps:
                if state[space].get(keys[i][row], start[i][row]) != needs:
                    failed.append(i)
                    at_start.append(start[i][row] != needs)
                    break
            else:
                for i, space, _, leaves in steps:
                    state[space][keys[i][row]] = leaves
                failed.append(None)
                at_start.append(None)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in columns], pa.array(failed, pa.int32()), pa.array(at_start, pa.bool_())], names=[*columns, "failed", "at_start"])


def _rounds(rows: DataFrame, touches: list[Touch]) -> DataFrame:
    """``rows`` (_row, _k0.., _u0..) settled in rounds of joins."""
    spark, n = rows.sparkSession, len(touches)
    taking = all(not t.needs and t.leaves for t in touches)

    def kept(df: DataFrame) -> DataFrame:
        return write_version(df, scratch_path(spark, "batch_round"))

    keys = F.array(*[F.col(f"_k{i}") for i in range(n)])
    touched = F.explode(F.array(*[F.struct(F.col(f"_k{i}").alias("key"), F.col(f"_u{i}").alias("used")) for i in range(n)]))
    state = kept(rows.select(touched.alias("t")).select("t.*").distinct())
    left, done = rows, None
    while True:
        firsts = left.select("_row", F.explode(F.array_distinct(keys)).alias("key")).groupBy("key").agg(F.min("_row").alias("_row"))
        heads = firsts.groupBy("_row").agg(F.count(F.lit(1)).alias("n"))
        now = left.join(heads, "_row").filter(F.col("n") == F.size(F.array_distinct(keys))).drop("n")
        for i in range(n):  # a key belongs to one head at most
            now = now.join(state.select(F.col("key").alias(f"_k{i}"), F.col("used").alias(f"_s{i}")), f"_k{i}")
        failed = F.coalesce(*[F.when(F.col(f"_s{i}") != t.needs, i) for i, t in enumerate(touches)])
        at_start = F.coalesce(*[F.when(failed == i, F.col(f"_u{i}") != t.needs) for i, t in enumerate(touches)])
        now = kept(now.select("_row", *[f"_k{i}" for i in range(n)], failed.cast("int").alias("failed"), at_start.alias("at_start")))
        settled = now.select("_row", "failed", "at_start")
        change = F.explode(F.array(*[F.struct(F.col(f"_k{i}").alias("key"), F.lit(t.leaves).alias("new")) for i, t in enumerate(touches)]))
        changed = now.filter("failed IS NULL").select(change.alias("c")).select("c.*")
        left = left.join(now.select("_row"), "_row", "left_anti")
        if taking:  # all others on a taken key are out; which key it was is looked up at the end
            settled = settled.filter("failed IS NULL")
            for i in range(n):
                left = left.join(changed.select(F.col("key").alias(f"_k{i}")), f"_k{i}", "left_anti")
        left = kept(left)
        state = kept(state.join(changed, "key", "left").select("key", F.coalesce("new", "used").alias("used")))
        done = settled if done is None else done.unionByName(settled)
        if left.isEmpty():
            break
    if not taking:
        return done
    won = kept(rows.join(done.select("_row"), "_row", "left_semi"))
    lost = rows.join(done.select("_row"), "_row", "left_anti")
    for i in range(n):
        lost = lost.join(won.select(F.col(f"_k{i}"), F.col("_row").alias(f"_w{i}")), f"_k{i}", "left")
    first = F.coalesce(*[F.when(F.col(f"_w{i}") < F.col("_row"), i) for i in range(n)])
    return done.unionByName(lost.select("_row", first.cast("int").alias("failed"), F.lit(False).alias("at_start")))


def _looked_up(rows: DataFrame, touches: list[Touch], in_use: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with, per touch i, ``_u{i}`` (its key is in use), ``_n{i}`` (the
    requests that touch it) and ``_m{i}`` (the rows that the table has of it).

    Requests and table meet in one aggregate per space, reduced on the map side.
    """
    kinds = dict(rows.dtypes)
    for space in dict.fromkeys(t.space for t in touches):
        mine = [(i, t) for i, t in enumerate(touches) if t.space == space]
        kind, table = kinds[mine[0][1].column], in_use[space]
        used = F.col("used") if "used" in table.columns[1:] else F.lit(True)
        held = table.select(F.col(table.columns[0]).cast(kind).alias("key"), F.lit(0).cast("bigint").alias("n"), used.alias("used"), F.lit(1).cast("bigint").alias("m"))
        asked = F.array_distinct(F.array(*[F.col(t.column).cast(kind) for _, t in mine])) if len(mine) > 1 else F.array(mine[0][1].column)
        asked = rows.select(F.explode(asked).alias("key")).select("key", F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("used"), F.lit(0).cast("bigint").alias("m"))
        both = asked.unionByName(held).filter("key IS NOT NULL")
        keys = both.groupBy("key").agg(F.sum("n").alias("n"), F.max("used").alias("used"), F.sum("m").alias("m")).filter("n > 0")
        for i, t in mine:
            found = keys.select(F.col("key").alias(t.column), F.col("n").alias(f"_n{i}"), F.col("used").alias(f"_u{i}"), F.col("m").alias(f"_m{i}"))
            rows = rows.join(found, t.column, "left")
    return rows


def settle(
    requests: DataFrame, touches: Sequence[Touch], order: Sequence[str], in_use: dict[str, DataFrame], fold_limit: int = FOLD_LIMIT
) -> DataFrame:
    """``requests`` with ``_row`` (a number of its own, which grows along ``order``
    among requests that share keys), ``failed`` (the number of the first touch
    that did not find what it needs; null: accepted) and ``at_start`` (whether
    that touch would have failed before the batch too).  ``in_use`` holds, per
    space, a column of its keys in use, or a column of all its keys and a
    boolean ``used``; there, a key that is not in the table is unknown, and a
    request comes once for each row that the table has of its key.

    A request with a null key fails at that touch and takes no part, nor does one
    with an unknown key (its ``at_start`` is null); where all touches take a free
    key, a key that is in use from the start is the reason given before any
    that the batch has taken.  Every request has exactly one outcome.
    """
    spark, touches = requests.sparkSession, list(touches)
    n, columns = len(touches), requests.columns

    def kept(df: DataFrame, name: str) -> DataFrame:
        return write_version(df, scratch_path(spark, name))

    # Equal requests stay in one order: that in which they are written.
    numbered = kept(requests.withColumn("_tie", F.monotonically_increasing_id()), "batch")
    rows = _looked_up(numbered, touches, in_use)
    listed = [i for i, t in enumerate(touches) if "used" in in_use[t.space].columns[1:]]
    for i in listed:
        rows = rows.withColumn("_again", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col(f"_m{i}"))))).drop("_again")
    key = {i: F.col(t.column) for i, t in enumerate(touches)}
    unknown = [F.col(f"_m{i}") == 0 if i in listed else F.lit(False) for i in range(n)]
    keyless = F.coalesce(*[F.when(key[i].isNull() | unknown[i], i) for i in range(n)])
    hopeless = F.lit(False)
    if all(not t.needs and t.leaves for t in touches):  # a key in use stays so
        hopeless = F.greatest(*[F.col(f"_u{i}") for i in range(n)], F.lit(False))
    shared = {i: (F.col(f"_n{i}") > 1) | (F.col(f"_m{i}") > 1) if i in listed else F.col(f"_n{i}") > 1 for i in range(n)}
    contested = keyless.isNull() & ~hopeless & F.greatest(*shared.values(), F.lit(False))
    # What the state at the start alone says, for the others.
    failed = F.coalesce(keyless, *[F.when(F.col(f"_u{i}") != t.needs, i) for i, t in enumerate(touches)])
    at_start = F.coalesce(*[F.when(failed == i, F.when(key[i].isNull() | ~unknown[i], True)) for i in range(n)])
    rows = kept(rows.select(
        *columns, "_tie", *[F.col(f"_u{i}") for i in range(n)], *[shared[i].alias(f"_s{i}") for i in range(n)], contested.alias("_contested"),
        F.when(~contested, failed).cast("int").alias("failed"), F.when(~contested, at_start).alias("at_start")), "batch_keys")
    out = rows.filter(~F.col("_contested")).select(*columns, (-1 - F.monotonically_increasing_id()).alias("_row"), "failed", "at_start")

    # Keys are told apart by hash here: equal hashes of two keys only join two
    # components, which are settled by the keys themselves.
    rows = rows.filter("_contested")
    node = [F.when(F.col(f"_s{i}"), F.xxhash64(F.lit(t.space), F.col(t.column).cast("string"))) for i, t in enumerate(touches)]
    if rows.count() <= fold_limit:  # few enough for one task, whatever they share
        labelled = rows.withColumn("_label", F.lit(0).cast("bigint"))
    else:
        labelled = rows.withColumn("_label", F.coalesce(*node))
        if n > 1:  # a request that shares one key only joins nothing
            links = rows.select(F.coalesce(*node).alias("a"), F.explode(F.array(*node[1:])).alias("b")).filter("a <> b")
            labels = components(links, least=False)[0].select(F.col("node").alias("_label"), F.col("label").alias("_part"))
            labelled = labelled.join(labels, "_label", "left").withColumn("_label", F.coalesce("_part", "_label")).drop("_part")
        labelled = kept(labelled, "batch_components")
    sizes = labelled.groupBy("_label").agg(F.count(F.lit(1)).alias("_size"))
    # At most one label per ``fold_limit`` requests.
    large = [r[0] for r in sizes.filter(F.col("_size") > fold_limit).select("_label").collect()]
    touched = [c for i, t in enumerate(touches) for c in (F.col(t.column).cast("string").alias(f"_k{i}"), f"_u{i}")]
    small = labelled.filter(~F.col("_label").isin(large)) if large else labelled
    small = small.repartition("_label").sortWithinPartitions("_label", *order, "_tie")
    small = small.select(*columns, (F.monotonically_increasing_id() * 2).alias("_row"), "_label", *touched)
    carried = [*columns, "_row"]
    schema = T.StructType([*[small.schema[c] for c in carried], T.StructField("failed", T.IntegerType()), T.StructField("at_start", T.BooleanType())])
    out = out.unionByName(small.mapInArrow(lambda batches: _fold(batches, touches, carried), schema))
    if large:
        rest = in_sequence(labelled.filter(F.col("_label").isin(large)), [*order, "_tie"])
        keys = [F.concat(F.lit(f"{t.space}:"), F.col(t.column).cast("string")).alias(f"_k{i}") for i, t in enumerate(touches)]
        settled = _rounds(rest.select("_row", *keys, *[f"_u{i}" for i in range(n)]), touches)
        rest = rest.select(*columns, "_row").join(settled, "_row")
        out = out.unionByName(rest.select(*columns, (F.col("_row") * 2 + 1).alias("_row"), "failed", "at_start"))
    return kept(out, "batch_outcomes")


def final_keys(log: DataFrame) -> tuple[DataFrame, int]:
    """((key, last_key), rounds) for every key that an accepted rename moved
    first: where its record stands after the whole ``log`` (_row, old, new).

    A rename points to the next one away from its new key; pointers are
    doubled until none moves, so a chain of n renames takes log(n) rounds.
    """
    from pyspark.sql import Window

    spark = log.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        return write_version(df, scratch_path(spark, "rename_log"))

    ends = log.select("_row", "new", F.explode(F.array(F.struct(F.col("old").alias("key"), F.lit(False).alias("comes")),
                                                       F.struct(F.col("new").alias("key"), F.lit(True).alias("comes")))).alias("x")).select("_row", "new", "x.*")
    along = Window.partitionBy("key").orderBy("_row")
    ends = ends.withColumn("next", F.lead("_row").over(along)).withColumn("earlier", F.lag("_row").over(along))
    ends = kept(ends.filter("NOT comes AND earlier IS NULL OR comes AND next IS NOT NULL"))
    # Only renames that another one follows have a pointer.
    at, rounds = ends.filter("comes").select("_row", F.col("next").alias("end")), 0
    while True:
        far = at.select(F.col("_row").alias("end"), F.col("end").alias("further"))
        at = kept(at.join(far, "end", "left").select("_row", F.coalesce("further", "end").alias("end"), F.col("further").isNotNull().alias("moved")))
        rounds += 1
        if at.filter("moved").isEmpty():
            break
        at = at.drop("moved")
    first = kept(ends.filter("NOT comes").select("_row", "key", "new").join(at.select("_row", "end"), "_row", "left"))
    last = log.select(F.col("_row").alias("end"), F.col("new").alias("last_key"))
    moved = first.filter("end IS NOT NULL").join(last, "end").select("key", "last_key")
    return first.filter("end IS NULL").select("key", F.col("new").alias("last_key")).unionByName(moved), rounds
