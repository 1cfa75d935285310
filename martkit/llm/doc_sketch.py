"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every hash of a text's 5-word shingles that lies below a fixed
fraction (1 / ``SCALE``) of the hash range.  Its size follows the text's, so
sketches of very unequal documents stay comparable: `containment` estimates
how much of a small document a large one holds, and the union of two sketches
is the sketch of both texts together (`merged`).

The fraction is 1 for a text with fewer than ``whole_below`` distinct shingles
(a parameter of the method, ``WHOLE_BELOW`` unless given; 0 gives every text
the one fraction): below it the one fraction would leave a few hashes or none,
and a comparison of short texts would say nothing.  A sketch names its scale,
and two sketches are compared and merged at the coarser of their scales, which
needs nothing but dropping the hashes above its threshold.

All of it is DataFrame functions.  A document's successor in id order is found
without a task that sees all ids: ids alone are range-partitioned and written
once, successors are looked up inside each partition, and a partition's last
id goes on to the first id of the next one.  Of the successor only the
characters that are needed and its sketch are moved.

Words are lower-case and split at ASCII white space; fewer than 5 words are
one shingle.  Edge cases: a null text is an empty one; an empty text has an
empty sketch, equal to that of another empty text (likeness 1) and unlike
every other (0); null ids sort first; of several rows with one id the
successor is the one whose text has the smallest hash, and rows that repeat an
id each get that id's successor; a single id is its own successor; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

N = 5
SCALE_BITS = 3
SCALE = 1 << SCALE_BITS
WHOLE_BELOW = 128
_FIRST = -(1 << 63)


def with_sketch(df: DataFrame, text: str, out: str, whole_below: int = WHOLE_BELOW) -> DataFrame:
    """``df`` with the sketch of its column ``text``: struct(scale, hashes)."""
    words = F.filter(F.split(F.lower(F.col(text)), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The hashes of the words are a column of their own, read (not computed
    # again) by every shingle.
    hashed = df.withColumn("_sk_words", F.transform(words, lambda w: F.xxhash64(w)))
    h = F.col("_sk_words")
    n = F.size(h)
    shingles = (
        F.when(n == 0, F.array().cast("array<bigint>"))
        .when(n < N, F.array(F.xxhash64(h)))
        .otherwise(F.transform(F.sequence(F.lit(0), n - N), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(N)])))
    )
    distinct = hashed.withColumn("_sk_all", F.array_distinct(shingles)).drop("_sk_words")
    every = F.col("_sk_all")
    small = F.size(every) < max(whole_below, 1)  # a text without shingles has scale 1
    low = F.filter(every, lambda x: F.shiftrightunsigned(x, 64 - SCALE_BITS) == 0)
    sketch = F.struct(
        F.when(small, F.lit(1)).otherwise(F.lit(SCALE)).alias("scale"), F.array_sort(F.when(small, every).otherwise(low)).alias("hashes")
    )
    return distinct.withColumn(out, sketch).drop("_sk_all")


def coarser(sketch: Column, scale: Column) -> Column:
    """The hashes of a sketch at a scale at least its own."""
    low = F.filter(sketch["hashes"], lambda x: F.shiftrightunsigned(x, 64 - SCALE_BITS) == 0)
    return F.when(scale == sketch["scale"], sketch["hashes"]).otherwise(low)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketched texts, 0 to 1."""
    scale = F.greatest(a["scale"], b["scale"])
    x, y = coarser(a, scale), coarser(b, scale)
    both = F.size(F.array_intersect(x, y))
    either = F.size(x) + F.size(y) - both
    return F.when(either == 0, (a == b).cast("double")).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first text's shingles that the second has; null
    (unknown) where the first has shingles but none at the common scale.

    Exact at scale 1.  At scale ``SCALE`` a text of n shingles has about
    n / SCALE hashes to compare: none with probability (1 - 1 / SCALE) ** n
    (51% of texts of 5 shingles, 26% of 10, 7% of 20), and otherwise a
    standard error of about sqrt(SCALE * c * (1 - c) / n) for a true share c
    (0.45 at 10 shingles and 0.13 at 120, for c = 1/2).
    """
    scale = F.greatest(a["scale"], b["scale"])
    x = coarser(a, scale)
    shared = F.size(F.array_intersect(x, coarser(b, scale))) / F.size(x)
    none = (F.size(a["hashes"]) == 0) & (a["scale"] == 1)
    return F.when(none, (a == b).cast("double")).when(F.size(x) > 0, shared)


def merged(a: Column, b: Column) -> Column:
    """The sketch of both texts together."""
    scale = F.greatest(a["scale"], b["scale"])
    return F.struct(scale.alias("scale"), F.array_sort(F.array_union(coarser(a, scale), coarser(b, scale))).alias("hashes"))


def printed(sketch: Column) -> Column:
    """A sketch as ``scale:hash,hash,...`` in hexadecimal."""
    return F.concat(sketch["scale"].cast("string"), F.lit(":"), F.array_join(F.transform(sketch["hashes"], lambda x: F.hex(x)), ","))


def successors(ids: DataFrame, key: str) -> DataFrame:
    """``ids`` (unique) with ``next``: the next larger key, after the last the first."""
    kept = written(ids.repartitionByRange(key).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id()), "id-order")
    parts = kept.groupBy("_part").agg(F.min(key).alias("_low"))  # one row per partition
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    then = parts.select(
        "_part", F.coalesce(F.lead("_low").over(Window.orderBy("_part")), F.first("_low").over(whole)).alias("_then")
    )
    inside = F.lead(key).over(Window.partitionBy("_part").orderBy(key))
    return kept.withColumn("_inside", inside).join(then, "_part").withColumn("next", F.coalesce("_inside", "_then")).drop("_part", "_inside", "_then")


def _quarter(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("int")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_below: int = WHOLE_BELOW) -> DataFrame:
    """Every document's sketch, its edited text (the last quarter replaced by
    the beginning of its successor) and that text's and the successor's sketch."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_FIRST)).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    ids = rows.groupBy("key").agg(F.max(_quarter(F.col("text"))).alias("need"))
    wanted = successors(ids, "key").select(F.col("next").alias("key"), F.col("key").alias("before"), "need")

    # The same three columns, dealt by key, serve the heads and the documents:
    # texts are shuffled and sketched once (the exchange is reused).
    placed = with_sketch(rows, "text", "sketch", whole_below).select("key", "text", "sketch")
    heads = placed.join(wanted, "key").groupBy(F.col("before").alias("key")).agg(
        F.min(F.struct(F.xxhash64("text").alias("th"), F.expr("substring(text, 1, need)").alias("head"), "sketch")).alias("next")
    )
    quarter = _quarter(F.col("text"))
    kept = F.substring("text", F.lit(1), F.length("text") - quarter)
    joined = placed.join(heads, "key").select(
        F.when(F.col("key") != _FIRST, F.col("key")).alias("doc_id"),
        F.length("text").cast("bigint").alias("n_chars"),
        "sketch",
        F.concat(kept, F.substring(F.col("next.head"), F.lit(1), quarter)).alias("edited"),
        F.col("next.sketch").alias("next_sketch"),
    )
    return with_sketch(joined, "edited", "edited_sketch", whole_below)
