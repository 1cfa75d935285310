"""License scans by ordered signature rules, in DataFrame functions only.

A text becomes its words in lower case with one space between them.  A cheap
gate (a few substring tests) sends most texts past the rules; in the others
each rule is tried only where its keyword occurs.  A rule's matches are marked
in the text, so that their first and last word numbers follow from splitting
it at spaces.  Overlaps are then resolved per document: a detection is
suppressed where one of the same or a higher priority contains its words (the
longer, then the higher, then the earlier rule wins).  The base phrases are
rules that nothing suppresses.

Detections are exploded and compared by running maxima in a window per
document, in linear time and without the text; the work per document is
bounded by its own length.

Edge cases: a null or empty text has no words and no detections; very long
texts are scanned whole; equal detections are reported once; repeated rows
each get their result (rows are numbered once, in a written table); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .license_rules import BASE, Rule, rules

#: Every gate keyword contains one of these, or they occur with it in all the rule's matches.
STEMS = (
    "licen", "gnu", "apache", "mit no", " cc", "creative", "bsd", "spdx", "copyright", "reserved", "gpl", "redistribut",
    "permission", "warrant", "public domain", "cddl", "wtfpl", "rail", "proprietary", "prohibited", "use only", "opensource", "contributor",
    "endorse", "advertising", "misrepresented", "exception", "nonexclusive", "openssl", "california", "waive", "fuck", "a beer", "copying",
)
#: How sure a detection of each priority is.
WEIGHT = {1: 0.5, 2: 0.8, 3: 1.0}
_START, _END = "\u0001", "\u0002"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """`` word word ... `` in lower case; one space for a text without words."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _LETTERS, _LETTERS.lower())
    spaced = F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.ltrim(F.rtrim(spaced)), F.lit(" "))


def count_words(norm: Column) -> Column:
    words = F.length(norm) - F.length(F.replace(norm, F.lit(" "), F.lit(""))) - 1
    return F.when(F.trim(norm) == "", F.lit(0)).otherwise(words).cast("bigint")


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_table(table: list[Rule]) -> Column:
    """The rules as one constant; base phrases have priority 9."""
    rows = [Rule(label, 9, f" {phrase} ", phrase) for phrase, label in BASE.items()] + table
    items = (
        f"named_struct('rule', {i}, 'label', {_quoted(r.label)}, 'priority', {r.priority}, "
        f"'keyword', {_quoted(r.keyword)}, 'pattern', {_quoted(f'(?<= )({r.pattern})(?= )')})"
        for i, r in enumerate(rows)
    )
    return F.expr(f"array({', '.join(items)})")


def detections(norm: Column, table: list[Rule] | None = None) -> Column:
    """All matches as (rule, label, priority, first, last), word numbers from 0."""

    def matches(r: Column) -> Column:
        marked = F.split(F.trim(F.regexp_replace(norm, r["pattern"], F.lit(f"{_START}$1{_END}"))), " ")
        spots = F.filter(
            F.transform(marked, lambda w, i: F.struct(i.cast("bigint").alias("at"), F.startswith(w, F.lit(_START)).alias("a"), F.endswith(w, F.lit(_END)).alias("b"))),
            lambda s: s["a"] | s["b"],
        )
        starts, ends = F.filter(spots, lambda s: s["a"])["at"], F.filter(spots, lambda s: s["b"])["at"]
        return F.transform(
            F.arrays_zip(starts.alias("first"), ends.alias("last")),
            lambda z: F.struct(
                r["rule"].alias("rule"), r["label"].alias("label"), r["priority"].alias("priority"), z["first"], z["last"]
            ),
        )

    gate = F.lit(False)
    for stem in STEMS:
        gate = gate | F.contains(norm, F.lit(stem))
    tried = F.filter(_rule_table(table if table is not None else rules()), lambda r: F.contains(norm, r["keyword"]))
    return F.when(gate, F.flatten(F.transform(tried, matches)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, detections): ``row``, ``doc_id``, ``n_words`` of every row,
    and every detection with ``kept``."""
    norm = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    rows = written(
        norm.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            count_words(F.col("norm")).alias("n_words"),
            detections(F.col("norm"), table).alias("found"),
        ),
        "license-rows",
    )
    each = rows.select("row", F.explode("found").alias("d")).select("row", "d.*")
    order = Window.partitionBy("row").orderBy("first", F.desc("last"), F.desc("priority"), "rule")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("priority") < 9, F.col("last"))  # base phrases suppress nothing
    covered = F.lit(False)
    for p in WEIGHT:
        reach = F.max(F.when(F.col("priority") >= p, own)).over(earlier)
        covered = covered | ((F.col("priority") == p) & (F.coalesce(reach, F.lit(-1)) >= F.col("last")))
    return rows.select("row", "doc_id", "n_words"), each.withColumn("kept", ~covered)


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table: list[Rule] | None = None) -> DataFrame:
    """One row per document: its words, base places, labels and score."""
    rows, each = scan(docs, id_col, text_col, table)
    base, kept = F.col("priority") == 9, F.col("kept")
    weight = F.lit(0.0)
    for p, w in WEIGHT.items():
        weight = F.when(F.col("priority") == p, F.lit(w)).otherwise(weight)

    def labels(where: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(where, F.col("label")))), ",")

    found = each.groupBy("row").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(kept).alias("labels"),
        F.max(F.when(base, F.lit(WEIGHT[2])).when(kept, weight)).alias("score"),
        F.count_if(~base).alias("n_detections"),
        F.count_if(~base & ~kept).alias("n_suppressed"),
    )
    zero, none = F.lit(0).cast("bigint"), F.lit("")
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", zero).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", none).alias("base_labels"),
        F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.coalesce("n_detections", zero).alias("n_detections"),
        F.coalesce("n_suppressed", zero).alias("n_suppressed"),
    )
