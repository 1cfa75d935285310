"""Cross-site boilerplate removal by the distinct-site spread of lines.

A line that stands on ``min_sites`` sites or more is boilerplate and goes
from every document but the first that has it (smallest id, then text hash,
then place), so each text survives once.  The spread of a line is a
HyperLogLog sketch of its sites, one per line hash, merged by aggregation.
Sketches whose estimate lies clearly above or below the threshold decide;
lines within ``band`` of it get an exact distinct count.

The work before the sketches keeps them few: a plain minimum and maximum of
the site hash per line, combined before the shuffle, rules out all lines of a
single site.  Only the places of the remaining lines are written down.  A line
that a third of all rows hold is one row per task after that combination, and
its places are joined, not grouped, so the join can be split.

A line's identity is its text without spaces at its ends (hash and length);
lines shorter than ``min_chars`` are never boilerplate.

Edge cases: a null text stays null, an empty one empty (one empty line); a
null site counts as one site of its own; rows that repeat id and text are one
document and get the same result; a document may lose all its lines and is
kept with an empty text; an empty table gives an empty result; other columns
come back as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MIN_SITES = 10
MIN_CHARS = 12
LG_K = 12
BAND = 0.1


def _places(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_chars: int) -> DataFrame:
    """(doc, th, site, pos, h, len) of every line long enough."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc"),
        F.xxhash64(F.col(text_col)).alias("th"),
        F.xxhash64(F.coalesce(F.col(site_col).cast("string"), F.lit("\u0000"))).alias("site"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"),
    )
    line = F.trim("line")
    return (
        rows.withColumn("line", line)
        .withColumn("len", F.length("line"))
        .filter(F.col("len") >= min_chars)
        .select("doc", "th", "site", "pos", F.xxhash64("line").alias("h"), "len")
    )


def boilerplate_places(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    min_chars: int = MIN_CHARS,
    band: float = BAND,
    lg_k: int = LG_K,
) -> DataFrame:
    """(doc, th, pos) of the lines to remove."""
    key = ["h", "len"]
    places = _places(docs, id_col, text_col, site_col, min_chars)
    several = (
        places.groupBy(*key).agg(F.min("site").alias("a"), F.max("site").alias("b"))
        .filter(F.col("a") != F.col("b")).select(*key)
    )
    shared = written(places.join(several, key, "left_semi"), "shared-lines")

    spread = written(
        shared.groupBy(*key).agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"),
            F.min(F.struct("doc", "th", "pos")).alias("first"),
        ),
        "line-spread",
    )
    margin = max(1.0, band * min_sites)
    near = spread.filter(F.abs(F.col("sites") - min_sites) <= margin)
    exact = (
        shared.join(near.select(*key), key, "left_semi").groupBy(*key, "site").agg(F.lit(1).alias("one"))
        .groupBy(*key).agg(F.count("one").alias("exact")).filter(F.col("exact") >= min_sites)
    )
    clear = spread.filter(F.col("sites") - min_sites > margin).select(*key, "first")
    gone = clear.unionByName(near.select(*key, "first").join(exact.select(*key), key, "left_semi"))
    return shared.join(gone, key).filter(~F.struct("doc", "th", "pos").eqNullSafe(F.col("first"))).select("doc", "th", "pos")


def remove_boilerplate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", **options
) -> DataFrame:
    """``row`` (the document as it was), ``n_lines``, ``n_removed`` and ``clean`` (its new text)."""
    removed = boilerplate_places(docs, id_col, text_col, site_col, **options).groupBy("doc", "th").agg(
        F.collect_set("pos").alias("gone")  # at most the lines of one document
    )
    # One column holds the whole row, so no name of the input can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text, doc = F.col("row")[text_col], F.col("row")[id_col].cast("bigint")
    both = rows.join(removed, doc.eqNullSafe(F.col("doc")) & (F.xxhash64(text) == F.col("th")), "left")
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    clean: Column = F.array_join(F.transform(kept, lambda i: F.element_at(lines, i + 1)), "\n")
    return both.select(
        "row",
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), text).otherwise(clean).alias("clean"),
    )


#: The same rows in DuckDB, with exact distinct counts for all lines.
ORACLE = f"""
WITH lines AS (
  SELECT doc_id, source, u.pos, u.line FROM (
    SELECT doc_id, source, unnest(list_transform(range(len(string_split(text, chr(10)))),
      lambda i: {{'pos': i, 'line': string_split(text, chr(10))[i + 1]}})) AS u FROM documents)),
spread AS (
  SELECT trim(line) AS line, min((doc_id, pos)) AS first FROM lines WHERE length(trim(line)) >= {MIN_CHARS}
  GROUP BY trim(line) HAVING count(DISTINCT coalesce(source, chr(1))) >= {MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.pos, l.line, s.line IS NOT NULL AND (l.doc_id, l.pos) <> s.first AS gone
  FROM lines l LEFT JOIN spread s ON trim(l.line) = s.line)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""
