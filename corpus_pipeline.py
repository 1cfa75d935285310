"""From raw documents to packed training sequences.

Five stages, each one operator of ``martkit.llm`` over all that its
predecessor kept.  A stage's result is written as Parquet below
``spark.checkpoint.dir`` and read again as the next one's documents, so a lost
executor costs at most the stage it was lost in.

1. quality rules: documents that the tokeniser-fertility rules reject go;
2. line dedup: cross-site boilerplate lines go, but for their first place;
3. n-gram Jaccard join: one document of each class of similar ones stays;
4. secret scans: every secret span is replaced by a mark of its kind;
5. packing: the texts' tokens are packed along the Hilbert curve.

All stages but the last return the columns of documents; where a text changes,
``n_chars`` follows it.  Extra columns, whatever their names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import fertility, line_dedup, ngram_join, packing, secret_scan
from martkit.llm.common import documents, written


def _with_text(rows: DataFrame, columns: list[str], text: Column) -> DataFrame:
    """The rows held in column ``row``, with another text."""
    new = {"text": text, "n_chars": F.coalesce(F.length(text).cast("bigint"), F.col("row")["n_chars"].cast("bigint")) if "n_chars" in columns else None}
    return rows.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = fertility.judged(docs, docs.columns).filter(F.col("m.kept"))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def line_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(line_dedup.remove_boilerplate(docs), docs.columns, F.col("clean"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_of_class(docs)


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), secret_scan.scan(F.col("text"), with_text=True).alias("found"))
    return _with_text(rows, docs.columns, F.coalesce(F.col("found.redacted"), F.col("row")["text"]))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_removal),
    ("ngram_jaccard", near_duplicates),
    ("secret_scan", secret_removal),
    ("packing", packed),
]

#: Token ids and fertility have no SQL form; the tests hold ``run`` against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
