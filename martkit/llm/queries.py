"""The registered queries of the training-data operators (one ``opN_`` each).

Every query applies its operator, with production parameters, to the whole
``documents`` table and derives the digest columns of its result contract.
"""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conv_trie, doc_sketch, fertility, lang_mix, license_scan, line_dedup, ngram_join, packing, secret_scan, sharding, source_audit, sp_viterbi, toxicity
from .common import documents


def op1_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License places, labels and score of every document."""
    return license_scan.licenses(documents(spark, sf_dir))


def op2_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    pairs = doc_sketch.edited_pairs(documents(spark, sf_dir))
    own, edited = F.col("sketch"), F.col("edited_sketch")
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        doc_sketch.printed(own).alias("fingerprint"),
        doc_sketch.printed(edited).alias("edited_fingerprint"),
        doc_sketch.likeness(own, edited).alias("near_edited"),
        doc_sketch.likeness(own, F.col("next_sketch")).alias("near_next"),
        doc_sketch.containment(own, F.col("next_sketch")).alias("contained_in_next"),
    )


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed along the Hilbert curve."""
    return packing.pack(documents(spark, sf_dir))


def op4_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of similar documents and number of links."""
    return ngram_join.similar_classes(documents(spark, sf_dir)).drop("th", "class_row")


def op5_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fertility measures and verdict of every document."""
    return fertility.judged(documents(spark, sf_dir), ["doc_id"]).select("row.doc_id", "m.*")


def op6_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on many sites."""
    found = line_dedup.remove_boilerplate(documents(spark, sf_dir))
    return found.select("row.doc_id", "n_lines", "n_removed", F.col("clean").alias("text"))


def op7_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and whether they decode to its text."""
    return sp_viterbi.encode(documents(spark, sf_dir))


def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39, placed by the stored slot map's newest
    version; law ``bytes``: shard sizes near equal."""
    placed, _ = sharding.assign(documents(spark, sf_dir), 40)
    return placed.select(
        F.col("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot_in_shard").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op9_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", secret_scan.scan(F.col("text")).alias("s")).select("doc_id", "s.*").drop("redacted")


def op10_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity categories of every document."""
    docs = documents(spark, sf_dir)
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.select("doc_id", toxicity.score(F.col("text"), chain).alias("t")).select("doc_id", "t.*")


def op11_depth_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return conv_trie.trie(conv_trie.rebuilt_paths(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op12_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every language's sources, and their overused terms."""
    return source_audit.audit(documents(spark, sf_dir))


def op13_em_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, and the proportions of its languages."""
    share = F.expr("concat_ws(',', transform(array_sort(map_entries(languages)), x -> concat(x.key, ':', format_number(x.value, '0.000'))))")
    return lang_mix.predicted(documents(spark, sf_dir)).withColumn("languages", share)


QUERIES = {
    "op1_signatures": op1_signatures,
    "op2_scaled_sketch": op2_scaled_sketch,
    "op3_hilbert": op3_hilbert,
    "op4_chosen_path": op4_chosen_path,
    "op5_fertility": op5_fertility,
    "op6_site_spread": op6_site_spread,
    "op7_streaming_viterbi": op7_streaming_viterbi,
    "op8_virtual_slots": op8_virtual_slots,
    "op9_grammar": op9_grammar,
    "op10_classifier_chain": op10_classifier_chain,
    "op11_depth_bands": op11_depth_bands,
    "op12_level_products": op12_level_products,
    "op13_em_mixture": op13_em_mixture,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op4_chosen_path": ngram_join.ORACLE,
    "op6_site_spread": line_dedup.ORACLE,
    "op11_depth_bands": conv_trie.ORACLE,
    "op12_level_products": source_audit.ORACLE,
}
