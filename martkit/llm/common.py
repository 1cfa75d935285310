"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: later passes read the same rows even if an executor is
    lost.  The folder is shared by the driver and all executors.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "martkit-llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of ``docs`` under fixed names, null texts as empty ones;
    whatever other columns ``docs`` has cannot clash with an operator's own."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def joined(strings: Column) -> Column:
    return F.concat_ws(",", strings)
