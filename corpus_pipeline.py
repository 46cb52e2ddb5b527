"""A training-data pipeline over ``documents``: quality rules, near-duplicates, pseudonyms, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is written as Parquet and
read back as the next stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from bizlens.llm import packing, pii, quality, simhash
from bizlens.llm.work import written

#: The key of the pseudonyms; a deployment sets its own.
PII_KEY = "change-me"
SHINGLE, DISTANCE = 4, 4
MAX_TOKENS, END_ID = 2048, 0
#: Documents a sequence may hold. (No attention-cost limit below MAX_TOKENS squared would admit a full piece.)
MAX_DOCS = 32


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents the rules reject go."""
    judged = quality.judge(docs.select(F.struct("*").alias("row"), "text"))
    fields = [F.col("cleaned").alias(c) if c == "text" else F.length("cleaned").cast("long").alias(c)
              if c == "n_chars" else F.col(f"row.{c}").alias(c) for c in docs.columns]
    # Written before the filter: pushed below the rules' projections, the filter would repeat their expressions.
    return written(judged.select(F.struct(*fields).alias("row"), "kept"), "quality-judged").where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_of_each(docs, SHINGLE, DISTANCE)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms of the same format."""
    done = pii.pseudonymise(docs, PII_KEY, count_col=None)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their sequences and offsets."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), MAX_TOKENS, END_ID,
                                  max_docs=MAX_DOCS)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("pseudonyms", pseudonyms),
          ("best_fit_packing", best_fit_packing)]

#: SQL has neither SimHash components nor a tokenizer: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
