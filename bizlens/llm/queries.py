"""The queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from zlib import crc32

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bizlens.llm import (adaptive_scan, bpe, chat, licences, packing, periodic, pii, quality, sharding, simhash, spelling,
                         token_files, weighted_sampling)
from bizlens.llm.work import documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir, "doc_id", "text"), BYTE_BPE, max_tokens=2048, end_id=0)


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir, "doc_id", "text"), WORD_BPE)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir, "doc_id", "text")).select(*quality.COLUMNS)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_round_trip(documents(spark, sf_dir, "doc_id", "text"), BYTE_BPE, end_id=2)


def op5_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                  "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(rows.unionByName(extra)))


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(documents(spark, sf_dir, "doc_id", "text"), key=corpus_pipeline.PII_KEY)


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir, "doc_id", "text"), shards=16)


def op8_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), shingle=4, distance=4)
    return rows.select("doc_id", simhash.shown(F.col("fp")).alias("fingerprint"), "component_id")


def op9_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.neighbours(documents(spark, sf_dir, "doc_id", "text"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir, "doc_id", "text")).select(*licences.COLUMNS)


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The text of every tenth document (by hash) with one stretch of its words repeated to the end, as op11 asks."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, at(i))), " "))

    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # A one-element array binds the words, so that the text is split once.
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), repeated), F.lit(0))).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("text", with_repeats(F.col("doc_id"), F.col("text")))
    best = F.col("best")
    return periodic.find_runs(docs).withColumn("best", periodic.strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[f].alias(f) for f in ("start", "length", "period")],
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def misspelt(doc_id: int, word: str) -> str:
    """Every 97th word of a document (by hash) without one letter, as op12 asks."""
    h = crc32(f"{doc_id}:{word}".encode())
    return word if h % 97 else word[:h % len(word)] + word[h % len(word) + 1:]


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(documents(spark, sf_dir, "doc_id", "text"), changed=misspelt)
    return spelling.variants(counts.where(F.col("n") >= spelling.MIN_COUNT))


def op13_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return adaptive_scan.nearest(vectors, F.col("id") % 50 == 0, k=5)


QUERIES = {f.__name__: f for f in (op1_best_fit_packing, op2_bpe_round_trip, op3_quality_rules, op4_token_files,
                                  op5_chat_round_trip, op6_pii_pseudonyms, op7_histogram_shards,
                                  op8_simhash_near_duplicates, op9_weighted_sampling, op10_licence_scan,
                                  op11_periodic_runs, op12_spelling_variants, op13_adaptive_scan)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE: dict[str, str] = {"op3_quality_rules": quality.SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
