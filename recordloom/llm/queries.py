"""Registered queries of the operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, language, mixing, negatives, ngram_join, quality, ranked, secrets, sharding, spans, sql, token_files, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_decontamination", sql.OP1)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return out.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


@query("op2_secret_scan")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    out = secrets.secret_spans(table(spark, sf, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex",
                      F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


@query("op3_toxicity")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op4_source_mix")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    out = mixing.schedule(table(spark, sf, "documents").select("doc_id", "source"), cap=None)
    return out.select("row.doc_id", "row.source", "lane", "units", "block", "slot", "first", "last", "place", "in_mix")


@query("op5_token_files")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    folder = token_files.write_tokens(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), token_files.token_folder(spark))
    return token_files.crc32_of_ids(token_files.read_tokens(spark, folder))


@query("op6_sharding")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    out = sharding.shard(table(spark, sf, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op7_quality_rules", sql.OP7)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op8_ngram_jaccard")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf, "documents"), size=4, percent=85)


@query("op9_language_id")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(table(spark, sf, "documents")).select("doc_id", "held_out", "lang_pred", "score")


@query("op10_sentence_spans")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return spans.remove_repeats(table(spark, sf, "documents"))


@query("op11_ranked_search", sql.OP11)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return ranked.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op12_bpe_automaton")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


@query("op13_hard_negatives", sql.OP13)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").withColumn("label", label)
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)
