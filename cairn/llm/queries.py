"""Registered queries of this package: the operators with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.llm.align import align_tokenizers
from cairn.llm.decontam import find_leaks
from cairn.llm.hardneg import hard_negatives
from cairn.llm.htmltext import extract
from cairn.llm.linededup import dedup_lines
from cairn.llm.lm import score_texts
from cairn.llm.ngram_join import ngram_components
from cairn.llm.packing import pack_documents
from cairn.llm.pii import find_pii
from cairn.llm.quality_model import score_quality
from cairn.llm.rules import judge
from cairn.llm.tokencount import count_tokens
from cairn.llm.toxicity import score_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_benchmark_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_classifier(spark, sf_dir):
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_line_dedup(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents"))


def op8_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality_rules(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents")).drop("n_removed_lines")


def op10_lm_scoring(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark, sf_dir):
    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def op12_hard_negative_mining(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("id") % 100 == 0)


def op13_pii(spark, sf_dir):
    return find_pii(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_html_extraction, op3_toxicity, op4_benchmark_decontamination, op5_quality_classifier, op6_best_fit_packing,
                                   op7_line_dedup, op8_token_counts, op9_quality_rules, op10_lm_scoring,
                                   op11_cross_tokenizer_alignment, op12_hard_negative_mining, op13_pii)}
