"""One query per operator: ``(spark, sf_dir) -> DataFrame``, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyqa.llm import chat_format, quality_crf
from surveyqa.llm.alignment import alignments
from surveyqa.llm.embedding_join import near_vectors
from surveyqa.llm.importance import resampled
from surveyqa.llm.mixing import mixed
from surveyqa.llm.ngram_join import ngram_components
from surveyqa.llm.ngram_model import language_scores
from surveyqa.llm.packing import packed
from surveyqa.llm.personal_data import personal_data
from surveyqa.llm.quality_rules import quality_rules
from surveyqa.llm.secret_scan import secrets
from surveyqa.llm.token_files import token_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_chat_format(spark, sf_dir):
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.read_back(chat_format.formatted(chat_format.conversation_log(turns)))


@query
def op2_ngram_join(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark, sf_dir):
    return mixed(table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


@query
def op7_quality_crf(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    remainder = "coalesce(crc32(cast(doc_id AS string)) % 4, 0)"
    model = quality_crf.train(docs, labels, learn=F.expr(f"{remainder} <> 2"))
    return quality_crf.scored(docs, model).select(
        "doc_id", F.expr(f"{remainder} = 2").alias("held_out"), F.col("quality_score").alias("score"),
        F.expr("cast(quality_score >= 0.7 AS int)").alias("predicted"),
    )


@query
def op3_best_fit_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_secret_scan(spark, sf_dir):
    return secrets(table(spark, sf_dir, "documents"))


@query
def op10_token_files(spark, sf_dir):
    return token_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_embedding_join(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op4_language_model(spark, sf_dir):
    held_out = F.expr("coalesce(crc32(cast(doc_id AS string)) % 10, 0) = 0")
    return language_scores(table(spark, sf_dir, "documents"), ~held_out).withColumn("held_out", held_out)


@query
def op11_importance_resampling(spark, sf_dir):
    drawn = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_token_alignment(spark, sf_dir):
    left, right = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignments(table(spark, sf_dir, "documents"), left, right)


@query
def op13_personal_data(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))
