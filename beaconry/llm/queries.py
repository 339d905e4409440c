"""The queries of this subpackage over the test tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.llm import (chat_format, kd_shards, length_buckets, mtree, piece_fst, pii_lstm, quality_trees, rules, secret_crf, simhash, source_audit, spelling,
                          toxicity_mil)
from beaconry.llm.common import table


def op1_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"))


def op3_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_crf.secrets(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_piece_fst(spark: SparkSession, sf_dir: str, model: str = "/opt/tokenizers/piece_bpe_32k.model") -> DataFrame:
    return piece_fst.encode(table(spark, sf_dir, "documents"), piece_fst.compile_model(model))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_lstm.personal_data(table(spark, sf_dir, "documents"))


def op7_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_buckets.pack(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_mil.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(table(spark, sf_dir, "documents"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").selectExpr("CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn", "role", "text")
    planted = spark.createDataFrame([(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))], turns.schema)
    return chat_format.read_back(chat_format.formatted(chat_format.turn_records(turns.unionByName(planted))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_mtree_top_k, op2_quality_rules, op3_secret_crf, op4_simhash, op5_piece_fst, op6_personal_data, op7_quality_trees, op8_packing, op9_toxicity, op10_kd_shards,
    op11_source_audit, op12_spelling, op13_chat_format)}
ORACLE: dict[str, str] = {"op1_mtree_top_k": mtree.SQL, "op2_quality_rules": rules.SQL, "op11_source_audit": source_audit.SQL, "op12_spelling": spelling.SQL,
                          "op13_chat_format": chat_format.SQL}
