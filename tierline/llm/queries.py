"""The registered queries of the operators in this subpackage, over their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (bpe, byte_bpe, chat, hard_negatives, mixing, near_dedup, quality_rules, sharding, substring_dedup, topk, toxicity, whitening,
                          wrappers)
from tierline.llm.oracle import ORACLES
from tierline.llm.shared import table

SHARDS = 8
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), SHARDS)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, F.col("vec_id") % 50 == 0, "vec_id", topk.scaled(F.col("embedding")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.canonical(table(spark, sf_dir, "conversations"), "conv_id", "turn")
    says = f"{chat.END}{chat.START}assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], rows.schema)
    return chat.digests(chat.render(rows.unionByName(own)))


def chat_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations`` written as a JSON record of one of three layouts, by its turn, and brought back by its record's fingerprint.

    Records of all layouts lie in one column; some carry fields that no mapping knows.
    """
    turn, role, text = F.col("turn"), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    theirs = F.when(role == "user", "human").when(role == "assistant", "gpt").otherwise(role)
    rows = F.struct(role.alias("role"), text.alias("text"), F.struct(turn.alias("at")).alias("meta"))
    messages = F.struct(F.array(F.struct(role.alias("role"), text.alias("content"))).alias("messages"))
    sharegpt = F.struct(F.array(F.struct(theirs.alias("from"), text.alias("value"))).alias("conversations"), F.lit("x").alias("source"))
    record = F.when(turn % 3 == 0, F.to_json(messages)).when(turn % 3 == 1, F.to_json(sharegpt)).otherwise(F.to_json(rows))
    # the record's id carries its place through the conversion
    key = F.to_json(F.struct("conv_id", "turn"))
    written = table(spark, sf_dir, "conversations").select(key.alias("id"), record.alias("record"))
    back = F.from_json("conv_id", "conv_id long, turn long")
    return chat.turns_from_json(written, "id", "record").select(back["conv_id"].alias("conv_id"), back["turn"].alias("turn"), "role", "text")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.trimmed(table(spark, sf_dir, "documents"))


def op7_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = toxicity.train(docs, labels, toxicity.table_categories(labels))
    return toxicity.scores(docs, chain).withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vec_id, label = table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("label")
    label = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(rows, "vec_id", label, topk.scaled(F.col("embedding")), vec_id % 100 == 0)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = whitening.whiten(table(spark, sf_dir, "embeddings"), F.col("embedding"))
    return made.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_sharding, op3_topk, op4_quality_rules, op5_chat, op6_substring_dedup, op7_wrappers, op8_near_dedup, op9_toxicity, op10_bpe,
                                  op11_hard_negatives, op12_byte_bpe, op13_whitening, chat_layouts)}


def oracles() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
