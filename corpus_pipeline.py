"""The corpus pipeline: toxic documents go, one of each group of near copies stays, repeated passages are cut, sources are mixed, texts are encoded.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierline.llm import bpe, mixing, near_dedup, substring_dedup, toxicity
from tierline.llm.queries import TOKENIZER
from tierline.llm.shared import cut, table
from tierline.session import configure

# Weights of sources in code point order; a source is repeated CAP times at most.
WEIGHTS, CAP = (5, 2, 1), 3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chain probability of being toxic reaches the threshold go."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.clean(docs, toxicity.train(docs, labels, toxicity.table_categories(labels)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component of near copies stays."""
    return near_dedup.dedup(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out."""
    return substring_dedup.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, so that each source's words come to its target."""
    return mixing.mixed_documents(docs, WEIGHTS, CAP)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each document of the mix."""
    return bpe.digests(docs, public_tokenizers.path(TOKENIZER), keep_ids=True)


def _configured(stage):
    """``stage`` with the library's session settings, whoever calls it."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark), docs, sf_dir)
    return run


STAGES = [(name, _configured(stage)) for name, stage in (
    ("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("substring_dedup", cut_repeats), ("mixing", mix_sources), ("bpe", encode))]

# Trained models, sketches and Newton iterations can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
