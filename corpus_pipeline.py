"""From documents to packed training sequences, each stage a job of its own.

The stages reject what has no letter, keep one of each group of near
duplicates, take out repeated passages, mix the sources to their targets and
pack the tokens. A stage's result is written as Parquet and is the next
stage's table; all but the last keep the columns of documents, in any order
and with any others.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flarebook.llm import language, mixing, near_dup, packing, repeats
from flarebook.llm.tables import scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Names like these that are no columns of the table."""
    taken = {c.lower() for c in docs.columns}
    prefix = "own_"
    while any(prefix + name in taken for name in names):
        prefix += "_"
    return [prefix + name for name in names]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a letter; null texts and those without one go. Learns from the table's own labels.

    A text with a letter gets one of the learned languages and stays, whichever
    it is and however sure the network is. Without any learned language there
    is none to give, and the letters decide in the same way.
    """
    network = language.train(docs)
    if not network.languages:
        return language.with_letters(docs)
    labelled = language.predict(docs, network, tuple(docs.columns))
    names = unused(docs, "id", "held_out", "language", "score")
    return labelled.toDF(*names, *docs.columns).filter(F.col(names[2]) != language.UNKNOWN).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest id; of rows that repeat it, one."""
    return near_dup.one_of_each(docs).select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the characters that have a byte of a passage that occurs anywhere else."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    names = unused(docs, "bytes", "spans", "kept")
    rest = repeats.remove_repeats(docs, carried=tuple(others), whole_characters=True)
    rest = rest.toDF("doc_id", *names, *others)
    rest = rest.withColumn("text", repeats.as_text(F.col(names[2])))
    return rest.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document, none to two, as the mix takes, dealt to shards and shuffled in each."""
    return mixing.deal(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, each a sequence."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("language identification", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A tokenizer makes the ids of the last stage, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
