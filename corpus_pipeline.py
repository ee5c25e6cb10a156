"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept and gives documents with the same columns;
the last one gives the pieces of packed sequences. Every stage is written as Parquet in the shared
scratch folder and read again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.llm import decontaminate, lines, minhash, packing, toxicity
from clientlens.llm.common import crc_of_id, materialise, ship_package, table

END_ID = 2

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below 0.5. Learns from labelled documents, but for the fifth that
    is held out to measure it."""
    ship_package(spark)
    known = docs.filter(crc_of_id("doc_id", 5) != 0)
    return toxicity.clean_documents(docs, toxicity.learn(known, table(spark, sf_dir, "labels")))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in ten different texts or more, but for the first text
    that has them; ``n_chars`` follows. A document of such lines alone goes."""
    kept = lines.drop_common_lines(docs, least_docs=10, keep_first=True, by_text=True)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8 or more."""
    ship_package(spark)
    return minhash.keep_one(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship_package(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 4096 tokens, with their ids."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_common_lines),
    ("near dedup", keep_one_copy),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can't express MinHash, the lexicon or tokens; the tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
