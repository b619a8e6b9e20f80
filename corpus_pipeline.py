"""Clean a text corpus: stages that each read what the stage before has kept.

quality keeps what the classifier accepts; near_dedup one document of each group; decontaminate drops documents with
benchmark passages; pii replaces personal data by its kind; bpe encodes what is left.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rasterloom.llm.bpe import encode_decode  # noqa: E402
from rasterloom.llm.common import stored, table, vocabulary  # noqa: E402
from rasterloom.llm.decontaminate import drop_contaminated  # noqa: E402
from rasterloom.llm.pii import redact  # noqa: E402
from rasterloom.llm.quality import keep_good, train  # noqa: E402
from rasterloom.llm.simhash import deduplicate  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.5 or more; without any labels all stay."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near fingerprints; rows without an id all stay."""
    return deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark window."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; the number of characters follows the text."""
    return redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as little-endian unsigned 32-bit integers, and a digest of what they decode to."""
    coded = encode_decode(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", pii), ("bpe", bpe)]

#: The stages train a model and find components, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
