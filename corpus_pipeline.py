"""A corpus pipeline: documents in, token ids of the mixed corpus out.

Each stage takes all that its predecessor kept; the first four return the columns of ``documents``, whatever others there
are and whatever they are called. In every stage null text counts as empty, texts are used whole, repeated rows are judged
alike, and an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strandweave.llm import bpe, exact_dedup, mixing, quality, simhash
from strandweave.llm.common import materialize
from strandweave.llm.queries import RANKS


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the table of labels, predicts to be good: scores of 0.3 and more.

    Labels with a null id or label teach nothing; with labels of one class or none all scores are 0.3, and all stay.
    Empty texts have a score like any other; documents with a null id are scored too.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that are equal without white space.

    The one with the most code points stays, of ties the smallest id, null ids last, and of rows equal in all that one.
    All empty and null texts are one class.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group that links of at least 0.8 of five-word shingles hold together.

    Candidates are SimHash fingerprints with Golay keys, then shingle prefixes for what those do not hold together.

    Texts without words are no copies of each other; rows of one id share its fate, and rows with a null id stay.
    """
    return simhash.drop_near_copies(docs, n=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it (0 to 2 times), dealt to shards and shuffled in them.

    A null source is one of its own, the last in order; rows equal in id, source and text are taken together.
    """
    return mixing.draw(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and the token ids of the whole text; none for empty and null texts."""
    return bpe.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN).select("doc_id", "source", "ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("near-dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("byte-level bpe", encode_tokens),
]

#: No SQL says candidates by SimHash, shingle prefixes or BPE; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
