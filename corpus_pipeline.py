"""The corpus pipeline: raw documents to token ids, in four stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's documents. All but the
last return the columns of ``documents``; the last returns, for each document
of the mix, its id, language, source, number of tokens, the SHA-256 of its ids
and of the decoded text, and the ids.

A document that the mix takes twice is there twice. NULL texts, empty tables
and repeated rows are handled as the docstring of each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, langid, mixing, simhash
from tessera.llm.common import fresh_names, materialize, table

#: Least probability of the predicted language that a document needs.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: texts without a letter, and texts
    that no learned language makes more likely than all others together, go.
    Learned from the labelled documents of the stage's own input. If none is
    labelled, nothing can be told apart and all documents with a letter stay."""
    model = langid.fit(docs, F.col("lang"), F.col("text"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    language, score = fresh_names(docs, "language", "score")
    found = langid.predict(docs, model, F.col("text"), names=(language, score))
    kept = found.where((F.col(language) != langid.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE))
    return kept.drop(language, score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, the one of the smallest id."""
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    return bpe.digests(docs, ["doc_id", "lang", "source"], ids=True)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", tokens),
]

#: SQL has neither the model nor the fingerprints; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "pipeline-" + name.split()[0].lower())
    return docs
