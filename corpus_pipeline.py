"""Corpus pipeline: documents to token ids.

Stages, in order: language identification (documents it rejects go), n-gram
Jaccard join (one document of each group of near duplicates stays), secret
scans (found secrets are masked in the text), mixing to target weights (texts
become the words the mix takes), SentencePiece encoding and decoding.

Each stage takes all that its predecessor kept and returns a DataFrame; all but
the last return the columns of documents.  ``run`` writes every stage's result
as Parquet to the shared folder and hands on what it reads back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm import catalog, language_id, mixing, ngram_join, secret_scan, sentencepiece_codec
from shopfloor.llm.common import bound_batches, crc_mod, pin, table

#: Near duplicates of the pipeline: five words, a similarity of 0.8.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def prepare(spark: SparkSession) -> None:
    catalog.ship(spark)
    bound_batches(spark)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    learn = F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(True))
    return language_id.accepted_documents(docs, language_id.fit(docs.where(learn)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sentencepiece_codec.encode_documents(docs, catalog.vocabulary_path(), keep=["doc_id", "source"], with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Compression, tries, lexing, seeded draws and merges are not SQL; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
