"""The corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; what it returns is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import bpe, decontaminate, language_id, line_dedup, minhash
from rollbook.llm.common import documents, set_aside, table
from rollbook.llm.queries import TOKENIZER
from rollbook.sources.tables import stage


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is ``und`` (no text, or no letter in it) go; every other one stays."""
    model = language_id.fit(docs.where(~language_id.held_out()), "lang", "text", "doc_id")
    slim, restore = set_aside(docs, "text")
    return restore(language_id.predict(slim, model).where(F.col("lang_pred") != language_id.UNKNOWN))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 or more characters in five or more documents stay in the last of them; every document stays."""
    slim, restore = set_aside(docs, "doc_id", "text")
    return restore(line_dedup.dedup_lines(slim)).withColumn("n_chars", F.length("text").cast("long"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the one with the least id stays."""
    slim, restore = set_aside(docs, "doc_id", "text")
    return restore(minhash.near_duplicates(slim, size=5, percent=80).where("kept"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the decoded bytes."""
    wanted = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    found = bpe.encode_documents(docs, TOKENIZER, public_tokenizers.PATTERN, results=wanted)
    return found.select("doc_id", "lang", "source", *wanted)


STAGES = [("language_id", identify), ("line_dedup", dedup_lines), ("near_dedup", dedup_near),
          ("decontaminate", decontaminated), ("byte_bpe", encode)]

#: SQL cannot state byte-level BPE; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
