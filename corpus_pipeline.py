"""A corpus pipeline of five stages over ``documents``: quality, near duplicates, contamination, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; what it returns is written as
Parquet and read again as the next one's docs. The first four return the columns of ``documents``, the last the
token ids of each document.

Null ids: such a row goes through every stage like any other; of those in one group of near duplicates one stays. Null and empty
texts have no words and go in the first stage. Rows that repeat another one wholly are copies and go in the second. Texts of
any length are worked whole. Further columns stay as they are, whatever their names. Empty tables give empty tables; without
labels or a benchmark the first stage has its base rule alone and the third drops nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderspark.llm import bpe, decontaminate, quality, secrets, simhash
from tenderspark.llm.common import table, written
from tenderspark.llm.q_text import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rule or a risk-controlled cutoff rejects: null, empty and short texts always."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component of fingerprints and of texts of Jaccard similarity 0.8 or more on shingles of
    five words; a row with a null id stays beside it, one for each component."""
    return simhash.keep_one(docs, similarity=0.8)


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in benchmark windows; null texts and null ids of items mark none."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces reported secrets in the text by their kind; all rows stay, null texts too, and n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")) if "n_chars" in docs.columns else clean


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by spaces) and the digests of ids and decoded text, a row per row; a null text is
    empty."""
    found = bpe.encode_documents(docs, vocabulary())
    return found.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", contamination_stage),
    ("secret scans", secret_stage),
    ("BPE encoding and decoding", token_stage),
]

#: Fingerprints (XXH64) and BPE can't be written in SQL; tests/llm hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return docs
