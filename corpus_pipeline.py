"""A corpus pipeline: toxic documents out, near duplicates out, repeated passages out, the rest packed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next stage's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagmill.llm.packing import pack_documents
from tagmill.llm.queries import BYTE_VOCABULARY
from tagmill.llm.simhash import drop_near_duplicates
from tagmill.llm.similar import drop_similar
from tagmill.llm.suffixes import drop_repeats
from tagmill.llm.toxicity import fit_toxicity, toxicity_score
from tagmill.session import scratch_folder, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5; null and empty texts are scored like others."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return docs.where(toxicity_score("text", fit_toxicity(docs, labels)) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Fingerprints at 4 or fewer differing bits link, as in ``op6_simhash``. What then is left is compared exactly: texts that
    share 0.8 of their shingles of five words or more differ in more bits than an index of fingerprints finds.
    """
    folder = scratch_folder(spark, "copies")
    return drop_similar(written(drop_near_duplicates(docs), f"{folder}/simhash"))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words or more that stand elsewhere before."""
    cut = drop_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of at most 1024 tokens."""
    packed = pack_documents(docs, BYTE_VOCABULARY, limit=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("simhash", drop_copies), ("suffix_array", drop_passages), ("packing", pack)]

# Compression lengths, components of near copies and byte-pair ids are beyond SQL; tests compare each stage with
# a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored in the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_folder(spark, "corpus")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
