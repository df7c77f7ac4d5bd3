"""From raw documents to packed training sequences.

Five stages, each on what its predecessor kept: toxic documents go, exact copies go, one document of
each near-duplicate group stays, sources are mixed to target weights, and the mix is packed. All but
the last return the columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.llm.common import held_out
from tidewright.llm.exact_dedup import keep_first
from tidewright.llm.mixing import mixed
from tidewright.llm.near_dedup import keep_one
from tidewright.llm.packing import pack_documents
from tidewright.llm.queries import tokenizer_path
from tidewright.llm.toxicity import toxicity_scorer
from tidewright.session import scratch_path

TOXIC = 0.5
SIMILARITY = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = toxicity_scorer(docs, labels, ~held_out("doc_id", 5, 0))
    return docs.where(score(F.col("text"))["score"] < TOXIC)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained scores, fingerprints, random rounding and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
