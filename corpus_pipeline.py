"""Filter and encode a corpus: each stage takes the documents its predecessor kept.

Stages read and return the columns of ``documents``; the last returns one row of ids and digests a
document. No stage can be expressed in the oracle's SQL (trained models, tokeniser), so
``ORACLE_SQL`` is None and tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelattice.llm import byte_bpe, decontaminate, jaccard, pii, toxicity
from carelattice.llm.frames import held_out, stored

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. It learns from the labels of the rows
    that ``op9`` learns from, on the texts of this stage's input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(5))
    model = toxicity.train(docs, labels)
    judged = toxicity.scored(docs.withColumn("__whole", F.col("text")), model, "__whole")
    return judged.where("predicted = 0").select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group that 5-word shingles link at 80 %."""
    return jaccard.keep_one(docs).select(docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; ``n_chars`` follows the text."""
    masked = pii.redact(docs, pii.train(docs))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), "n_chars")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    import public_tokenizers  # the tokenizer files' place; any rank file and pattern will do

    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_passages),
    ("PII", mask_personal_data),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{k}")
    return docs
