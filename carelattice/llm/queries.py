"""The operators applied to the driver's tables: one query ``opN_<name>`` each.

Queries take whole tables and return whole results; none of them can be expressed in the oracle's
SQL unless ``ORACLES`` names it, so tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from carelattice.llm import (
    byte_bpe, circulant, context_tree, decontaminate, hard_negatives, jaccard, pii, quality_model, quality_rules, runs, substrings, toxicity, urls)
from carelattice.llm.frames import held_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(texts(spark, sf_dir), held_out(10))


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.compression_bands(texts(spark, sf_dir))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # the tokenizer files' place; any rank file and pattern will do

    return byte_bpe.encode(texts(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(texts(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("first_word").cast("bigint").alias("first_word"), "similarity")


def op5_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(texts(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(texts(spark, sf_dir))


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    return pii.digests(docs, pii.train(docs)).select(
        "doc_id", *[f"n_{k}" for k in pii.BASE], "base_sha256", "spans")


def op9_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out(5)))
    return toxicity.scored(docs, model).select(
        "doc_id", held_out(5).alias("held_out"), "score", "predicted")


def op10_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_model.train(docs, table(spark, sf_dir, "labels").where(~held_out(5)))
    return quality_model.scored(docs, model).select(
        "doc_id", held_out(5).alias("held_out"), "score", "predicted")


def planted(docs: DataFrame) -> DataFrame:
    """The texts of every tenth id (by crc32) made periodic from a word on; a null id's text stays."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("bigint").alias("g"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.expr("if(n > 0, g % n, null)"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    text = F.expr("array_join(transform(sequence(0, cast(n as int) - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op11_lcp_kruskal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.detect(planted(texts(spark, sf_dir)))
    top = F.expr("""aggregate(slice(runs, 2, greatest(size(runs) - 1, 1)), runs[0],
        (m, r) -> if(r.length * m.period > m.length * r.period, r, m))""")
    text = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.withColumn("top", F.when(F.size("runs") > 0, top))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_maximus_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant.near_copies(texts(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {f.__name__: f for f in (
    op1_context_tree, op2_compression_bands, op3_byte_bpe, op4_simhash_windows, op5_url_trees, op6_jaccard_join, op7_super_kmers, op8_weak_supervision, op9_ftrl_toxicity, op10_factorisation_machine,
    op11_lcp_kruskal_runs, op12_maximus_negatives, op13_circulant_minhash,
)}
ORACLES: dict[str, str] = {"op4_simhash_windows": decontaminate.ORACLE, "op12_maximus_negatives": hard_negatives.ORACLE}
