"""The thin queries over the driver tables, by name, and the SQL that DuckDB can check them with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm import archives, co_buckets, host_rules, langid, packing, phrases, segment_bpe, sharding, simhash, simhash_sql, suffix_runs, token_counts, toxicity, weighted_sampling
from meridian.llm.common import new_folder, read_table
from meridian.llm.sampling import fold


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is, on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES = {}
SQL = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_suffix_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_runs.deduplicated(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op1_suffix_runs"] = suffix_runs.SQL


@query
def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = host_rules.judged(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


SQL["op2_host_rules"] = host_rules.SQL


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def packed(docs: DataFrame) -> DataFrame:
    """Packing with the vocabulary and capacity of production."""
    import public_tokenizers

    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"))


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "slot_id")


SQL["op9_sharding"] = sharding.SQL


@query
def op10_segment_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_bpe.digests(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


SQL["op6_simhash"] = simhash_sql.SQL


@query
def op5_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold("doc_id", 4) != 2))
    return langid.label(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(fold("doc_id", 5) != 0))
    rows = toxicity.scored(docs, model)
    return rows.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.against_next(read_table(spark, sf_dir, "documents"))


@query
def op11_co_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co_buckets.sales_and_lines(read_table(spark, sf_dir, "sales"), read_table(spark, sf_dir, "sale_lines"), new_folder(spark, "co_buckets"))


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


SQL["op12_phrases"] = phrases.SQL


@query
def op13_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.pages_archived(read_table(spark, sf_dir, "pages"), new_folder(spark, "archives"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
