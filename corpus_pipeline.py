"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns what the next one works on; run() writes every stage as Parquet in the
shared folder and reads it again, so a lost executor costs no more than its stage. All stages but the last return
the columns of docs as they came.
"""

from __future__ import annotations

import contextvars
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm import host_rules, langid, queries, simhash, suffix_runs
from meridian.llm.common import collecting, durable, read_table, remove_tables

#: A document goes if no language has this share of its letters.
LEAST_LANGUAGE_SHARE = 0.5


#: Paths of what the stages before have stored, for each thread its own.
_stored: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("stored", default=())


def stage(fn):
    """A stage that first removes what earlier stages of this thread stored on the way to their results.

    By then the result is written and read again. What docs still reads from, as it wasn't, stays. Another thread's run has
    a list of its own.
    """

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not _stored.get():
            _stored.set(([],))
        (paths,) = _stored.get()
        remove_tables(spark, paths, docs)
        with collecting(paths):
            return fn(spark, docs, sf_dir)

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules, and those of hosts whose shrunken failure rate is too high.

    A null text has no words and goes; a null source is no host. Repeated rows are judged each by itself, an empty table
    stays empty, and other columns go along.
    """
    return host_rules.judged(docs, carry=True).filter("kept").select("row.*")


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that no language has most of; lang becomes what was found.

    The model learns from the documents that have a lang. If none has one, nothing can be found: only documents without
    a letter go, and lang stays as it was. A null text has no letter. Repeated rows are labelled each by itself, an empty
    table stays empty, and other columns go along.
    """
    model = langid.fit(docs)
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = langid.label(docs, model, carry=True)
    kept = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE))
    return kept.select(*(F.col("lang_pred" if c == "lang" else f"row.`{c}`").alias(c) for c in docs.columns))


@stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that of the smallest doc_id.

    A null text counts as empty, and texts without words are copies of each other. Repeated rows are one document, a row
    without doc_id stays only if no other text like it has one, and an empty table stays empty.
    """
    return simhash.one_of_each(docs)


@stage
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document with a smaller doc_id has too; a document of which nothing is left goes.

    n_chars follows the text; a null text becomes an empty one. Repeated rows don't act on each other, a null doc_id neither
    cuts nor is cut, an empty table stays empty, and other columns go along.
    """
    cut = suffix_runs.deduplicated(docs, as_text=True).filter((F.col("n_removed") < F.col("n_bytes")) | (F.col("n_removed") == 0))
    new = {"text": F.col("kept"), "n_chars": F.when(F.col("row.n_chars").isNotNull(), F.length("kept")).cast("long")}
    return cut.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


@stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 1024 tokens.

    A null text counts as empty and is one piece, its end id. Repeated rows are pieces each by itself, an empty table gives
    an empty result, and other columns are left behind.
    """
    return queries.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Language models, fingerprints, byte suffixes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; runs in several threads don't touch each other's tables."""
    docs = read_table(spark, sf_dir, "documents")
    for _, step in STAGES:
        docs = durable(step(spark, docs, sf_dir))
    return docs
