"""Bounded samples of labelled rows to fit classifiers on, and which rows are held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id, of: int) -> Column:
    """crc32 of doc_id as text, modulo `of`."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(of))


def thinned(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most `most` rows, the same ones each time, picked by a hash of key.

    The hash thins the rows to about a half more than wanted before they are ranked, so what is ranked does not grow
    with the input or the number of its partitions.
    """
    step = max(1, int(rows.count() / (1.5 * most)))
    few = rows.filter(F.pmod(F.xxhash64(key), F.lit(step)) == 0)
    return few.orderBy(F.xxhash64(key, F.lit(1)), key).limit(most)


def sample_ids(labelled: DataFrame, most: int) -> DataFrame:
    """(doc_id, label) of at most `most` rows, one for each doc_id."""
    once = labelled.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    return thinned(once, "doc_id", most)


def sample_texts(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """(doc_id, text, label) of the sampled documents; ids has at most `most` rows, so it can go everywhere."""
    return docs.select("doc_id", "text").join(F.broadcast(ids.limit(most)), "doc_id")
