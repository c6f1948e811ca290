import os

import pyarrow as pa
import pytest

from meridian.llm import common, sampling, simhash, suffix_runs, weighted_sampling


def test_stored_tables_stay_until_they_are_removed(spark):
    paths = []
    with common.collecting(paths):
        one = common.durable(spark.range(5))
        two = common.durable(spark.range(7))
    three = common.durable(spark.range(9))
    assert len(paths) == 2 and (one.count(), two.count(), three.count()) == (5, 7, 9)
    common.remove_tables(spark, paths, two)
    assert len(paths) == 1 and two.count() == 7 and three.count() == 9
    assert not os.path.exists(one.inputFiles()[0].removeprefix("file://"))


def test_slices_follow_bytes_and_lose_nothing():
    batch = pa.RecordBatch.from_pydict({"i": list(range(6)), "text": ["a" * 5, None, "", "b" * 20, "c", "é" * 4]})
    parts = list(common.slices(iter([batch, batch.slice(0, 0)]), "text", 10))
    assert [p.column("i").to_pylist() for p in parts] == [[0, 1, 2], [3], [4, 5]]


def test_samples_are_bounded_and_the_same_each_time(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "cast(id % 3 AS int) AS label")
    a, b = ({r.doc_id for r in sampling.sample_ids(rows.repartition(n), 500).collect()} for n in (2, 7))
    assert a == b and 400 < len(a) <= 500
    assert sampling.sample_ids(rows.limit(10), 500).count() == 10


def test_smaller_batches_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, 10)
    common.batched(lambda x: x)
    assert spark.conf.get(key) == "10"
    spark.conf.set(key, 50_000)
    common.batched(lambda x: x)
    assert spark.conf.get(key) == str(common.BATCH_ROWS)
    spark.conf.set(key, old)


def test_batches_are_bounded_in_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    for given, want in (("64m", str(common.BATCH_BYTES)), ("1m", "1m"), ("2000b", "2000b")):
        spark.conf.set(key, given)
        common.batched(lambda x: x)
        assert spark.conf.get(key) == want
    spark.conf.set(key, old)


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="share"):
        common.shared_dir(Session())


def test_ids_that_are_no_numbers_are_refused(spark):
    docs = spark.createDataFrame([("a", "text")], "doc_id string, text string")
    for run in (suffix_runs.deduplicated, weighted_sampling.against_next, simhash.near_duplicates, simhash.one_of_each):
        with pytest.raises(TypeError, match="whole number"):
            run(docs)
    assert simhash.near_duplicates(spark.createDataFrame([(1, "text")], "doc_id int, text string")).count() == 1
