import hashlib
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

import corpus_pipeline
from meridian.llm import host_rules

from .fixtures import ODD, odd_docs
from .test_simhash import by_hand, plain
from .test_suffix_runs import by_hand as cut_by_hand

SF = "/root/testdata/sf0.001"
NAMES = ["quality_rules", "language_id", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]


def test_every_stage_works_on_what_its_predecessor_kept(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}

    bad = {r.doc_id for r in host_rules.judged(docs).collect() if not r.kept}
    out = corpus_pipeline.quality_rules(spark, docs, SF)
    assert out.columns == columns
    rows = {r.doc_id: r for r in out.collect()}
    assert bad and rows == {k: v for k, v in before.items() if k not in bad}

    docs = spark.createDataFrame(list(rows.values()), docs.schema)
    out = corpus_pipeline.language_id(spark, docs, SF)
    assert out.columns == columns
    found = {r.doc_id: r for r in out.collect()}
    assert all(found[k].text == rows[k].text for k in found) and len(found) > 0.98 * len(rows)
    assert sum(found[k].lang == rows[k].lang for k in found) > 0.98 * len(found)

    docs = spark.createDataFrame(list(found.values()), docs.schema)
    out = corpus_pipeline.simhash_near_dedup(spark, docs, SF)
    assert out.columns == columns
    ids = sorted(found)
    roots = by_hand(ids, [plain(found[k].text) for k in ids])
    rows = {r.doc_id: r for r in out.collect()}
    assert rows == {k: v for k, v in found.items() if roots[k] == k} and len(rows) < len(found)

    docs = spark.createDataFrame(list(rows.values()), docs.schema)
    out = corpus_pipeline.suffix_array_dedup(spark, docs, SF)
    assert out.columns == columns
    want = {w[0]: w for w in cut_by_hand([(k, r.text) for k, r in rows.items()])}
    cut = {r.doc_id: r for r in out.collect()}
    assert set(cut) == {k for k, w in want.items() if w[2] < w[1]}
    exact = 0
    for k, r in cut.items():
        assert r.n_chars == len(r.text) and r.lang == rows[k].lang
        exact += hashlib.sha256(r.text.encode()).hexdigest() == want[k][4]
    assert exact > 0.95 * len(cut)  # the rest lost half a character at a cut

    docs = spark.createDataFrame(list(cut.values()), docs.schema)
    packed = corpus_pipeline.best_fit_packing(spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(cut)


def test_run_is_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 100 and rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_odd_rows_pass_every_stage(spark):
    odd = odd_docs(spark).withColumn("n_chars", F.length("text").cast("long"))
    for docs in (odd, odd.filter("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            kept = out.count()
            assert kept <= len(ODD) + 5
            if name != "best_fit_packing":
                assert out.columns == docs.columns


def test_one_row_stays_of_repeated_and_nameless_ones(spark):
    text = "a b c d e f g h i j"
    docs = spark.createDataFrame([(None, text), (None, text), (None, "x y z " * 9), (3, "k l m n o p q r"), (3, "k l m n o p q r"), (5, "k l m n o p q r")], "doc_id long, text string")
    rows = corpus_pipeline.simhash_near_dedup(spark, docs, SF).collect()
    assert sorted(map(str, rows)) == sorted(map(str, docs.dropDuplicates().filter("doc_id IS NULL OR doc_id = 3").collect()))


def test_documents_stay_if_none_has_a_language(spark):
    rows = [(1, "plain words", None), (2, "Слова", None), (3, "12 34 !", None), (4, "", None), (5, None, None), (6, "\U00020000", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = corpus_pipeline.language_id(spark, docs, SF)
    assert out.columns == docs.columns and sorted(tuple(r) for r in out.collect()) == [rows[0], rows[1], rows[5]]


def test_runs_side_by_side_keep_their_tables(spark):
    with ThreadPoolExecutor(2) as pool:
        both = [f.result() for f in [pool.submit(lambda: sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length").collect()))) for _ in range(2)]]
    assert both[0] == both[1] and len(both[0]) > 100


def test_a_third_of_the_texts_is_null_beside_long_ones(spark):
    """The last stage on lengths of which each leaves another gap for the many texts of one token."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 508, F.expr("repeat(' a', cast(512 + id as int))")).when(F.col("id") % 2 == 0, "a b").alias("text"))
    rows = corpus_pipeline.best_fit_packing(spark, docs, SF).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k")).collect()
    assert sum(r.k for r in rows) == 3000 and max(r.n for r in rows) <= 1024 and len(rows) == 508
