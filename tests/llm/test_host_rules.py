import duckdb
import pytest
from pyspark.sql import functions as F

from meridian.llm import host_rules, queries

from .fixtures import ODD, no_docs, odd_docs

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def by_hand(text):
    text = text or ""
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_measures(spark):
    rows = host_rules.judged(odd_docs(spark)).collect()
    assert len(rows) == len(ODD)
    texts = {r[0]: r[1] for r in ODD}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == by_hand(texts[r.doc_id]), r
    assert host_rules.judged(no_docs(spark)).count() == 0


def hosts(spark):
    """Two bad hosts, three good ones, a small one with one failure, and rows of no host."""
    good, bad = " ".join(f"w{i}" for i in range(30)), "too short"
    rows = []
    for host, n, failing in [("bad", 40, 36), ("worse", 300, 299), ("fine", 500, 3), ("good", 60, 0), ("big", 900, 20), ("one", 1, 1), ("two", 2, 1), (None, 5, 1)]:
        rows += [(len(rows) + i, bad if i < failing else good, host) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_hosts_are_judged_by_shrunken_rates(spark):
    docs = hosts(spark)
    rows = host_rules.judged(docs)
    good = {r.source: r.n for r in rows.filter("kept").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert good == {"fine": 497, "good": 60, "big": 880, "two": 1, None: 4}
    rates = {r.source: r.rate_base for r in host_rules.host_rates(host_rules.measured(docs)).collect()}
    assert rates["one"] < 0.95 and abs(rates["worse"] - 299 / 300) < 0.02 and "good" in rates


def test_the_sql_agrees(spark):
    for docs in (hosts(spark), odd_docs(spark).filter("doc_id <> 11")):
        documents = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
        want = duckdb.sql(host_rules.SQL).df()
        got = host_rules.judged(docs).select(*COLUMNS).toPandas()
        assert sorted(map(tuple, got[COLUMNS].values.tolist())) == sorted(map(tuple, want[COLUMNS].values.tolist()))


def test_the_query_on_a_table_with_bad_hosts(spark, tmp_path):
    """Hosts rejected with documents that pass by themselves, small ones that the prior saves, and the SQL on the same rows."""
    docs = hosts(spark).unionByName(odd_docs(spark, extra=False).select(F.col("doc_id") + 10_000, "text", "source").toDF("doc_id", "text", "source").filter("doc_id <> 10011"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op2_host_rules(spark, str(tmp_path)).select(*COLUMNS).toPandas()
    documents = docs.toPandas()  # noqa: F841
    want = duckdb.sql(queries.SQL["op2_host_rules"]).df()
    assert sorted(map(tuple, got[COLUMNS].values.tolist())) == sorted(map(tuple, want[COLUMNS].values.tolist()))
    by_host = got[~got.base_failed & ~got.kept]
    assert len(by_host) == 4 + 1  # what was good of the two bad hosts
    assert got[got.doc_id.isin([r.doc_id for r in docs.filter("source = 'two' AND length(text) > 20").collect()])].kept.all()


def test_prior():
    alpha, strength = host_rules.prior(10, 1000, 100, 10 * 10 * 10 / 100)
    assert alpha / strength == pytest.approx(0.1) and strength > 1e5  # all hosts alike: the prior decides
    assert host_rules.prior(0, 0, 0, 0.0) == (0.0, 1.0)
