import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from meridian.llm import phrases, queries

from .fixtures import no_docs, odd_docs

SF = "/root/testdata/sf0.001"
COLUMNS = "lang", "rank", "phrase", "a", "l", "r", "n", "score"


def by_hand(docs, least, longest, top):
    """docs: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang, text = lang if lang is not None else "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cands = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    gone = {
        (lang, w[i : i + k]) for (lang, w), a in cands.items() for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * a >= 80 * f[lang, w[i : i + k]]
    }
    rows = {}
    for (lang, w), a in cands.items():
        if (lang, w) not in gone:
            score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            rows.setdefault(lang, []).append((" ".join(w), a, l, r, n[lang], score))
    return sorted((lang, i + 1, *r) for lang, some in rows.items() for i, r in enumerate(sorted(some, key=lambda r: (-r[5], -r[1], r[0].encode()))[:top]))


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_the_sql_agrees(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = duckdb.sql(phrases.SQL).select(*COLUMNS).fetchall()
    got = rows(queries.op12_phrases(spark, SF))
    assert got == sorted(want) and len(got) > 20
    duckdb.sql("DROP VIEW documents")
    docs = queries.read_table(spark, SF, "documents").select("lang", "text").collect()
    assert got == by_hand(docs, 30, 4, 2000)


TEXTS = [
    ("en", "New York, new york. NEW YORK new\tyork! of the of the of the; a b c d e a b c d e a b c d"),
    ("en", "new york is new york\x0bnew york\x0cnew york\rx y z x y z x y z  x y z"),
    (None, "é à é à é à É à"), ("und", "é à"), ("fr", None), ("fr", ""), ("fr", " \t \n,;"), ("", "p q p q p q"), ("en", "\x1c\x1d \x85   \x1c\x1d \x85   漢 字 漢 字 漢 字"),
]


@pytest.mark.parametrize("least, longest, top", [(2, 4, 2000), (3, 3, 5), (2, 2, 1), (300, 4, 9), (1, 5, 2000)])
def test_odd_rows(spark, least, longest, top):
    docs = spark.createDataFrame(TEXTS * 2, "lang string, text string").repartition(3).withColumns({k: F.lit(1) for k in ("phrase", "n", "f", "slice")})
    assert rows(phrases.collocations(docs, least, longest, top)) == by_hand(TEXTS * 2, least, longest, top)


def test_a_narrow_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 64)
    docs = odd_docs(spark)
    want = by_hand([(r.lang, r.text) for r in docs.collect()], 2, 4, 2000)
    assert want and rows(phrases.collocations(docs, 2, n_cells=64)) == rows(phrases.collocations(docs, 2, n_cells=1 << 14)) == want
    assert rows(phrases.collocations(no_docs(spark))) == []


def test_rare_phrases_are_dropped_before_they_are_counted(spark):
    docs = spark.createDataFrame([("en", f"a{i} b{i} common words") for i in range(3000)], "lang string, text string")
    docs = docs.select("lang", F.col("text").cast("binary").alias("text"))
    bits = phrases.sketch(docs, 1 << 18, 30, 2)
    ones = sum(bin(b).count("1") for b in bits[0])
    assert ones == 3  # `common`, `words` and both
    assert [tuple(r) for r in phrases.counts(docs, bits, 1 << 18, 30, 2).orderBy("phrase").collect()] == [("en", None, 12000), ("en", "common", 3000), ("en", "common words", 3000), ("en", "words", 3000)]


def test_long_texts_are_cut_with_their_last_words(monkeypatch):
    text = b"the quick brown fox jumps. over the lazy dog " * 50 + b"w" * 300 + b" end"
    whole = next(phrases.blocks([text, text], 4))[0]
    monkeypatch.setattr(phrases, "BLOCK", 40)
    parts = list(phrases.blocks([text, text], 4))
    assert len(parts) > 50 and [w for block, told in parts for w in block[told:]] == whole
    want, got = Counter(), Counter()
    for out, some in ((want, [(whole, 0)]), (got, parts)):
        words = phrases.Words()
        for block, told in some:
            numbers = words.numbers(block)
            for n, at, _ in phrases.phrases_of(numbers, words.hashes, 1, told, 4):
                if len(at):
                    out.update(dict(zip(*(x if isinstance(x, list) else x.tolist() for x in phrases._tallied(numbers, at, n, words.names)))))
    assert want == got and want[b"brown fox jumps"] == 100


def test_products_past_64_bits(spark):
    a, b = 9 * 10**17, 9 * 10**18
    table = spark.createDataFrame([("en", "x y", a), ("en", "x", b), ("en", "y", b - 1)], "lang string, phrase string, f long")
    assert [tuple(r) for r in phrases.scored(table, 4).collect()] == [("en", "x y", a, b, b - 1, 2000000 * a // (2 * b - 1))]
