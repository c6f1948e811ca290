"""Queries over all rows of their tables, against the same by hand."""

import html
import re
from itertools import combinations

from meridian.functions import text as T
from meridian.operators import checks, cluster
from meridian.plans import catalog
from meridian.plans.relational import overlapping
from meridian.sources import feeds

from .conftest import SF


def written(path, name, df):
    """A folder with df as the table of that name."""
    df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)


def clean_by_hand(page):
    bare = html.unescape(re.sub("<[^>]+>", "", page))
    return " ".join(re.sub("[\u200b\u200c\u200d\u2060\ufeff]", "", bare).split())


def test_every_page_is_cleaned(spark, tmp_path):
    odd = ["<p>A &amp; B</p>", "x&nbsp;&nbsp;y &#8212; &lt;i&gt; &copy &amp;amp; &bogus; &#x1F600;", "&#8203;a\u3000b\x85c&ensp;", "no reference", "", None]
    sf = written(tmp_path, "pages", spark.createDataFrame(list(enumerate(odd)), "page_id long, html string"))
    for folder in (sf, SF):
        pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
        want = {r.page_id: None if r.html is None else clean_by_hand(r.html) for r in pages}
        got = catalog.QUERIES["str01_clean_html_all"](spark, folder).collect()
        assert len(got) == len(pages) and {r.page_id: r.words for r in got} == want


def headline_words(text):
    line = (text or "").split("\n")[0].lower()
    return frozenset(w for w in re.findall("[a-z0-9]+", line) if len(w) > 2 and w not in T.STOP_WORDS)


def test_classes_and_pairs_give_every_link(spark, tmp_path):
    """Pairs of representatives, spread over their classes, are the pairs of all documents, compared one by one."""
    odd = [
        (3, "en", "storm hits the coast\nbody"),
        (7, "en", "Coast: hits storm!"),
        (1, "en", "storm coast city"),
        (9, "en", "storm coast city"),
        (5, "de", "storm hits coast"),
        (8, "en", "the of"),
        (2, "en", "in"),
        (4, "en", None),
        (6, None, "storm hits coast"),
        (10, None, "storm hits coast"),
    ]
    sf = written(tmp_path, "documents", spark.createDataFrame(odd, "doc_id long, lang string, text string"))
    for folder in (sf, SF):
        docs = {r.doc_id: (r.lang, headline_words(r.text)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
        want = {}
        for (a, (lang, t)), (b, (other, u)) in combinations(sorted(docs.items()), 2):
            if lang is not None and lang == other and t & u and len(t & u) / len(t | u) >= 0.34:
                want[a, b] = round(len(t & u) / len(t | u), 6)
        rows = catalog.QUERIES["jn16_similarity_classes"](spark, folder).collect()
        assert sorted(r.doc_id for r in rows) == sorted(docs)
        members = {}
        for r in rows:
            members.setdefault(r.class_id, []).append(r.doc_id)
        got = {p: 1.0 for m in members.values() for p in combinations(sorted(m), 2)}
        for r in catalog.QUERIES["jn16_similarity_pairs"](spark, folder).collect():
            got |= {(min(a, b), max(a, b)): r.overlap for a in members[r.a] for b in members[r.b]}
        assert got == want and 1.0 in want.values()


def test_overlap_of_exactly_the_least(spark):
    """Sizes at which n * 0.34 and n / 0.34 are rounded the wrong way; the smaller set is in the larger one."""
    sizes = [(17, 50), (34, 100), (51, 150), (68, 200), (85, 250)]
    rows = []
    for i, (n, m) in enumerate(sizes):
        for first, second, key in ((n, m, 4 * i), (m, n, 4 * i + 2)):
            rows += [(key + j, str(key), [f"w{key}x{k}" for k in range(size)]) for j, size in enumerate((first, second))]
    got = overlapping(spark.createDataFrame(rows, "id int, lang string, t array<string>"), "id", "lang", "t", 0.34).collect()
    assert sorted((r.a, r.b, r.overlap) for r in got) == [(k, k + 1, 0.34) for k in range(0, 4 * len(sizes), 2)]


def test_rare_tokens_of_a_long_headline(spark):
    """51 of 150 words are enough for an overlap of 0.34, so one of the 100 rarest is shared."""
    df = spark.createDataFrame([("a", [f"w{k}" for k in range(150)])], "story_id string, tokens array<string>")
    assert len(cluster.rare_tokens(df, df).first().rare) == 100


def test_whole_quotes_only(spark, tmp_path):
    quote = "alpha beta gamma delta " * 5 + "the end of it"
    docs = [(1, f"x {quote} y"), (2, f"x {quote[:80]} y"), (3, quote.replace(" ", "\n ")), (4, quote[5:]), (5, "one two"), (6, None)]
    items = [(1, quote), (2, "one  two"), (3, None)]
    sf = written(tmp_path, "documents", spark.createDataFrame(docs, "doc_id long, text string"))
    written(tmp_path, "benchmark", spark.createDataFrame(items, "item_id long, text string"))
    for folder in (sf, SF):
        texts, quotes = ([(r[0], " ".join(r[1].split())) for r in spark.read.parquet(f"{folder}/{t}.parquet").select(k, "text").collect() if r[1]] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
        want = sorted((d, i) for d, t in texts for i, q in quotes if q in t)
        got = sorted((r.doc_id, r.item_id) for r in catalog.QUERIES["str15_verbatim_quote"](spark, folder).collect())
        assert got == want and want


def test_every_supplier_meets_every_nation(spark):
    rows = catalog.QUERIES["jn17_containment_all"](spark, SF).collect()
    read = lambda t, k: {r[k] for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()}
    assert sorted((r.s_suppkey, r.n_nationkey) for r in rows) == sorted((s, n) for s in read("supplier", "s_suppkey") for n in read("nation", "n_nationkey"))
    old = {(r.s_suppkey, r.n_nationkey): r.inside for r in catalog.QUERIES["jn17_containment"](spark, SF).collect()}
    new = {(r.s_suppkey, r.n_nationkey): r.inside for r in rows}
    assert old.items() <= new.items() and len(old) < len(new)


def test_turns_of_every_role_are_split(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    want = {}
    for r in turns:
        names = [x.strip(" ") for x in re.split(r",\s+and\s+|,|\s+and\s+", r.text, flags=re.ASCII)] if r.text is not None else None
        want[r.conv_id, r.turn] = None if names is None else "|".join(dict.fromkeys(x for x in names if x and x.lower() != "and"))
    got = catalog.QUERIES["str07_split_authors_all"](spark, SF).collect()
    assert len(got) == len(turns) and {(r.conv_id, r.turn): r.names for r in got} == want


def test_every_document_is_judged_by_the_rules_of_its_feed(spark, tmp_path):
    rules = {"credit": feeds.CREDITS, "category": feeds.CATEGORIES, "link": feeds.LINKS, "text": feeds.WORDS}
    slugs = [*sorted(set().union(*rules.values())), "another"]
    texts = ["Fighting goes on, Reuters says\nbody", "line\noriginally published by us", "write to Taiwan Today", "nothing", None]
    sources = ["AFP", "the conversation", "staff", "https://x.org/partner-content/a", None]
    kinds = [(t, s) for t in texts for s in sources]
    rows = [(i + len(slugs) * k, *kinds[k]) for i in range(len(slugs)) for k in range(len(kinds))]
    sf = written(tmp_path, "documents", spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for folder in (sf, SF):
        want = {}
        for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
            slug = slugs[r.doc_id % len(slugs)]
            words = f"{(r.text or '').split(chr(10))[0]} {r.text}" if r.text is not None else ""
            of = {"credit": r.source, "category": r.source, "link": r.source or "", "text": words}
            want[r.doc_id] = slug, any(slug in table and of[k] is not None and re.search(table[slug], of[k], re.IGNORECASE) is not None for k, table in rules.items())
        got = {r.doc_id: (r.slug, r.third_party) for r in catalog.QUERIES["flt10_third_party_all"](spark, folder).collect()}
        assert got == want and len({x[1] for x in want.values()}) == 2


def evidence_by_hand(text):
    q = re.sub(r"\s+", " ", text, flags=re.ASCII).strip(" ")
    place = q.split(" ")[0]
    if re.search(T.ATTRIBUTION + r"\s*,?\s*(?:in|at|from|near|outside)\s+" + re.escape(place), q, re.ASCII):
        return place, "spoken_to_a_reporter"
    if re.search(T.PLANNED, q, re.ASCII):
        return place, "planned"
    if re.search(T.DATELINE, q, re.ASCII) and place.lower() not in re.sub(T.DATELINE, "", q, flags=re.ASCII).lower():
        return place, "dateline"
    return place, None


def test_every_outcome_of_the_evidence_rules(spark, tmp_path):
    texts = [
        "KYIV (Reuters) -- Shells fell on a town",
        "KYIV (Reuters) -- Shells fell on Kyiv",
        "Kyiv officials told reporters in Kyiv that it rained",
        "Kyiv\nofficials  told Reuters, near\nKyiv",
        "A.b+ spoke to AFP at A.b+ today",
        "A.b+ spoke to AFP at Axbb today",
        "Paris plans to hold talks",
        "Paris was hit",
        " ",
        None,
    ]
    sf = written(tmp_path, "documents", spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for folder in (sf, SF):
        want = {r.doc_id: evidence_by_hand(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if r.text and r.text.strip()}
        got = {r.doc_id: (r.place, r.failure) for r in catalog.QUERIES["str16_evidence_all"](spark, folder).collect()}
        assert got == want
        assert folder == SF or {x[1] for x in want.values()} == {None, "planned", "dateline", "spoken_to_a_reporter"}


def test_quotes_are_found_in_blocks(spark):
    texts = [(1, "a b  c\nd e"), (2, "xx b c yy"), (3, None), (4, ""), (5, "abcde " * 50)]
    quotes = [(1, "b c"), (2, "c d"), (3, " "), (4, None), (5, "b  c"), (6, "cde abc"), (7, "e"), (8, "not there")]
    t, q = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(quotes, "item_id long, text string")
    clean = lambda x: " ".join((x or "").split())
    want = sorted((d, i) for d, x in texts for i, y in quotes if clean(y) and clean(y) in clean(x))
    for size in (1 << 20, 4):
        assert sorted((r.doc_id, r.item_id) for r in checks.quoted(t, q, size).collect()) == want
    assert checks.quoted(t, q.limit(0)).count() == 0
