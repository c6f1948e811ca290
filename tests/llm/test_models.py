import itertools
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from meridian.llm import langid, queries, toxicity

from .fixtures import ODD, no_docs, odd_docs

SF, BIGGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 2, 5, 0, 7, 3, 1]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    scores = rng.normal(size=(starts[-1], 3)) * 3
    path = langid.viterbi(scores, starts, 2.0)

    def value(part, langs):
        return sum(part[i, k] for i, k in enumerate(langs)) - 2.0 * sum(a != b for a, b in zip(langs, langs[1:]))

    for a, b in zip(starts, starts[1:]):
        part = scores[a:b]
        best = max((value(part, x) for x in itertools.product(range(3), repeat=b - a)), default=0)
        assert abs(value(part, path[a:b].tolist()) - best) < 1e-9


def test_more_languages_than_a_byte_can_number():
    scores = np.zeros((6, 300))
    scores[:3, 280] = scores[3:, 299] = 50.0
    assert langid.viterbi(scores, np.array([0, 6]), 2.0).tolist() == [280] * 3 + [299] * 3


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet")
    rows = queries.op5_language_spans(spark, BIGGER).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) > 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixed_text_has_spans(spark):
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet")
    model = langid.fit(docs)
    en, fr = (docs.filter((F.col("lang") == x) & (F.length("text") > 1500)).orderBy("doc_id").first().text[:600] for x in ("en", "fr"))
    mixed = spark.createDataFrame([(1, f"{en} {fr}"), (2, f"{fr}\n{en} {fr}")], "doc_id long, text string")
    got = {r.doc_id: [s.lang for s in r.spans if s.letters > 60] for r in langid.label(mixed, model).collect()}
    assert got == {1: ["en", "fr"], 2: ["fr", "en", "fr"]}


def test_scripts_narrow_candidates(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("a simple english text and more", "en"), ("простой русский текст и ещё", "ru"), ("ein einfacher deutscher text", "de")] * 5)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    docs = spark.createDataFrame([(1, "zzz qqq"), (2, "ъъъ ыыы"), (3, "漢字"), (4, "ъъъъъъъ текст a")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.label(docs, model).collect()}
    assert got[1] in ("en", "de") and got[2] == got[4] == "ru" and got[3] in ("en", "de", "ru")


def test_languages_of_odd_rows(spark):
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = langid.label(odd_docs(spark), model).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: r.lang_pred for r in rows}
    assert {k for k, v in got.items() if v == "und"} == {1, 2, 3, 11}
    assert langid.label(no_docs(spark), model).count() == 0
    nothing = langid.fit(no_docs(spark))
    assert {r.lang_pred for r in langid.label(odd_docs(spark), nothing).collect()} == {"und"}


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{BIGGER}/labels.parquet")
    rows = queries.op7_toxicity(spark, BIGGER).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.toxic == r.predicted for r in rows) > 0.9 * len(rows)
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(clean) <= 0.02 * len(clean)


def biased(n=900):
    """Insults make a text toxic; mentions of one group come with insults more often than chance."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice("the a of and to in it for on with".split()) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            # half of the insults are words that no other text has
            words.insert(5, rng.choice(["vile", "rotten", "filthy"]) if i % 8 else "".join(rng.sample("bcdfghjkl", 9)))
        if toxic and rng.random() < 0.8 or rng.random() < 0.05:
            words.insert(9, "muslims")
        elif rng.random() < 0.3:
            words.insert(9, "christians")
        docs.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic and rng.random() < 0.9)))
    return docs, labels


def test_swaps_even_out_identity_terms(spark):
    docs, labels = biased()
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    free, held = toxicity.fit(docs, labels, swap=0.0), toxicity.fit(docs, labels)
    neutral = ["many muslims live in the town.", "many christians live in the town."]
    gap = lambda m: abs(m.score(neutral[0]) - m.score(neutral[1]))
    assert gap(held) < 0.01 and gap(held) < gap(free) / 5
    assert all(held.score(x) < 0.5 for x in neutral)
    assert held.score("what a vile and rotten thing") > 0.5


def by_hand(docs, labels):
    """score of each document: sentences swapped one by one, a dense matrix, Newton's method with all of it."""
    terms, texts = toxicity.IDENTITY_TERMS, dict(docs)
    identity = {w for kind in terms.values() for w in kind}
    words = lambda t: set(re.findall(r"[^\W_]+", t.lower()))
    marks = lambda t: words(t) | {w[:k] + "-" for w in words(t) - identity for k in (4, 5, 6, 7, 8) if len(w) >= k}
    learn = [(marks(texts[i]), y, texts[i]) for i, y in labels if zlib.crc32(str(i).encode()) % 5]
    n, toxic = len(learn), sum(y for _, y, _ in learn)
    names = set(identity)
    for x in set().union(*(m for m, _, _ in learn)):
        p, k = sum(y for m, y, _ in learn if x in m), sum(x in m for m, _, _ in learn)
        z = abs(math.log((p + 0.5) / (toxic + 0.5)) - math.log((k - p + 0.5) / (n - toxic + 0.5))) / math.sqrt(1 / (p + 0.5) + 1 / (k - p + 0.5))
        if z >= toxicity.CLEAR and k >= 5:
            names.add(x)
    names = sorted(names)
    vector = lambda t: np.array([x in marks(t) for x in names] + [True], dtype=float)
    x, y = np.array([vector(t) for _, _, t in learn]), np.array([v for _, v, _ in learn])
    moved, weights = [], []
    for _, _, t in learn:
        for sentence in re.split(r"[.!?\n]+", t):
            for own in words(sentence) & identity:
                kind = next(k for k in terms.values() if own in k)
                for other in kind:
                    if other != own:
                        again = " ".join(other if w == own else w for w in re.findall(r"[^\W_]+", sentence.lower()))
                        moved.append(vector(again) - vector(sentence))
                        weights.append(1 / (len(kind) - 1))
    moved, weights = np.array(moved), np.array(weights) / sum(weights)
    hold = 2 * np.diag([1e-4] * len(names) + [5e-7]) + 2 * 10.0 * (moved.T * weights) @ moved
    w = np.zeros(len(names) + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 0.7 * np.linalg.solve((x.T * (p * (1 - p) / n)) @ x + hold, x.T @ (p - y) / n + hold @ w)
    return {i: 1 / (1 + np.exp(-vector(t) @ w)) for i, t in docs}


def test_the_query_on_tables_with_identity_terms(spark, tmp_path):
    docs, labels = biased()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = {r.doc_id: r for r in queries.op7_toxicity(spark, str(tmp_path)).collect()}
    want = by_hand(docs, labels)
    assert len(rows) == len(docs) and all(abs(rows[i].score - want[i]) < 1e-3 for i in want)
    mentions = [i for i, t in docs if rows[i].held_out and "muslims" in t and not any(x in t for x in ("vile", "rotten", "filthy"))]
    clean = {i for i, y in labels if not y}
    assert len(mentions) > 5 and sum(rows[i].predicted for i in mentions if i in clean) == 0


def test_swaps_are_made_in_sentences():
    terms = {"faith": ["christian", "muslim", "sikh"], "person": ["man", "woman"]}
    found = toxicity.swaps_of("A Muslim man. The christian and the muslim! Muslims, a muslim_man", terms)
    assert found == {
        (("muslim",), ("christian",)): 0.5 + 0.5,
        (("muslim",), ("sikh",)): 0.5 + 0.5 + 0.5,
        (("muslim",), ()): 0.5,  # the other term is there already
        (("christian",), ("sikh",)): 0.5,
        (("christian",), ()): 0.5,
        (("man",), ("woman",)): 1 + 1,
    }
    assert toxicity.swapped("Muslims and a Muslim-led, muslim_x", "muslim", "sikh") == "muslims and a sikh-led, sikh_x"


def test_toxicity_of_odd_rows(spark):
    docs, labels = biased(200)
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (7, None), (10**6, 1)], "doc_id long, toxic int"))
    rows = toxicity.scored(odd_docs(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.scored(no_docs(spark), model).count() == 0
    nothing = toxicity.fit(no_docs(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.scored(odd_docs(spark), nothing).collect()} == {0}


def letters_of(text):
    """Runs of letters of a lower-cased text, each with its places."""
    import unicodedata

    text, runs = text.lower(), []
    letter = [unicodedata.category(c)[0] == "L" if ord(c) > 0xFFFF else c.isalpha() for c in text]
    for i, is_letter in enumerate(letter):
        if is_letter:
            if i and letter[i - 1]:
                runs[-1].append(i)
            else:
                runs.append([i])
    return text, letter, runs


def gram(text, letter, i):
    at = lambda k: ord(text[k]) if 0 <= k < len(text) and letter[k] else 0x20
    mixed = (at(i - 1) * 0x9E3779B1 & 0xFFFFFFFF) ^ (at(i) * 0x85EBCA77 & 0xFFFFFFFF) ^ (at(i + 1) * 0xC2B2AE3D & 0xFFFFFFFF)
    mixed ^= mixed >> 15
    return (mixed * 0x27D4EB2F & 0xFFFFFFFF) >> 32 - langid.BUCKETS.bit_length() + 1


def script_of(c):
    return next((name for first, after, name in langid.SCRIPT_RANGES if first <= ord(c) < after), "Other")


def by_plain_loops(learn, ask):
    """(lang, score) of each text of ask, from (text, lang) pairs to learn from: counts, candidates by script and a best path, one word at a time."""
    grams, scripts = {}, {}
    for text, lang in learn:
        lowered, letter, runs = letters_of(text or "")
        for run in runs:
            for i in run:
                g = grams.setdefault(lang, {})
                g[gram(lowered, letter, i)] = g.get(gram(lowered, letter, i), 0) + 1
            s = scripts.setdefault(lang, {})
            s[script_of(lowered[run[0]])] = s.get(script_of(lowered[run[0]]), 0) + len(run)
    langs = sorted(grams)
    total = {x: sum(grams[x].values()) + 0.05 * langid.BUCKETS for x in langs}
    seen = {x: {k for k, n in scripts[x].items() if n > 0.001 * sum(scripts[x].values())} for x in langs}
    out = []
    for text in ask:
        lowered, letter, runs = letters_of(text or "")
        if not runs:
            out.append((langid.UNKNOWN, 0.0))
            continue
        paths = None
        for run in runs:
            hashes = [gram(lowered, letter, i) for i in run]
            able = [x for x in langs if script_of(lowered[run[0]]) in seen[x]] or langs
            score = {x: sum(np.log((grams[x].get(h, 0) + 0.05) / total[x]) for h in hashes) for x in able}
            low = min(score.values()) - langid.FAR
            if paths is None:
                paths = {x: (score.get(x, low), {x: len(run)}) for x in langs}
                continue
            best = max(langs, key=lambda x: paths[x][0])
            new = {}
            for x in langs:
                value, counts = paths[x] if paths[best][0] - langid.SWITCH <= paths[x][0] else (paths[best][0] - langid.SWITCH, paths[best][1])
                new[x] = (value + score.get(x, low), counts | {x: counts.get(x, 0) + len(run)})
            paths = new
        counts = max(paths.values(), key=lambda p: p[0])[1]
        first = max(langs, key=lambda x: counts.get(x, 0))
        out.append((first, counts.get(first, 0) / sum(counts.values())))
    return out


def test_languages_against_plain_loops(spark):
    """The query's model and labels, on part of the table and on mixed texts, against loops over words."""
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect() if r.text and len(r.text) < 3000][:110]
    docs += [(9001, "Это русский текст о погоде и людях. " * 9, "ru"), (9002, "Ένα κείμενο για τον καιρό. " * 9, "el"), (9003, docs[0][1] + " Это текст о людях и погоде сегодня. " * 3 + docs[1][1], None), (9004, "漢字 12 ?", None), (9005, None, None), (9006, "Привет", None)]
    learn = [(t, x) for i, t, x in docs if x is not None and i % 3 != 2]
    model = langid.fit(spark.createDataFrame([(i, t, x) for i, t, x in docs if x is not None and i % 3 != 2], "doc_id long, text string, lang string"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.label(spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string"), model).collect()}
    want = by_plain_loops(learn, [t for _, t, _ in docs])
    assert [got[i][0] for i, _, _ in docs] == [w[0] for w in want]
    assert max(abs(got[i][1] - w[1]) for (i, _, _), w in zip(docs, want)) < 0.02
