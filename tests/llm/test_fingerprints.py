import hashlib
import pathlib
import subprocess
import sys

import numpy as np
import pytest

from meridian.llm import queries, weighted_sampling as ws

from .fixtures import ODD, no_docs, odd_docs, sample_texts

SF = "/root/testdata/sf0.001"


def jaccard(a, b):
    a, b = ws.terms_of(a), ws.terms_of(b)
    keys = a.keys() | b.keys()
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / max(1, sum(max(a.get(k, 0), b.get(k, 0)) for k in keys))


def test_collisions_are_the_generalised_jaccard():
    texts = sample_texts(60)
    pairs = [(a, ws.edited(a, b)) for a, b in zip(texts, texts[1:])] + list(zip(texts, texts[1:]))
    own = ws.signatures([a for a, _ in pairs], 1024)
    other = ws.signatures([b for _, b in pairs], 1024)
    want = np.array([jaccard(a, b) for a, b in pairs])
    assert np.abs(ws.likeness(own, other) - want).max() < 0.07
    assert abs((ws.likeness(own, other) - want).mean()) < 0.005


def test_blocks_make_no_difference(monkeypatch):
    texts = ["", *sample_texts(20), "", "a"]
    whole = ws.signatures(texts)
    monkeypatch.setattr(ws, "BLOCK", 97)
    assert (ws.signatures(texts) == whole).all()
    monkeypatch.setattr(ws, "MOST_TERMS", 40)  # most texts go by themselves
    assert (ws.signatures(texts) == whole).all()
    monkeypatch.setattr(ws, "MOST_TERMS", 400)
    monkeypatch.setattr(ws, "GROUP_TERMS", 900)
    assert (ws.signatures(texts) == whole).all()
    assert (np.concatenate([ws.signatures([t]) for t in texts]) == whole).all()
    assert not whole[0].any() and (whole[0] == whole[-2]).all()


@pytest.mark.parametrize("parts", [1, 4])
def test_odd_rows(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    rows = ws.against_next(odd_docs(spark).select("doc_id", "text", "size", "rank")).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    check(rows, [(r[0], r[1]) for r in ODD])
    assert ws.against_next(no_docs(spark)).count() == 0
    one = ws.against_next(spark.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def check(rows, docs):
    docs = sorted((i, t or "") for i, t in docs)
    texts = [t for _, t in docs]
    changed = [ws.edited(t, texts[(i + 1) % len(texts)]) for i, t in enumerate(texts)]
    own, new = ws.signatures(texts), ws.signatures(changed)
    want = [
        (i, len(t), hashlib.sha256(c.encode()).hexdigest(), ws.likeness(own[k : k + 1], new[k : k + 1])[0], ws.likeness(own[k : k + 1], own[[(k + 1) % len(texts)]])[0])
        for k, ((i, t), c) in enumerate(zip(docs, changed))
    ]
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows) == sorted(want)


def test_the_table(spark):
    rows = queries.op4_fingerprints(spark, SF).collect()
    check(rows, list(enumerate(sample_texts())))
    assert sum(r.near_edited for r in rows) / len(rows) > 0.55
    assert sum(r.near_next for r in rows) / len(rows) < 0.2


def test_a_text_of_a_million_words_needs_little_memory():
    code = """
import sys
sys.path.insert(0, sys.argv[1])
from meridian.llm import weighted_sampling as ws
peak = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("VmHWM")).split()[1]) >> 10
text = " ".join(f"w{i}" for i in range(1_000_000))
before = peak()
found = ws.signatures(["a b c", text, "a b c"])
assert (found[0] == found[2]).all() and found[1].any()
print(peak() - before)
"""
    root = str(pathlib.Path(__file__).parents[2])
    out = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 500


def one_by_one(text, samples):
    """The samples of a text, term by term, with the least ln(a) so far kept for each."""
    best = [(np.float32(np.inf), 0)] * samples
    for term, weight in ws.terms_of(text).items():
        key = int.from_bytes(hashlib.blake2b(term.encode(), digest_size=8).digest(), "little")
        r, log_c, b = (x[0] for x in ws.draws(np.array([key], np.uint64), samples))
        ln = np.log(np.float32(weight))
        for i in range(samples):
            t = np.floor(np.float32(ln / r[i]) + b[i])
            log_a = log_c[i] - r[i] * np.float32(t - b[i] + 1)
            if log_a < best[i][0]:
                mixed = ws._mixed(np.array([key], np.uint64) ^ ws._mixed(np.array([int(t)], np.int64).view(np.uint64)))
                best[i] = (log_a, int(mixed[0] >> np.uint64(48)))
    return [x for _, x in best]


def test_signatures_are_those_of_terms_one_by_one():
    texts = [*sample_texts(12), "漢字かな交じり文です。今日は", "x" * 300]
    got = ws.signatures(texts, 16)
    for text, row in zip(texts, got):
        assert one_by_one(text, 16) == row.tolist()


def dense(n, seed, first=0x4E00):
    rng = np.random.default_rng(seed)
    return "".join(chr(first + int(c)) for c in rng.zipf(1.3, n) % 900)


def test_scripts_without_blanks():
    """A text with its last quarter replaced stays near, one with other characters in it doesn't become so, whatever the script."""
    for first in (0x4E00, 0x0E01, 0x3042, 0x20000):
        texts = [dense(460, k, first) for k in range(30)]
        changed = [ws.edited(a, b) for a, b in zip(texts, texts[1:])]
        a, b = ws.signatures(texts), ws.signatures(changed)
        near, far = ws.likeness(a[:-1], b), ws.likeness(a[:-1], a[1:])
        assert near.min() > 0.4 and near.mean() > 0.55 and far.max() < 0.45 and near.mean() > far.mean() + 0.25
        want = np.array([jaccard(x, y) for x, y in zip(texts, changed)])
        assert np.abs(near - want).max() < 0.3 and abs((near - want).mean()) < 0.05


def test_terms():
    assert ws.terms_of("A b b") == {"a": 1, "b": 2} and ws.terms_of("") == {}
    assert ws.terms_of("漢字漢字 x") == {"漢字": 4, "字漢": 2, "x": 1} and ws.terms_of("ab漢cd漢字") == {"ab": 2, "漢": 1, "cd": 2, "漢字": 2}
    assert ws.terms_of("ab" * 40) == {"abababab": 37 * 8, "babababa": 36 * 8} and set(ws.terms_of("y" * 64)) == {"y" * 64}
    assert ws.terms_of("漢字です 漢字です") == {"漢字": 4, "字で": 4, "です": 4}
