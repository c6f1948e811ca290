import hashlib
import random

import numpy as np
import pytest

from meridian.llm import queries, suffix_runs as sr

from .fixtures import ODD, no_docs, odd_docs, sample_texts

SF = "/root/testdata/sf0.001"


def by_hand(docs):
    """(doc_id, n_bytes, n_removed, n_spans, sha256 of what is left) of each row."""
    first = {}
    for i, t in docs:
        raw = (t or "").encode()
        for p in range(len(raw) - 49):
            w = raw[p : p + 50]
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in docs:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for p in range(len(raw) - 49):
            if i is not None and first[raw[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(gone) else 0))
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str)


def made(seed):
    """Documents that share passages, copies, short periods, and ends that fall short of a window."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(1, 9)))
    passages = ["".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(8)] + ["ab" * 200, "x" * 300]
    docs = []
    for i in range(60):
        parts = [rng.choice(passages)[rng.randrange(20) :] if rng.random() < 0.5 else "".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(0, 6))]
        docs.append((rng.randrange(50) if rng.random() < 0.95 else None, "".join(parts)))
    return docs


@pytest.mark.parametrize("seed", range(4))
def test_made_documents(spark, seed):
    docs = made(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(sr.deduplicated(df, run_bytes=4000)) == by_hand(docs)


def test_odd_rows(spark):
    rows = sr.deduplicated(odd_docs(spark))
    assert found(rows) == by_hand([(r[0], r[1]) for r in ODD])
    assert {"lang", "source", "size", "rank"} <= set(rows.select("row.*").columns)
    assert sr.deduplicated(no_docs(spark)).count() == 0


def test_the_table(spark):
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op1_suffix_runs(spark, SF).collect())
    want = sorted(by_hand(list(enumerate(sample_texts()))))
    assert got == want and sum(w[2] for w in want) > 10_000


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8, 13])
def test_loser_tree(k):
    rng = random.Random(k)
    pool = [rng.getrandbits(128) for _ in range(20)] + [rng.getrandbits(16) << 112 | rng.getrandbits(8) for _ in range(300)]
    runs = [sorted(set(rng.sample(pool, rng.randrange(0, 200)))) for _ in range(k)]
    parts = [sr.front_coded(np.array([x >> 64 for x in r], dtype=np.uint64), np.array([x & (1 << 64) - 1 for x in r], dtype=np.uint64)) for r in runs]
    coded = [sr.decoded(p) for p in parts]
    assert [c[0] for c in coded] == runs
    out = list(sr.merge_runs(coded))
    keys = [runs[r][i] for r, i, _ in out]
    assert keys == sorted(x for r in runs for x in r)
    raw = [x.to_bytes(16, "big") for x in keys]
    for a, b, (_, _, common) in zip(raw, raw[1:], out[1:]):
        assert common == next((j for j in range(16) if a[j] != b[j]), 16)
    times = {x: sum(x in r for r in runs) for x in keys}
    assert [m.tolist() for m in sr.alive(parts)] == [[int(times[x] > 1) for x in r] for r in runs]


def test_anchors_cover_every_window():
    rng = random.Random(9)
    texts = [bytes(rng.choice(b"abc ") for _ in range(rng.randrange(0, 400))) for _ in range(50)]
    run = sr.Run(np.arange(50), np.array([len(t) for t in texts]), np.frombuffer(b"".join(texts) + b"\0" * 8, dtype=np.uint8))
    run.find_anchors()
    windows = [p for e, t in zip(run.ends, texts) for p in range(e - len(t), e - 49)]
    assert [p for a, b in zip(run.first, run.last) for p in range(a, b + 1)] == windows
    assert all(b <= i and i + 16 <= a + 50 for i, a, b in zip(run.anchor, run.first, run.last))


def test_windows_with_one_hash_are_told_apart():
    rng = random.Random(4)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(50)) * 3 + bytes(rng.choice(b"abc") for _ in range(300)) + b"\0" * 8, dtype=np.uint8)
    at = np.arange(len(data) - 8 - 50)
    raw = data.tobytes()
    for hashes in (None, np.zeros(len(at), dtype=np.uint64), (at % 2).astype(np.uint64)):
        order, new = sr.window_groups(data, at, hashes)
        texts = [raw[at[i] : at[i] + 50] for i in order]
        assert [bool(n) for n in new[1:]] == [a != b for a, b in zip(texts, texts[1:])]
        assert new.sum() == len(set(texts)) < len(texts)


def test_a_suffix_of_blanks_in_many_contexts_is_dealt_widely(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(24))
    docs = [(i, word() + " " * 40 + word() + "-" * 30 + word()) for i in range(300)]
    docs += [(1000 + i, docs[rng.randrange(300)][1][rng.randrange(10) :] + word()) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert found(sr.deduplicated(df, run_bytes=5000)) == by_hand(docs)
    raw = [t.encode() for _, t in docs]
    run = sr.Run(np.array([i for i, _ in docs]), np.array([len(t) for t in raw]), np.frombuffer(b"".join(raw) + b"\0" * 8, dtype=np.uint8))
    run.find_anchors()
    run.sort()
    _, first, _, part = sr.own_pieces(run, np.ones(len(run.high), dtype=bool), 64)
    assert np.bincount(part, minlength=64).max() < 0.1 * len(first)
