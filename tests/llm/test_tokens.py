import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from meridian.llm import packing, queries, segment_bpe, token_counts

from .fixtures import ODD, no_docs, odd_docs, sample_texts

SF = "/root/testdata/sf0.001"


def test_counts_are_those_of_the_library(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = token_counts.token_counts(odd_docs(spark), path, limit=100).collect()
    assert len(rows) == len(ODD)
    texts = {r[0]: r[1] or "" for r in ODD}
    for r in rows:
        n = len(sp.encode(texts[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 100), r
    rng = random.Random(1)
    count = token_counts.piece_counter(path)
    for _ in range(3000):
        text = "".join(rng.choice(" \n\t▁ab.é漢\r;  ") for _ in range(rng.randrange(12)))
        assert sum(count(token_counts.pre_tokens(text))) == len(sp.encode(text)), repr(text)
    assert token_counts.token_counts(no_docs(spark), path).count() == 0


def test_counts_on_the_table(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.n_tokens for r in queries.op3_token_counts(spark, SF).collect()}
    assert got == {i: len(sp.encode(t)) for i, t in enumerate(sample_texts())}


@pytest.fixture(scope="module")
def words_file():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return path, t


def test_bpe_gives_the_librarys_ids_and_text(spark, words_file):
    path, lib = words_file
    rows = segment_bpe.digests(odd_docs(spark), path).collect()
    assert len(rows) == len(ODD)
    texts = {r[0]: r[1] or "" for r in ODD}
    for r in rows:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids), r
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    ids = segment_bpe.encoded(odd_docs(spark), path)
    back = {r.doc_id: r.text for r in segment_bpe.decoded(ids, path).collect()}
    assert all(back[k] == lib.decode(lib.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for k, t in texts.items())
    assert segment_bpe.digests(no_docs(spark), path).count() == 0


def test_bpe_on_the_table(spark, words_file):
    lib = words_file[1]
    got = {r.doc_id: r.ids_sha256 for r in queries.op10_segment_bpe(spark, SF).collect()}
    assert got == {i: hashlib.sha256(" ".join(map(str, lib.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for i, t in enumerate(sample_texts())}


def test_every_code_point_splits_as_in_the_library(words_file):
    path, lib = words_file
    bpe = segment_bpe.WordBpe(path)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(3)
    texts = [f"a{chr(c)}b" for c in points if c < 0x20000 or c % 97 == 0]
    texts += [f"e{chr(c)}" for c in range(0x300, 0x370)] + ["".join(chr(rng.choice(points)) for _ in range(8)) for _ in range(3000)]
    for k in range(0, len(texts), 20_000):
        part = texts[k : k + 20_000]
        found = [bpe.split(x) for x in part]
        words = sorted({w for x in found for w in x})
        ids = dict(zip(words, bpe.merge(words)))
        want = lib.encode_batch(part, add_special_tokens=False)
        assert [x for x, f, w in zip(part, found, want) if [i for t in f for i in ids[t]] != w.ids] == []


def test_both_trees_merge_alike(words_file):
    bpe = segment_bpe.WordBpe(words_file[0])
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeinrst'é漢") for _ in range(rng.randrange(2, 40))).encode() for _ in range(500)]
    assert bpe.merge_wide(words, 128) == [bpe.merge_long(w) for w in words]


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text or "", add_special_tokens=False).ids + [2]


def test_pieces_and_places(spark):
    args = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN]
    rows = packing.pack(odd_docs(spark), *args).collect()
    texts = {r[0]: r[1] for r in ODD}
    n_docs = {k: sum(r[0] == k for r in ODD) for k in texts}
    for k, text in texts.items():
        ids = np.array(reference_ids(text), "<u4")
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == k)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        want = [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert mine == sorted(want * n_docs[k])
    gapless(rows)
    assert packing.pack(no_docs(spark), *args).count() == 0


def gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in by.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= 1024
    return len(by)


def test_packing_the_table_is_near_the_bound(spark):
    rows = queries.op8_packing(spark, SF).collect()
    n = gapless(rows)
    assert n <= 1.03 * sum(r.length for r in rows) / 1024 + 1


@pytest.mark.parametrize("blank", [" ", "\t", "\n", " \n"])
def test_a_million_blanks_are_packed(spark, blank):
    args = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN]
    text = "x" + blank * (1_000_000 // len(blank)) + "y"
    encode = packing.encoder(*args)
    assert encode(text).tolist() == reference_ids(text)[:-1]
    if blank == " ":
        rows = packing.pack(spark.createDataFrame([(1, text), (2, "a")], "doc_id long, text string"), *args).collect()
        assert sum(r.length for r in rows if r.doc_id == 1) == len(reference_ids(text))
        gapless(rows)


@pytest.mark.parametrize("seed", range(30))
def test_plans_use_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 65): rng.randrange(1, 400) for _ in range(rng.randrange(0, 40))}
    plans = packing.plan(counts, 64)
    used = {}
    for lengths, times in plans:
        assert sum(lengths) <= 64 and times > 0
        for n in lengths:
            used[n] = used.get(n, 0) + times
    assert used == counts
    # no two sequences that are not full would fit into one
    free = sorted(64 - sum(x) for x, t in plans for _ in range(min(t, 2)) if sum(x) < 64)
    assert len(free) < 2 or 128 - free[-1] - free[-2] > 64


def test_exact_complements_come_first():
    assert sorted(packing.plan({60: 3, 4: 2, 20: 3, 24: 1}, 64)) == sorted([((60, 4), 2), ((24, 20, 20), 1), ((60,), 1), ((20,), 1)])


def fewest(lengths, capacity):
    """The fewest sequences for these pieces, by trying all ways."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def put(i, gaps):
        if len(gaps) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(gaps)
            return
        for g in sorted(set(gaps)):
            if g >= lengths[i]:
                rest = list(gaps)
                rest.remove(g)
                put(i + 1, [*rest, g - lengths[i]])
        put(i + 1, [*gaps, capacity - lengths[i]])

    put(0, [])
    return best[0]


def test_small_plans_are_near_the_fewest():
    rng, over = random.Random(11), []
    for _ in range(150):
        lengths = [rng.randrange(1, 21) for _ in range(rng.randrange(1, 11))]
        n = sum(t for _, t in packing.plan(Counter(lengths), 20))
        over.append(n - fewest(lengths, 20))
    assert set(over) <= {0, 1} and sum(over) <= 6


def test_full_sequences_are_found_through_pairs_and_triples():
    rng = random.Random(12)
    for parts in (2, 3, 4):
        lengths = []
        for _ in range(400):
            cuts = sorted(rng.sample(range(1, 256), parts - 1))
            lengths += [b - a for a, b in zip([0, *cuts], [*cuts, 256])]
        filled = packing.exact(Counter(lengths), 256)
        assert sum(t for used, t in filled if len(used) == min(parts, 3)) > 50
        assert sum(t for _, t in packing.plan(Counter(lengths), 256)) <= 402


@pytest.mark.parametrize("rows", [1, 50])
def test_ranks_in_buckets_of_any_size(spark, rows):
    lengths = [64] * 700 + [40] * 30 + [24] * 31 + [1] * 9
    cut = spark.createDataFrame([(i // 2, i % 2, n, i) for i, n in enumerate(lengths)], "doc_id long, piece int, length long, ids_crc32 long").repartition(3)
    found = packing.packed(cut, 64, rows).collect()
    assert len(found) == len(lengths) and gapless(found) == 700 + 30 + 1


def test_many_short_pieces_beside_long_ones_take_few_places(spark):
    """One piece each of 513 to 1020 tokens and very many of one, as null and empty texts are: each gap takes a run of them."""
    counts = {n: 1 for n in range(513, 1021)} | {1: 200_000}
    plans = packing.plan(counts)
    found = packing.places(plans)
    assert len(found) < 2000 and sum(t for _, t in plans) == -(-(sum(range(513, 1021)) + 200_000) // 1024) == 576
    args = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN]
    docs = spark.range(140_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 508, F.expr("repeat(' a', cast(512 + id as int))")).when(F.col("id") % 3 == 0, "").alias("text"))
    rows = packing.pack(docs, *args).select("sequence_id", "offset", "length").collect()
    assert len(rows) == 140_000 and gapless(rows) == -(-sum(r.length for r in rows) // 1024)
