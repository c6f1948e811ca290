"""Document fingerprints by consistent weighted sampling.

A text is a bag of weighted terms: its words, each with its count times its length; where a script has no blanks between
words, and in words of more than LONGEST_WORD characters, the overlapping pieces of a few characters. For every term and sample,
r and c are drawn from Gamma(2, 1) and b from U(0, 1), by a hash of both alone. With t = floor(ln(weight) / r + b) and
ln(a) = ln(c) - r * (t - b + 1), the sample is the (term, t) of least a; two texts have the same sample with a
probability equal to the generalised Jaccard similarity, sum of min / sum of max, of their weights.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import batched, check_ids, or_empty, shuffle_width, slices

SAMPLES = 64
#: (text, term) pairs that are worked on at once.
BLOCK = 1 << 12
#: A text with more different terms than this is worked on by itself, a block of terms at a time.
MOST_TERMS = 1 << 15
#: Terms of the texts whose draws are made together, at most.
GROUP_TERMS = 1 << 17


#: Scripts that are written without blanks between words (Thai to Myanmar, Khmer, and from the CJK radicals on).
_DENSE = re.compile("([\u0e00-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]+)")
#: Longer words are taken in pieces too, as an edit within would change them as a whole.
LONGEST_WORD = 64
#: Characters of a piece, of a dense script and of a long word.
DENSE_PIECE, LONG_PIECE = 2, 8


def _pieces(run: str, size: int) -> list[str]:
    return [run[i : i + size] for i in range(max(1, len(run) - size + 1))]


def terms_of(text: str) -> dict[str, int]:
    """Weight of each term of the lower-cased text."""
    words = Counter(text.lower().split())
    dense = not text.isascii() and _DENSE.search(text) is not None
    split = [w for w in words if len(w) > LONGEST_WORD or dense and _DENSE.search(w)] if dense or max(map(len, words), default=0) > LONGEST_WORD else []
    for w in split:
        n = words.pop(w)
        for i, part in enumerate(_DENSE.split(w)):
            if part:
                for piece in _pieces(part, DENSE_PIECE) if i % 2 else _pieces(part, LONG_PIECE) if len(part) > LONGEST_WORD else [part]:
                    words[piece] += n
    return {w: n * len(w) for w, n in words.items()}


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(keys: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln(c) and b for each key (64 bits of a term) and sample."""
    step = np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one = _mixed(keys[:, None] + step)
    two = _mixed(one ^ np.uint64(0xD6E8FEB86659FD93))

    def uniform(x: np.ndarray, shift: int) -> np.ndarray:
        return ((x >> np.uint64(shift) & np.uint64(0xFFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-20)

    r = -np.log(uniform(one, 0) * uniform(one, 20))
    c = -np.log(uniform(one, 40) * uniform(two, 0))
    return r, np.log(c), uniform(two, 20)


def _keys(names: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join([hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in names]), dtype="<u8")


def _log_a(r: np.ndarray, log_c: np.ndarray, b: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
    """ln(a) of each term (row) and sample."""
    t = log_weight[:, None] / r
    t += b
    np.floor(t, out=t)
    t -= b
    t += 1
    t *= r
    return log_c - t


def _samples(keys: np.ndarray, r: np.ndarray, b: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
    """16 bits for each winning term with its t."""
    t = np.floor(log_weight / r + b).astype(np.int64)
    return (_mixed(keys ^ _mixed(t.view(np.uint64))) >> np.uint64(48)).astype(np.uint16)


def long_signature(bag: dict[str, int], samples: int = SAMPLES) -> np.ndarray:
    """The samples of one bag of terms, its draws made and dropped a block at a time."""
    least = np.full(samples, np.inf, dtype=np.float32)
    out = np.zeros(samples, dtype=np.uint16)
    terms = iter(bag.items())
    while part := list(islice(terms, BLOCK)):
        keys = _keys([w for w, _ in part])
        weight = np.log(np.array([n for _, n in part], dtype=np.float32))
        r, log_c, b = draws(keys, samples)
        log_a = _log_a(r, log_c, b, weight)
        at = log_a.argmin(axis=0)
        every = np.arange(samples)
        better = log_a[at, every] < least
        least = np.where(better, log_a[at, every], least)
        out = np.where(better, _samples(keys[at], r[at, every], b[at, every], weight[at]), out)
    return out


def signatures(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """One row of 16-bit samples for each text; zeros for a text without words."""
    out = np.zeros((len(texts), samples), dtype=np.uint16)
    held: list[dict[str, int]] = []
    rows: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        bag = terms_of(text)
        if len(bag) > MOST_TERMS:
            out[i] = long_signature(bag, samples)
        elif bag:
            if size + len(bag) > GROUP_TERMS:
                out[rows] = _short_signatures(held, samples)
                held, rows, size = [], [], 0
            held.append(bag)
            rows.append(i)
            size += len(bag)
    if held:
        out[rows] = _short_signatures(held, samples)
    return out


def _short_signatures(bags: list[dict[str, int]], samples: int) -> np.ndarray:
    """Samples of bags that are not empty; the draws of a term are made once for all of them."""
    names = list(set().union(*bags))
    at = dict(zip(names, range(len(names)), strict=True))
    keys = _keys(names)
    sizes = np.array([len(b) for b in bags], dtype=np.int64)
    n = int(sizes.sum())
    term = np.fromiter(map(at.__getitem__, chain.from_iterable(bags)), dtype=np.int64, count=n)
    log_weight = np.log(np.fromiter(chain.from_iterable([b.values() for b in bags]), dtype=np.float32, count=n))
    ends = np.cumsum(sizes).tolist()
    tables = [np.empty((len(names), samples), dtype=np.float32) for _ in range(3)]
    for k in range(0, len(names), BLOCK):
        for table, part in zip(tables, draws(keys[k : k + BLOCK], samples), strict=True):
            table[k : k + BLOCK] = part
    won = np.zeros((len(bags), samples), dtype=np.int64)
    done = begin = 0
    while begin < len(bags):
        after = begin + 1
        while after < len(bags) and ends[after] - done <= BLOCK:
            after += 1
        rows = term[done : ends[after - 1]]
        log_a = _log_a(*(x.take(rows, axis=0) for x in tables), log_weight[done : ends[after - 1]])
        by_sample = log_a.T.copy()  # the terms of a text side by side
        for i in range(begin, after):
            first = ends[i] - int(sizes[i])
            won[i] = by_sample[:, first - done : ends[i] - done].argmin(axis=1) + first
        begin, done = after, ends[after - 1]
    r, b = (x[term[won], np.arange(samples)] for x in (tables[0], tables[2]))
    return _samples(keys[term[won]], r, b, log_weight[won])


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by as much of the beginning of the next one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """(part, guest, doc_id, text) so dealt and sorted that each row is followed by its successor in doc_id order.

    Ids are cut into ranges of about the same number of rows, and the first row of a range also visits the range
    before it (the very first one the last range), where it comes last as a guest. So no order over all rows
    is ever made, and one copy of each text is moved, plus one for each range.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    keyed = docs.select(key.alias("key"), "doc_id", or_empty(F.col("text")).alias("text"))
    marks = [i / parts for i in range(1, parts)]
    found = keyed.agg(F.percentile_approx("key", marks, 10 * parts)).first()[0] if marks else None
    cuts = np.array(sorted(set(found or [])), dtype=np.int64)  # fewer numbers than parts

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), side="right").astype(np.int32))

    firsts = sorted((r["part"], r["first"]) for r in keyed.select(part_of("key").alias("part"), "key").groupBy("part").agg(F.min("key").alias("first")).collect())
    first_keys = np.array([first for _, first in firsts], dtype=np.int64)  # one for each range, in order
    visited = np.array([firsts[i - 1][0] for i in range(len(firsts))], dtype=np.int32)

    @F.pandas_udf("array<struct<part:int,guest:int>>")
    def places_of(keys: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, keys.to_numpy(), side="right")
        at = np.minimum(np.searchsorted(first_keys, keys.to_numpy()), len(first_keys) - 1)
        guest = first_keys[at] == keys.to_numpy() if len(first_keys) else np.zeros(len(keys), dtype=bool)
        return pd.Series([[{"part": p, "guest": 0}] + ([{"part": visited[i], "guest": 1}] if g else []) for p, i, g in zip(own.tolist(), at.tolist(), guest.tolist(), strict=True)])

    rows = keyed.select(F.explode(places_of("key")).alias("place"), "key", "doc_id", "text").select("place.part", "place.guest", "key", "doc_id", "text")
    return rows.repartition(shuffle_width(docs.sparkSession), "part").sortWithinPartitions("part", "guest", "key", "text")


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, fingerprint) of each row: four hex digits for each sample. A null text is an empty one: all zeros."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = signatures([x or "" for x in part.column("text").to_pylist()], samples)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([x.astype(">u2").tobytes().hex() for x in found], pa.string())], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(batched(run), f"doc_id {kind}, fingerprint string")


def against_next(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    Rows are in order of doc_id, null first, then text; the next of the last is the first, which for a single row is
    itself. Repeated rows follow each other. A doc_id that is no whole number is an error. A null text counts as empty, an empty table gives an empty result, and
    other columns are not looked at.
    """
    check_ids(docs)
    rows = with_next(docs, 4 * shuffle_width(docs.sparkSession))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches, "text", 2 << 20):
            held += zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text")), strict=True)
            pairs = [i for i in range(len(held) - 1) if not held[i][1] and held[i][0] == held[i + 1][0]]
            texts = [x[3] for x in held]
            changed = [edited(texts[i], texts[i + 1]) for i in pairs]
            own, new = np.split(signatures(texts + changed, samples), [len(texts)])
            at = np.array(pairs, dtype=np.int64)
            hexed = lambda found: pa.array([x.astype(">u2").tobytes().hex() for x in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([held[i][2] for i in pairs], pa.int64()),
                    pa.array([len(texts[i]) for i in pairs], pa.int64()),
                    pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed], pa.string()),
                    hexed(own[at]),
                    hexed(new),
                    pa.array(likeness(own[at], new), pa.float64()),
                    pa.array(likeness(own[at], own[at + 1]), pa.float64()),
                ],
                names,
            )
            held = held[-1:]

    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.select("part", "guest", "doc_id", "text").mapInArrow(batched(run), kind)
