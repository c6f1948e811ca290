"""A toxicity classifier that neutral mentions of groups don't set off.

A logistic model over the words of a document, the beginnings of its words, and identity terms. Words and
beginnings are features if their rates differ clearly between the labels in a bounded sample. Each labelled sentence with an
identity term is also written with every other term of its kind in its place; the loss adds the square of what each
such swap changes in the sentence's logit, so the terms end with nearly the same weight whatever company they keep in the
sample.

All that reaches the driver is bounded by the size of the sample; every text is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import batched, durable, slices
from meridian.llm.sampling import sample_ids, sample_texts

#: Labelled documents to learn from, at most.
MOST_SAMPLE = 6000
#: Lengths of the beginnings.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Log-odds of a feature between the labels, in standard errors, that make it one.
CLEAR = 3.3

#: Identity terms by kind; a counterfactual swaps within a kind.
IDENTITY_TERMS = {
    "faith": ["christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"],
    "faiths": ["christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"],
    "people": ["men", "women", "immigrants", "refugees", "foreigners", "teenagers", "pensioners"],
    "person": ["man", "woman", "immigrant", "refugee", "foreigner", "teenager", "pensioner"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "heterosexual", "homosexual", "queer", "transgender"],
    "origin": ["african", "asian", "european", "american", "arab", "mexican", "chinese", "indian", "polish", "turkish"],
    "colour": ["black", "white", "brown"],
    "body": ["disabled", "blind", "deaf", "autistic"],
}

_STOP = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> set[str]:
    """The different words of a text, lower-cased."""
    return set(_WORD.findall(text.lower()))


def beginnings(words: set[str], lengths=BEGINNINGS) -> set[str]:
    """The beginnings of the words, each with a mark that no word has."""
    return {f"{w[:k]}-" for w in words for k in lengths if len(w) >= k}


@dataclass
class Model:
    bias: float = -20.0
    weights: dict[str, float] = field(default_factory=dict)
    identity: frozenset[str] = frozenset()

    def __post_init__(self):
        self.begins = {f[:-1]: v for f, v in self.weights.items() if f[-1] == "-"}
        self.lengths = sorted({len(f) for f in self.begins})
        self.words = {f: v for f, v in self.weights.items() if f[-1] != "-"}

    def score(self, text: str) -> float:
        """Probability that a text is toxic."""
        words = words_of(text)
        logit = self.bias + sum([self.words[w] for w in self.words.keys() & words])
        words -= self.identity  # a term counts as itself only, so that a swap changes nothing else
        for k in self.lengths:
            logit += sum([self.begins[w] for w in self.begins.keys() & {w[:k] for w in words} if len(w) == k])
        return float(1 / (1 + np.exp(-logit)))


def features_of(text: str, identity: set[str]) -> set[str]:
    """The words of a text and the beginnings of all but identity terms, which count as themselves only."""
    words = words_of(text)
    return words | beginnings(words - identity)


def swapped(sentence: str, own: str, other: str) -> str:
    """The sentence, lower-cased, with another term wherever it has one."""
    return re.sub(rf"(?<![^\W_]){re.escape(own)}(?![^\W_])", other, sentence.lower())


def swaps_of(text: str, terms: dict[str, list[str]]) -> Counter[tuple[tuple[str, ...], tuple[str, ...]]]:
    """(features lost, features won) of all swaps in the sentences of a text; the swaps of one mention share a weight of 1."""
    identity = {w for kind in terms.values() for w in kind}
    out: Counter = Counter()
    for sentence in _STOP.split(text):
        for own in words_of(sentence) & identity:
            here = features_of(sentence, identity)
            others = [w for kind in terms.values() if own in kind for w in kind if w != own]
            for other in others:
                there = features_of(swapped(sentence, own, other), identity)
                out[tuple(sorted(here - there)), tuple(sorted(there - here))] += 1 / len(others)
    return out


def _solved(curve, slope: np.ndarray, diagonal: np.ndarray, steps: int = 200) -> np.ndarray:
    """x with curve(x) = slope, nearly, by conjugate gradients."""
    x, rest = np.zeros_like(slope), slope.copy()
    scaled = rest / diagonal
    way, size = scaled.copy(), rest @ scaled
    for _ in range(steps):
        if rest @ rest <= 1e-8 * (slope @ slope):
            break
        bent = curve(way)
        step = size / (way @ bent)
        x += step * way
        rest -= step * bent
        scaled = rest / diagonal
        size, old = rest @ scaled, size
        way = scaled + size / old * way
    return x


def fit_weights(rows: list[tuple[list[int], int]], names: list[str], swaps: list[tuple[list[int], list[int], float]], identity: set[str], swap: float, ridge: float, steps: int = 60) -> Model:
    """A model from (features of a document, by place in names, 1 if toxic else 0), and (features lost, features won, weight) of swaps.

    It has the least mean log loss plus ridge * |w|^2 plus swap times the mean squared change of the logit over all swaps.
    Newton's method with sparse products in driver memory, which the sample bounds.
    """
    if not rows:
        return Model()
    n, f = len(rows), len(names)
    row = np.repeat(np.arange(n), [len(x) for x, _ in rows])
    col = np.fromiter(chain.from_iterable(x for x, _ in rows), dtype=np.int64, count=len(row))
    y = np.array([v for _, v in rows], dtype=float)
    at = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b, _ in swaps]).astype(np.int64)
    term = np.fromiter(chain.from_iterable(a + b for a, b, _ in swaps), dtype=np.int64, count=len(at))
    sign = np.fromiter(chain.from_iterable([-1.0] * len(a) + [1.0] * len(b) for a, b, _ in swaps), dtype=float, count=len(at))
    share = np.array([x for _, _, x in swaps], dtype=float)
    share *= swap / max(1e-9, share.sum())
    hold = np.append(np.full(f, ridge), 5e-7)

    logits = lambda v: np.bincount(row, v[col], n) + v[-1]
    back = lambda r: np.append(np.bincount(col, r[row], f), r.sum()) / n
    changes = lambda v: np.bincount(at, sign * v[term], len(swaps))
    held = lambda v: 2 * hold * v + 2 * np.append(np.bincount(term, sign * (share * changes(v))[at], f), 0)

    def loss(v: np.ndarray) -> float:
        z = logits(v)
        return float(np.mean(np.logaddexp(0, z) - y * z) + hold @ (v * v) + share @ changes(v) ** 2)

    w = np.zeros(f + 1)
    fixed = 2 * hold + 2 * np.append(np.bincount(term, share[at], f), 0)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-logits(w)))
        slope, bend = back(p - y) + held(w), p * (1 - p)
        if np.abs(slope).max() < 1e-8:
            break
        move = _solved(lambda v: back(bend * logits(v)) + held(v), slope, back(bend) + fixed)  # noqa: B023
        now, step = loss(w), 1.0
        while step > 1e-6 and loss(w - step * move) > now - 1e-4 * step * (slope @ move):
            step /= 2
        w -= step * move
    return Model(float(w[-1]), {x: float(v) for x, v in zip(names, w, strict=False)}, frozenset(identity))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_SAMPLE, terms: dict[str, list[str]] | None = None, swap: float = 10.0, ridge: float = 1e-4) -> Model:
    """A model from docs(doc_id, text) and labels(doc_id, toxic); null labels and labels without a document don't count."""
    terms = IDENTITY_TERMS if terms is None else terms
    identity = {w for kind in terms.values() for w in kind}
    ids = sample_ids(labels.select("doc_id", F.col("toxic").alias("label")), most)
    words = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lost", words), ("won", words), ("share", pa.float64())]))
        for part in slices(batches, "text"):
            texts = [x or "" for x in part.column("text").to_pylist()]
            found = [sorted(features_of(x, identity)) for x in texts]
            swaps = [[{"lost": list(a), "won": list(b), "share": n} for (a, b), n in swaps_of(x, terms).items()] for x in texts]
            yield pa.RecordBatch.from_arrays([part.column("label").cast(pa.int32()), pa.array(found, words), pa.array(swaps, kind)], ["label", "features", "swaps"])

    shape = "label int, features array<string>, swaps array<struct<lost: array<string>, won: array<string>, share: double>>"
    read = durable(sample_texts(docs, ids, most).mapInArrow(batched(run), shape))
    whole = read.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("p"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = whole["p"] + 0.5, whole["n"] - whole["p"] + 0.5
    counts = read.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n"))
    p, n = F.col("p") + 0.5, F.col("n") - F.col("p") + 0.5
    clear = F.abs(F.log(p / F.lit(toxic)) - F.log(n / F.lit(clean))) / F.sqrt(1 / p + 1 / n)
    chosen = counts.filter((clear >= CLEAR) & (F.col("n") >= 5)).select("feature").collect()  # the sample's words at most
    swaps = read.select(F.explode("swaps").alias("s")).groupBy("s.lost", "s.won").agg(F.sum("s.share").alias("share")).collect()  # pairs of terms
    names = sorted({r["feature"] for r in chosen} | identity)
    place = {x: i for i, x in enumerate(names)}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[place[x] for x in xs if x in place] for xs in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.int32()))], ["label", "features"])

    rows = read.select("label", "features").mapInArrow(batched(numbered), "label int, features array<int>").collect()  # at most `most`
    moved = [([place[x] for x in r["lost"] if x in place], [place[x] for x in r["won"] if x in place], r["share"]) for r in sorted(swaps, key=lambda r: (r["lost"], r["won"]))]
    return fit_weights([(r["features"], r["label"]) for r in rows], names, moved, identity, swap, ridge)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of each row of docs(doc_id, text, ...); a null text counts as empty.

    Repeated rows are scored each by itself, an empty table gives an empty result, other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            score = np.array([model.score(x or "") for x in part.column("text").to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(batched(run), f"doc_id {kind}, score double, predicted int")
