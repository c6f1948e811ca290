"""Language identification by words, with spans for mixed text.

A word (a run of letters) has a script by its code points, and only languages that were seen in that script are its
candidates. Each candidate scores the word by log-probabilities of its letter trigrams, edges included. Viterbi over
the words of a text, with a penalty for each switch, gives a language to each word, and runs of one language are the
spans. The language with the most letters is that of the text, its share of the letters the score.

The model is fitted on a bounded sample: hashed trigram counts by language, BUCKETS numbers for each.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import batched, keyed, output, slices
from meridian.llm.sampling import sample_ids, sample_texts

BUCKETS = 1 << 15
#: Bytes of text that are worked on at once, about; arrays over its letters take a hundred times as much.
SLICE_BYTES = 1 << 20
#: Labelled documents to learn from, at most.
MOST_SAMPLE = 4000
#: What a switch of language costs, in natural-log units of word scores.
SWITCH = 12.0
#: How far below the worst candidate a language is that is none for a word: more than two switches cost.
FAR = 100.0
UNKNOWN = "und"

#: First code point, code point after the last, script.
SCRIPT_RANGES = [
    (0x0041, 0x0250, "Latin"),
    (0x0370, 0x0400, "Greek"),
    (0x0400, 0x0530, "Cyrillic"),
    (0x0530, 0x0590, "Armenian"),
    (0x0590, 0x0600, "Hebrew"),
    (0x0600, 0x0780, "Arabic"),
    (0x0900, 0x0980, "Devanagari"),
    (0x0980, 0x0A00, "Bengali"),
    (0x0A00, 0x0A80, "Gurmukhi"),
    (0x0A80, 0x0B00, "Gujarati"),
    (0x0B80, 0x0C00, "Tamil"),
    (0x0C00, 0x0C80, "Telugu"),
    (0x0C80, 0x0D00, "Kannada"),
    (0x0D00, 0x0D80, "Malayalam"),
    (0x0E00, 0x0E80, "Thai"),
    (0x10A0, 0x1100, "Georgian"),
    (0x1100, 0x1200, "Hangul"),
    (0x1E00, 0x1F00, "Latin"),
    (0x1F00, 0x2000, "Greek"),
    (0x3040, 0x30A0, "Kana"),
    (0x30A0, 0x3100, "Kana"),
    (0x3400, 0xA000, "Han"),
    (0xAC00, 0xD7B0, "Hangul"),
]
SCRIPTS = ["", "Other", *dict.fromkeys(name for _, _, name in SCRIPT_RANGES)]


@cache
def script_table() -> np.ndarray:
    """Number of the script for each code point below 0x10000; 0 is no letter."""
    table = np.zeros(1 << 16, dtype=np.uint8)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            table[c] = 1
    for first, after, name in SCRIPT_RANGES:
        part = table[first:after]
        part[part > 0] = SCRIPTS.index(name)
    return table


@dataclass
class Words:
    """Words of some texts: their first and last letter's places in `hashes`, script, and the text each is in."""

    first: np.ndarray
    size: np.ndarray
    script: np.ndarray
    text: np.ndarray
    hashes: np.ndarray


def words_of(texts: list[str]) -> Words:
    """The words of the texts, lower-cased, with a trigram hash around each letter."""
    lowered = [x.lower() for x in texts]
    points = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    table = script_table()
    scripts = np.where(points < 1 << 16, table[np.minimum(points, (1 << 16) - 1)], 0)
    beyond = np.flatnonzero(points >= 1 << 16)
    if len(beyond):
        kinds, which = np.unique(points[beyond], return_inverse=True)
        scripts[beyond] = np.array([unicodedata.category(chr(c))[0] == "L" for c in kinds.tolist()], dtype=np.uint8)[which]
    letters = np.where(scripts > 0, points, np.uint32(0x20))
    mixed = letters[:-2] * np.uint32(0x9E3779B1)
    mixed ^= letters[1:-1] * np.uint32(0x85EBCA77)
    mixed ^= letters[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x27D4EB2F)
    hashes = np.zeros(len(points), dtype=np.uint16)
    hashes[1:-1] = mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)
    letter = scripts > 0
    edge = np.flatnonzero(np.diff(letter.astype(np.int8)))
    first, after = edge[::2] + 1, edge[1::2] + 1  # the ends are spaces, so edges come in pairs
    begins = np.cumsum([1, *(len(x) + 1 for x in lowered)])
    return Words(first, after - first, scripts[first], np.searchsorted(begins, first, side="right") - 1, hashes)


@dataclass
class Model:
    langs: list[str]
    #: log-probability of each trigram bucket, by language
    table: np.ndarray
    #: whether a language was seen in a script, by script and language
    seen: np.ndarray

    def scores(self, words: Words) -> np.ndarray:
        """Score of each word in each language that was seen in its script, and FAR below these in all others.

        Words of one script are scored together, in its candidates only; in a script that no language has, all are.
        """
        out = np.empty((len(words.script), len(self.langs)), dtype=np.float32)
        for script in np.unique(words.script).tolist():
            at = np.flatnonzero(words.script == script)
            able = np.flatnonzero(self.seen[script]) if self.seen[script].any() else np.arange(len(self.langs))
            first, size = words.first[at], words.size[at]
            starts = np.concatenate(([0], np.cumsum(size)[:-1]))
            grams = words.hashes[np.repeat(first - starts, size) + np.arange(size.sum())]
            told = np.stack([np.add.reduceat(self.table[k][grams], starts) for k in able], axis=1)
            mine = np.repeat(told.min(axis=1, keepdims=True) - FAR, len(self.langs), axis=1)
            mine[:, able] = told
            out[at] = mine
        return out


def fit(docs: DataFrame, most: int = MOST_SAMPLE) -> Model:
    """A model from docs(doc_id, text, lang): at most `most` rows whose lang is known, the same ones each time."""
    ids = sample_ids(docs.select("doc_id", F.col("lang").alias("label")), most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            langs = part.column("label").to_pylist()
            words = words_of([x or "" for x in part.column("text").to_pylist()])
            at = np.repeat(words.text, words.size)
            inside = np.repeat(words.first - np.concatenate(([0], np.cumsum(words.size)[:-1]))[: len(words.size)], words.size) + np.arange(words.size.sum())
            own = np.array(langs, dtype=object)
            for lang in set(langs):
                mine = own == lang
                counts = np.bincount(words.hashes[inside][mine[at]], minlength=BUCKETS)
                by_script = np.bincount(np.repeat(words.script, words.size)[mine[at]], minlength=len(SCRIPTS))
                n = np.concatenate((counts, by_script))
                there = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(there), pa.string()), pa.array(there, pa.int32()), pa.array(n[there], pa.int64())], ["lang", "feature", "n"])

    counted = sample_texts(docs, ids, most).mapInArrow(batched(run), "lang string, feature int, n long")
    rows = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()  # at most BUCKETS and SCRIPTS for each language
    langs = sorted(set(rows["lang"]))
    n = np.zeros((len(langs), BUCKETS + len(SCRIPTS)))
    n[[langs.index(x) for x in rows["lang"]], rows["feature"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.float64)
    grams, scripts = n[:, :BUCKETS] + 0.05, n[:, BUCKETS:]
    table = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(langs, table, (share > 0.001).T)


def viterbi(scores: np.ndarray, starts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language of each word; text k has the words from starts[k] to before starts[k + 1].

    All texts go forward together, one word at a time; those that have ended drop out.
    """
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[:-1][order], sizes[order]
    live = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    if scores.shape[1] > np.iinfo(np.uint16).max:
        raise ValueError("more languages than 16 bits can number")
    came = np.zeros(scores.shape, dtype=np.uint16)
    path = np.zeros(len(scores), dtype=np.uint16)
    if not len(live):
        return path
    langs = np.arange(scores.shape[1], dtype=np.uint16)
    value = scores[first[: live[0]]].astype(np.float64)
    ended = np.zeros((len(first), scores.shape[1]))
    for t in range(1, len(live)):
        n = live[t]
        ended[n : len(value)] = value[n:]
        value = value[:n]
        best = value.argmax(axis=1).astype(np.uint16)
        top = value[np.arange(n), best][:, None] - switch
        moved = top > value
        rows = first[:n] + t
        came[rows] = np.where(moved, best[:, None], langs)
        value = np.where(moved, top, value) + scores[rows]
    ended[: len(value)] = value
    now = ended.argmax(axis=1).astype(np.uint16)
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        rows = first[:n] + t
        path[rows] = now[:n]
        now[:n] = came[rows, now[:n]] if t else now[:n]
    return path


def spans_of(words: Words, path: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, language, words, letters) of each run of words with one language."""
    if not len(path):
        return (np.zeros(0, dtype=np.int64),) * 4
    cut = np.concatenate(([0], np.flatnonzero((np.diff(words.text) != 0) | (np.diff(path) != 0)) + 1))
    return words.text[cut], path[cut].astype(np.int64), np.diff(np.concatenate((cut, [len(path)]))), np.add.reduceat(words.size, cut)


def label(docs: DataFrame, model: Model, switch: float = SWITCH, carry: bool = False) -> DataFrame:
    """(doc_id, or row with carry, lang_pred, score, spans) of each row of docs(doc_id, text, ...); spans has (lang, words, letters) in text order.

    A null text, or one without a letter, is "und" with score 0 and no spans; so is every text if the model knows no language.
    Repeated rows are labelled each by itself, an empty table gives an empty result, other columns are not looked at.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # BUCKETS numbers for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for part in slices(batches, "text", SLICE_BYTES):
            texts = [x or "" for x in part.column("text").to_pylist()]
            words = words_of(texts)
            known = len(m.langs) > 0
            starts = np.searchsorted(words.text, np.arange(len(texts) + 1))
            path = viterbi(m.scores(words), starts, switch) if known else np.zeros(0, dtype=np.uint16)
            text, lang, n_words, letters = spans_of(words, path, len(texts))
            by = np.zeros((len(texts), max(1, len(m.langs))))
            np.add.at(by, (text, lang), letters)
            total = by.sum(axis=1)
            best = by.argmax(axis=1)
            names = np.array([*m.langs, UNKNOWN], dtype=object)
            pred = names[np.where(total > 0, best, len(m.langs))]
            score = np.where(total > 0, by[np.arange(len(texts)), best] / np.maximum(total, 1), 0.0)
            offsets = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            span = pa.StructArray.from_arrays([pa.array(names[lang], pa.string()), pa.array(n_words, pa.int64()), pa.array(letters, pa.int64())], ["lang", "words", "letters"])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.ListArray.from_arrays(pa.array(offsets), span)],
                [part.schema.names[0], "lang_pred", "score", "spans"],
            )

    rows = keyed(docs, carry)
    return rows.mapInArrow(batched(run), output(rows, "lang_pred string, score double, spans array<struct<lang: string, words: long, letters: long>>"))
