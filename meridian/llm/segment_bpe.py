"""BPE encoding and decoding by a segment tree over adjacent pair ranks.

A leaf holds rank * width + position of the pair that starts there; every node holds the least below it, so the root
is the leftmost pair of the lowest rank. A merge changes three leaves, and their ancestors follow. Pre-tokens of the
same width are merged side by side, a step of all of them at a time; one that is long goes by itself.
Each task merges a distinct pre-token once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meridian.llm.common import batched, slices

#: Pre-tokens that a task remembers; it starts anew beyond that, which bounds memory and changes no result.
REMEMBERED = 200_000
#: Pre-tokens of more symbols are merged one at a time.
WIDEST = 128
_NONE = np.iinfo(np.int64).max
#: Texts of these characters alone are split here, which is faster; all others by the library.
_PLAIN = re.compile(r"[\x00-\u024f]*")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if it is one in Latin-1, else the next from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class WordBpe:
    """A vocabulary file of the tokenizers library: NFC, lower case, words with an end mark, bytes as letters."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        model = found["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in found["added_tokens"]}
        split = found["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split)
        self.library = Tokenizer.from_file(path)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.byte_of = {x: b for b, x in enumerate(letters)}
        self.inner = np.array([vocab[x] for x in letters], dtype=np.int64)
        self.last = np.array([vocab[x + end] for x in letters], dtype=np.int64)
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in model["merges"]]
        self.stride = max(self.tokens) + 1
        keys = np.array([vocab[a] * self.stride + vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = np.append(keys[order], _NONE), np.append(order, -1)
        self.merged = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it never merges; a and b may hold -1 for no symbol."""
        key = a * self.stride + b
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], -1)

    def start(self, word: bytes) -> np.ndarray:
        raw = np.frombuffer(word, dtype=np.uint8)
        return np.append(self.inner[raw[:-1]], self.last[raw[-1]])

    def merge_wide(self, words: list[bytes], width: int) -> list[list[int]]:
        """ids of words of at most width (a power of two) symbols, all at once."""
        n, rows = len(words), np.arange(len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(n, width)
        size = np.array([len(w) for w in words])
        symbol = np.where(np.arange(width) < size[:, None], self.inner[raw], -1)
        symbol[rows, size - 1] = self.last[raw[rows, size - 1]]
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        tree = np.full((n, 2 * width), _NONE)
        ranks = self.rank(symbol[:, :-1], symbol[:, 1:])
        tree[:, width : 2 * width - 1] = np.where(ranks >= 0, ranks * width + np.arange(width - 1), _NONE)
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        while len(rows := rows[tree[rows, 1] != _NONE]):
            rank, at = np.divmod(tree[rows, 1], width)
            gone = after[rows, at]
            following, previous = after[rows, gone], before[rows, at]
            new = self.merged[rank]
            symbol[rows, at], symbol[rows, gone], after[rows, at] = new, -1, following
            inside = following < width
            before[rows[inside], following[inside]] = at[inside]
            right = np.where(inside, symbol[rows, np.minimum(following, width - 1)], -1)
            left = np.where(previous >= 0, symbol[rows, np.maximum(previous, 0)], -1)
            here, back = self.rank(new, right), self.rank(left, new)
            tree[rows, width + gone] = _NONE
            tree[rows, width + at] = np.where(here >= 0, here * width + at, _NONE)
            has = previous >= 0
            tree[rows[has], width + previous[has]] = np.where(back >= 0, back * width + previous, _NONE)[has]
            for leaf in (gone, at, np.maximum(previous, 0)):
                node = (leaf + width) >> 1
                while node[0]:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node >>= 1
        keep = symbol >= 0
        ends = np.cumsum(keep.sum(axis=1))
        flat = symbol[keep].tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def merge_long(self, word: bytes) -> list[int]:
        """ids of one word of any length, by the same tree in plain lists."""
        symbol = self.start(word).tolist()
        n = len(symbol)
        width = 1 << (n - 1).bit_length()
        ranks = self.rank(np.array(symbol[:-1], dtype=np.int64), np.array(symbol[1:], dtype=np.int64)).tolist()
        none = int(_NONE)
        tree = [none] * width + [r * width + i if r >= 0 else none for i, r in enumerate(ranks)]
        tree += [none] * (2 * width - len(tree))
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        table = {}

        def leaf(i: int) -> int:
            if i < 0 or after[i] >= n:
                return none
            pair = (symbol[i], symbol[after[i]])
            if pair not in table:
                table[pair] = int(self.rank(np.array([pair[0]]), np.array([pair[1]]))[0])
            return table[pair] * width + i if table[pair] >= 0 else none

        def put(i: int, value: int) -> None:
            node = i + width
            tree[node] = value
            while node := node >> 1:
                tree[node] = min(tree[2 * node], tree[2 * node + 1])

        while tree[1] != none:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            symbol[at], symbol[gone], after[at] = int(self.merged[rank]), -1, after[gone]
            if after[at] < n:
                before[after[at]] = at
            put(gone, none)
            put(at, leaf(at))
            if before[at] >= 0:
                put(before[at], leaf(before[at]))
        return [x for x in symbol if x >= 0]

    def merge(self, words: list[str]) -> list[list[int]]:
        """ids of each word, in order."""
        raw = [w.encode() for w in words]
        out: list = [None] * len(raw)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(raw):
            if len(w) == 1:
                out[i] = [int(self.last[w[0]])]
            elif len(w) > WIDEST:
                out[i] = self.merge_long(w)
            else:
                by_width.setdefault(1 << (len(w) - 1).bit_length(), []).append(i)
        for width, at in by_width.items():
            step = max(1, (1 << 19) // width)
            for k in range(0, len(at), step):
                part = at[k : k + step]
                for i, ids in zip(part, self.merge_wide([raw[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def split(self, text: str) -> list[str | int]:
        """Pre-tokens of a text, and the ids of special strings in it as numbers."""
        out: list[str | int] = []
        for part in self.specials.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
            elif _PLAIN.fullmatch(part):
                out += self.words.findall(part.lower())
            elif part:
                out += self.library_split(part)
        return out

    def library_split(self, text: str) -> list[str]:
        """Pre-tokens by the library's own normalizer and splitter, which go by their own editions of Unicode."""
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes([self.byte_of[x] for x in letters]).decode() for letters, _ in found]

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids])


class Encoder:
    """A vocabulary with the pre-tokens that it has merged so far: (number of ids, ids as text, decoded text)."""

    def __init__(self, path: str):
        self.bpe, self.known = WordBpe(path), {}

    def look_up(self, texts: list[str]) -> list[list]:
        parts = [self.bpe.split(x) for x in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(chain.from_iterable(parts)) - self.known.keys())
        words = [x for x in new if isinstance(x, str)]
        for word, ids in chain(zip(words, self.bpe.merge(words), strict=True), ((x, [x]) for x in new if not isinstance(x, str))):
            self.known[word] = (len(ids), " ".join(map(str, ids)), self.bpe.decode(ids))
        return parts


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids array) of each row; a null text has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for part in slices(batches, "text"):
            parts = encoder.look_up([x or "" for x in part.column("text").to_pylist()])
            ids = [[int(i) for w in words for i in encoder.known[w][1].split()] for words in parts]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(batched(run), f"doc_id {kind}, ids array<int>")


def decoded(ids: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) for (doc_id, ids): token texts joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(vocabulary)
        for batch in batches:
            text = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.select("doc_id", "ids").mapInArrow(batched(run), f"doc_id {kind}, text string")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what encoded and decoded give, as digests, in one pass.

    A null text is empty: no tokens, the digests of an empty string. Repeated rows are encoded each by itself, an
    empty table gives an empty result, other columns are not looked at. A text is encoded whole, however long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for part in slices(batches, "text"):
            n, ids, texts = [], [], []
            for words in encoder.look_up([x or "" for x in part.column("text").to_pylist()]):
                found = [encoder.known[w] for w in words]
                n.append(sum([x[0] for x in found]))
                ids.append(hashlib.sha256(" ".join([x[1] for x in found]).encode()).hexdigest())
                texts.append(hashlib.sha256(" ".join([x[2] for x in found]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(batched(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
