"""Phrases of two to four words that stand together more often than their parts would let expect.

First pass: every task counts the hashes of its phrases in a count-min sketch of two rows. The sketches are sent as what
they have in each slice of cells, slices are summed, and a cell keeps one bit: whether it reached the least count. Cells
are shared, so they count too much and never too little: a phrase that reaches the least count has both its bits.

Second pass: only phrases with both bits are counted, by their words, so the counts are exact and nothing frequent is lost.
Every part of a frequent phrase is as frequent, so the same table has the counts of the parts.

The width of the sketch follows from the size of the texts, up to a bound that also bounds what is sent to every task; past
it, more rare phrases get through to the second pass, which drops them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import batched, durable, or_empty, pack, shuffle_width, slices, unpack

#: Where texts are cut into pieces and pieces into words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_GAPS = b" \t"
#: A byte that no UTF-8 text has; it stands for the end of a piece, and as a word between words.
END = b"\xff"
_CLEAN = bytes.maketrans(
    bytes(range(65, 91)) + PIECE_ENDS + WORD_GAPS,
    bytes(range(97, 123)) + END * len(PIECE_ENDS) + b" " * len(WORD_GAPS),
)
LEAST = 30
LONGEST = 4
TOP = 2000
#: Cells of a row of the sketch: a power of two, and two bits a cell go to every task, 256 MB at most.
FEWEST_CELLS, MOST_CELLS = 1 << 20, 1 << 30
#: Cells of a slice, which one task sums at a time.
SLICE = 1 << 18
ROWS = 2
#: Bytes of text that are cut into words at once, phrases that are counted at once, and words that a task numbers.
BLOCK, AT_ONCE, MOST_WORDS = 4 << 20, 6 << 20, 1 << 20
#: A cell for so many bytes of text, which makes 10 to 20 phrases: far from the least count.
BYTES_A_CELL = 32


class Words(dict):
    """Numbers for words, from 1 on, and their hashes; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({END: 0})
        self.names, self.hashes, self._new = [END], np.zeros(1, np.uint64), []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        self._new.append(xxhash.xxh64_intdigest(word))
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self._new:
            self.hashes, self._new = np.append(self.hashes, np.array(self._new, np.uint64)), []
        return out


def blocks(texts: list[bytes], longest: int) -> Iterator[tuple[list[bytes], int]]:
    """Words and ends of pieces, in blocks; a block begins with the last words of the one before, whose number comes with it."""
    text, at, tail = END.join(texts).translate(_CLEAN), 0, []
    while at < len(text):
        to = text.find(b" ", at + BLOCK) if at + BLOCK < len(text) else -1
        to = to if to >= 0 else len(text)
        words = text[at:to].replace(END, b" " + END + b" ").split()
        yield tail + words, len(tail)
        tail, at = (tail + words)[1 - longest :] if longest > 1 else [], to


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def phrases_of(numbers: np.ndarray, hashes: np.ndarray, seed: int, told: int, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, hashes) of the phrases of each length that lie within pieces and don't end in the first `told` words."""
    word, each = numbers != 0, hashes[numbers]
    g, whole = each ^ np.uint64(seed), word
    for n in range(1, longest + 1):
        if n > 1:
            g = _mixed(g[:-1] * np.uint64(0x9E3779B97F4A7C15) + each[n - 1 :])
            whole = whole[:-1] & word[n - 1 :]
        first = max(0, told - n + 1)
        at = np.flatnonzero(whole[first:]) + first
        yield n, at, _mixed(g[at])


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    found: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        found.setdefault(lang, []).append(text)
    yield from found.items()


def _each_block(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[str, np.ndarray, Words, int]]:
    words = Words()
    for batch in batches:
        for part in slices([batch], "text", BLOCK):
            for lang, texts in _by_lang(part):
                for block, told in blocks(texts, longest):
                    if len(words.names) > MOST_WORDS:
                        words = Words()
                    yield lang, words.numbers(block), words, told


def seed_of(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 1)


def cell(hashes: np.ndarray, row: int, n_cells: int) -> np.ndarray:
    return ((hashes >> np.uint64(32 * row)) & np.uint64(n_cells - 1)).astype(np.uint32)


def sketch(docs: DataFrame, n_cells: int, least: int, longest: int) -> list[bytes]:
    """The rows of the merged sketch of docs(lang, text binary), a bit for each cell: whether it has least or more.

    What comes to the driver is ROWS * n_cells bits, at most ROWS * MOST_CELLS whatever the input.
    """
    count_type = np.uint8 if least < 256 else np.uint32

    def counted(held):
        for row in range(ROWS):
            cells = np.concatenate(held[row])
            held[row].clear()
            cells.sort()
            first = np.flatnonzero(np.diff(cells, prepend=~cells[:1]))
            n = np.minimum(np.diff(first, append=len(cells)), least).astype(count_type)
            cells = cells[first]
            edges = np.searchsorted(cells, np.arange(0, n_cells + 1, SLICE))
            for k in np.flatnonzero(np.diff(edges)):
                a, b = edges[k], edges[k + 1]
                gaps = np.diff(cells[a:b], prepend=np.uint32(k * SLICE))
                yield int(row * (n_cells // SLICE) + k), pack(gaps, n[a:b])

    @batched
    def local(batches):
        held, size = [[] for _ in range(ROWS)], 0
        for lang, numbers, words, told in _each_block(batches, longest):
            for _, _, hashes in phrases_of(numbers, words.hashes, seed_of(lang), told, longest):
                for row in range(ROWS):
                    held[row].append(cell(hashes, row, n_cells))
                size += len(hashes)
            if size >= AT_ONCE:
                yield _rows(counted(held))
                size = 0
        if size:
            yield _rows(counted(held))

    def _rows(found):
        keys, data = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(data, pa.binary())], names=["slice", "data"])

    @batched
    def merged(batches):
        now, total, out = None, None, []
        for batch in batches:
            for key, data in zip(batch.column("slice").to_pylist(), batch.column("data").to_pylist()):
                if key != now:
                    if now is not None:
                        out.append((now, np.packbits(total >= least).tobytes()))
                    now, total = key, np.zeros(SLICE, np.uint32)
                gaps, n = unpack(data)
                total[np.cumsum(gaps, dtype=np.int64)] += n  # no cell comes twice
            if out:
                yield _rows(out)
                out = []
        if now is not None:
            yield _rows([(now, np.packbits(total >= least).tobytes())])

    parts = docs.mapInArrow(local, "slice int, data binary")
    summed = parts.repartition(shuffle_width(docs.sparkSession), "slice").sortWithinPartitions("slice").mapInArrow(merged, "slice int, data binary")
    bits = [bytearray(n_cells // 8) for _ in range(ROWS)]
    per_row = n_cells // SLICE
    for r in summed.collect():
        at = r["slice"] % per_row * SLICE // 8
        bits[r["slice"] // per_row][at : at + SLICE // 8] = r["data"]
    return [bytes(b) for b in bits]


def _tallied(numbers: np.ndarray, at: np.ndarray, n: int, names: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The different phrases of n words that start at the places, by their words, and how often each does."""
    size = len(names)  # under 2 ** 21, so three numbers make one of 63 bits
    if n < 4:
        key = numbers[at]
        for k in range(1, n):
            key = key * size + numbers[at + k]
        key, first, count = np.unique(key, return_index=True, return_counts=True)
    else:
        width = n // 2
        halves = [_coded(numbers, at, 0, width, size), _coded(numbers, at, width, n, size)]
        _, first, count = np.unique(halves[0] * (halves[1].max(initial=0) + 1) + halves[1], return_index=True, return_counts=True)
    places = at[first]
    columns = [[names[i] for i in numbers[places + k].tolist()] for k in range(n)]
    return list(map(b" ".join, zip(*columns))), count


def _coded(numbers: np.ndarray, at: np.ndarray, first: int, last: int, size: int) -> np.ndarray:
    """Small numbers for the words from first to last of each phrase, equal where the words are."""
    code = numbers[at + first]
    for k in range(first + 1, last):
        code = np.unique(code * size + numbers[at + k], return_inverse=True)[1]
    return code


def counts(docs: DataFrame, bits: list[bytes], n_cells: int, least: int, longest: int) -> DataFrame:
    """(lang, phrase, f): exact counts of the phrases of up to `longest` words that are in docs at least `least` times.

    The row of each lang without a phrase has the number of its words. The bits are of a bounded size, so they are sent to every task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    @batched
    def local(batches):
        rows = [np.frombuffer(b, np.uint8) for b in sent.value]
        for lang, numbers, words, told in _each_block(batches, longest):
            total = int(np.count_nonzero(numbers[told:]))
            found, n_found = [None], [np.array([total])]
            for n, at, hashes in phrases_of(numbers, words.hashes, seed_of(lang), told, longest):
                for r, bit in enumerate(rows):
                    c = cell(hashes, r, n_cells)
                    keep = (bit[c >> np.uint32(3)] >> (7 - (c & np.uint32(7))).astype(np.uint8)) & 1 > 0
                    at, hashes = at[keep], hashes[keep]
                if len(at):
                    phrases, count = _tallied(numbers, at, n, words.names)
                    found += phrases
                    n_found.append(count)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.binary()), pa.array(np.concatenate(n_found))], names=["lang", "phrase", "n"])

    some = docs.mapInArrow(local, "lang string, phrase binary, n long").select("lang", F.col("phrase").cast("string").alias("phrase"), "n")
    return some.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).filter((F.col("f") >= least) | F.col("phrase").isNull())


def _joined(words: Column, first, n) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def _wide(c) -> Column:
    return F.col(c).cast("decimal(20,0)")


def scored(table: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of each phrase of two words or more in a table of counts, by its worst cut.

    The score is 2,000,000 times the phrase's count over the sum of its parts' counts, rounded down, with more than 64 bits between.
    """
    parts = table.filter("phrase IS NOT NULL").select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    cuts = parts.filter(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined(F.col("w"), F.lit(1), F.col("k")).alias("left"), _joined(F.col("w"), F.col("k") + 1, F.lit(longest)).alias("right"))
    left, right = (parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(n)) for side, n in (("left", "l"), ("right", "r")))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    # both sides have under 38 digits, and `div` rounds down
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS LONG)")
    worst = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    return worst.select("lang", "phrase", "a", "x.l", "x.r", "x.score")


def subsumed(table: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer phrase in the table that has this one inside, for those of two words or more."""
    words, n = F.split("phrase", " "), F.size(F.split("phrase", " "))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda m: F.transform(F.sequence(F.lit(1), n - m + 1), lambda i: _joined(words, i, m))))
    longer = table.filter("phrase IS NOT NULL").filter(n > 2)
    return longer.select("lang", "f", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, n_cells: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best `top` phrases of each lang of docs(lang, text, ...).

    A null text has no word, a null lang is `und`; repeated rows count as often as they come; ties go by count, then by the
    phrase's bytes. A text of any length is cut into blocks that share their last words. A lang without a frequent phrase, and
    so an empty table, has no row. Other columns are not looked at.
    """
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), or_empty(F.col("text")).cast("binary").alias("text"))
    if n_cells is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        n_cells = min(MOST_CELLS, max(FEWEST_CELLS, 1 << (size // BYTES_A_CELL).bit_length()))
    table = durable(counts(rows, sketch(rows, n_cells, least, longest), n_cells, least, longest))
    totals = table.filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
    kept = scored(table, longest).join(subsumed(table, longest), ["lang", "phrase"], "left")
    kept = kept.filter(F.col("longer").isNull() | (100 * _wide("longer") < 80 * _wide("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    # the rank's bound goes before the exchange, so a task sends no more than `top` rows of a lang
    best = kept.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The rows of the query.
SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), total AS (
  SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), grams AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 5) t(k) WHERE len(w) >= k)
), f AS (
  SELECT lang, phrase, k AS m, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30
), cand AS (
  SELECT lang, phrase, m, a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2
), cut AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, CAST(2000000::HUGEINT * c.a // (l.a::HUGEINT + r.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')
), worst AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM cand, range(2, 4) t(k) WHERE k < m) GROUP BY 1, 2
), kept AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, encode(w.phrase)) AS rank
  FROM worst w LEFT JOIN inner_ i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * w.a
)
SELECT k.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM kept k JOIN total t ON t.lang = k.lang WHERE rank <= 2000
"""
