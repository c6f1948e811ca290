"""Best-fit packing with exact complements.

Documents become token pieces of at most `capacity` tokens. What decides how pieces go together is only how many
there are of each length, so the plan is made from that histogram (at most `capacity` numbers). Single lengths, and sums
of two and of three of them, are indexed by their sum; for each length the gap that it leaves is looked up there, and
combinations that fill it exactly are used up as far as there are pieces of all their lengths. The rest goes by best
fit. Exact fills that take the last short pieces leave gaps that nothing fits into, so it is also worked out how many of
the combinations to keep. The plan says, for the r-th piece of a length, which sequence it takes and where; ranks within a
length are worked out in buckets of a bounded size, so no length, however common, meets in one task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import batched, durable, slices

CAPACITY = 1024
END_ID = 2
#: A length's pieces are ranked in parts of so many rows, about.
BUCKET_ROWS = 1 << 10
#: In so many steps it is looked for how many of the exact combinations to keep.
STOPS = 16

#: Texts of these characters alone get the same ids from both libraries; others, and those with the special
#: token's text, go to the slower one.
_PLAIN = re.compile(r"[^\x00-ɏ]|<\|endoftext\|>")


def encoder(vocabulary: str, ranks: str, pattern: str):
    """text -> ids as the tokenizers library gives them for the file at path vocabulary.

    ranks is the path of the same vocabulary for tiktoken, which is faster, but gives up where a run of white space is longer
    than its stack; such a text goes to the library itself.
    """
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    slow = Tokenizer.from_file(vocabulary)
    slow.no_truncation()
    slow.no_padding()

    def encode(text: str) -> np.ndarray:
        if not _PLAIN.search(text):
            try:
                return fast.encode_to_numpy(text).astype("<u4", copy=False)
            except ValueError:  # its stack of backtracking is full
                pass
        return np.asarray(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

    return encode


def pieces(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and end_id, cut where there are over capacity.

    All pieces of a long document but the first are full. A null text is empty and gives one piece, end_id alone.
    Repeated rows are pieces each by itself; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks, pattern)
        for part in slices(batches, "text"):
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(part.column("text").to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4", copy=False)
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(batched(run), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Sums:
    """The lengths that there are, and their pairs and triples, by sum."""

    def __init__(self, lengths: list[int], capacity: int):
        have = np.array(sorted(set(lengths)), dtype=np.int64)
        long, short = (have[i] for i in np.tril_indices(len(have)))
        inside = np.flatnonzero(long + short < capacity)
        inside = inside[np.argsort((long + short)[inside], kind="stable")]
        long, short = long[inside], short[inside]
        cuts = np.searchsorted(long + short, np.arange(capacity + 1))
        self.pairs = [(long[x:y], short[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
        paired = np.array([len(x) > 0 for x, _ in self.pairs])
        #: by sum: lengths, the longest first, that a pair can be added to
        self.triples = [[int(n) for n in have[::-1] if n < gap and paired[gap - n]] for gap in range(capacity)]

    def pair(self, left: np.ndarray, gap: int) -> tuple[int, ...] | None:
        """Of the pairs with this sum, the one that can be used most often."""
        long, short = self.pairs[gap]
        if not len(long):
            return None
        times = np.minimum(left[long], left[short])
        times[long == short] //= 2
        k = int(times.argmax())
        return (int(long[k]), int(short[k])) if times[k] > 0 else None

    def triple(self, left: np.ndarray, gap: int) -> tuple[int, ...] | None:
        for n in self.triples[gap]:
            if left[n] > 0:
                left[n] -= 1
                two = self.pair(left, gap - n)
                left[n] += 1
                if two:
                    return (n, *two)
        return None

    def single(self, left: np.ndarray, gap: int) -> tuple[int, ...] | None:
        return (gap,) if left[gap] > 0 else None


def exact(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths that fill a sequence exactly, how often), as far as there are pieces: singles first, then pairs, then triples."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for n, k in counts.items():
        left[n] += k
    done = [((capacity,), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    sums = Sums([n for n in counts if n < capacity], capacity)
    for filling in (sums.single, sums.pair, sums.triple):
        for first in range(capacity - 1, 0, -1):
            while left[first] > 0:
                left[first] -= 1
                more = filling(left, capacity - first)
                left[first] += 1
                if not more:
                    break
                used = (first, *more)
                times = min(int(left[n]) // used.count(n) for n in set(used))
                if not times:
                    break
                for n in used:
                    left[n] -= times
                done.append((used, times))
    return done


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, how often): the longest first, each into the fullest sequence that has room for it."""
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for n in sorted(counts, reverse=True):
        todo = counts[n]
        for gap in range(n, capacity):
            while todo and gaps.get(gap):
                used, times = gaps[gap].pop()
                each = gap // n  # a bin that took one takes the next of this length too, while it fits
                whole = min(times, todo // each)
                parts = [(each, whole)] + ([(todo % each, 1)] if whole < times and todo % each and whole == todo // each else [])
                for k, m in parts:
                    if m:
                        gaps.setdefault(gap - k * n, []).append((used + (n,) * k, m))
                        times -= m
                        todo -= k * m
                if times:
                    gaps[gap].append((used, times))
        if todo:
            each = capacity // n
            for k, m in ((each, todo // each), (todo % each, 1)):
                if k and m:
                    gaps.setdefault(capacity - k * n, []).append(((n,) * k, m))
    return [x for found in gaps.values() for x in found]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences), for counts of pieces by length.

    All combinations of one and two lengths are kept, and as many of the longer ones, in the order they were found, as
    leave the fewest sequences in the end; the most of them if that is the same. Time and space go by the capacity, not by
    the number of pieces, as every combination uses up a length.
    """
    filled = exact(counts, capacity)
    sure = sum(len(used) <= 2 for used, _ in filled)
    plans = []
    for keep in sorted({sure + (len(filled) - sure) * k // STOPS for k in range(STOPS + 1)}, reverse=True):
        left = dict(counts)
        for used, times in filled[:keep]:
            for n in used:
                left[n] -= times
        plans.append(filled[:keep] + best_fit({n: k for n, k in left.items() if k}, capacity))
    return min(plans, key=lambda found: sum(times for _, times in found))


def places(plans: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, sequence of the first, offset of the first, how many in a sequence).

    Pieces of one length stand side by side in a sequence and share an entry, however many they are. A sequence has at most
    sqrt(2 * capacity) different lengths, as these alone fill it, and the number of plans goes by the capacity (see plan):
    the entries have a bound that no input moves.
    """
    out, base, ranks = [], 0, {}
    for used, times in plans:
        offset = 0
        for n, each in sorted(Counter(used).items(), reverse=True):
            first = ranks.get(n, 0)
            ranks[n] = first + times * each
            out.append((n, first, ranks[n], base, offset, each))
            offset += n * each
        base += times
    return out


def ranked(cut: DataFrame, buckets: DataFrame) -> DataFrame:
    """cut with rank, a number from 0 among the pieces of the same length, each once; buckets(length, buckets) is short.

    A bucket has a bounded number of rows, whatever the input, and numbers its own; the buckets' starts are a running sum.
    """
    dealt = cut.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "buckets"))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    starts = counts.select("length", "bucket", before.alias("before"))
    # dealt by the window's own keys
    return dealt.withColumn("own", own).join(starts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("own") - 1)


def packed(cut: DataFrame, capacity: int = CAPACITY, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pieces (doc_id, piece, length, ...) with sequence_id and offset; sequences are gapless from offset 0.

    An empty table gives an empty result. cut has to be a stored table, as it is read twice.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most capacity rows
    buckets = spark.createDataFrame([(n, 1 + k // bucket_rows) for n, k in counts.items()], "length long, buckets long")
    found = spark.createDataFrame(places(plan(counts, capacity)), "at_length int, first long, after long, base long, at long, each int")
    here = (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("after"))
    own = F.col("rank") - F.col("first")
    placed = ranked(cut, buckets).join(F.broadcast(found), here)
    return placed.withColumns({"sequence_id": F.col("base") + F.expr("(rank - first) div each"), "offset": F.col("at") + own % F.col("each") * F.col("length")})


def pack(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for docs(doc_id, text, ...); see pieces for odd rows."""
    cut = durable(pieces(docs, vocabulary, ranks, pattern, capacity, end_id))
    return packed(cut, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
