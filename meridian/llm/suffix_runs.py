"""Exact removal of long byte strings that a document with a smaller doc_id has too, by a distributed suffix sort.

Sorting every suffix of the corpus would move many times its size. A window of LENGTH bytes needs only one suffix of its
own: the one that starts at its anchor, the leftmost of its DEPTH-byte strings with the least hash. The anchor depends on the
window's bytes alone, so equal windows have equal suffixes there, and about one position in 18 is an anchor of any window.

1. Runs. A task sorts the suffixes at the anchors of its documents, to DEPTH bytes, and keeps each different one once:
   a sorted run. Runs are cut at common splitters and front-coded: the length of the prefix shared with the suffix
   before, and the bytes after it.
2. Merge. The parts of all runs for one range meet in a loser tree that knows, for each run's head, how many bytes it
   shares with the last suffix that went out. If two heads share different lengths the order follows without looking at
   the strings; if the same, only bytes after that prefix can differ. Suffixes in two runs or more are alive.
3. Strings. Each run takes the windows around its live anchors. Of equal pieces in a run only those of the smallest
   doc_id go on; pieces with the same suffix meet, and their windows are sorted by a hash and compared byte by byte. The
   windows around a suffix of few different bytes (blanks, rules of dashes), which can stand in very many contexts, meet by
   half of their other bytes as well, so no such suffix fills one task.
4. Verdicts return to their run, whose documents lose every byte of a window that was found in a smaller doc_id.

A common passage is one suffix in each run, however many documents have it.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import batched, by_key, check_ids, durable, grouped, or_empty, pack, shuffle_width, unpack

LENGTH = 50
DEPTH = 16
#: Window starts that share an anchor lie within so many positions.
SPAN = LENGTH - DEPTH + 1
#: Bytes of text in a run, about.
RUN_BYTES = 8 << 20
_POSITION_BITS = 28
_BLOCK = 1 << 18
#: Pieces of a run that are held as strings at once, about.
_PIECES = 1 << 15
#: A suffix of so many different bytes at most is dealt with the bytes beside it.
_FEW_BYTES = 3


def _words(data: np.ndarray, at: slice | np.ndarray, shift: int = 0, order: str = "<u8") -> np.ndarray:
    """The eight bytes from each place as a number."""
    view = np.ndarray((len(data) - 7,), dtype=order, buffer=data, strides=(1,))
    if isinstance(at, slice):
        return view[at.start + shift : at.stop + shift].astype(np.uint64)
    return view[at + shift].astype(np.uint64)


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


class Run:
    """Some documents' bytes one after the other, with their anchors; data has eight spare bytes at its end."""

    def __init__(self, doc_ids: np.ndarray, sizes: np.ndarray, data: np.ndarray):
        self.doc_ids, self.sizes, self.data = doc_ids, sizes, data
        self.ends = np.cumsum(sizes)
        self.n = int(self.ends[-1]) if len(sizes) else 0

    def find_anchors(self) -> None:
        """Sets anchor, first and last: the anchor of the windows that start from first to last."""
        parts = [self._block(b, min(b + _BLOCK, self.n - LENGTH + 1)) for b in range(0, self.n - LENGTH + 1, _BLOCK)]
        found = np.concatenate([np.zeros((3, 0), dtype=np.int64), *parts], axis=1)
        anchor, first, last = found
        same = np.flatnonzero(np.diff(anchor) == 0)  # cut by a block's end
        last[same] = last[same + 1]
        keep = np.ones(len(anchor), dtype=bool)
        keep[same + 1] = False
        self.anchor, self.first, self.last = anchor[keep], first[keep], last[keep]
        self.doc = np.searchsorted(self.ends, self.first, side="right")
        known = self.doc_ids[self.doc] != _NO_ID
        self.anchor, self.first, self.last, self.doc = (x[known] for x in (self.anchor, self.first, self.last, self.doc))

    def _block(self, begin: int, end: int) -> np.ndarray:
        """(anchor, first, last) for the windows that start from begin to before end."""
        reach = slice(begin, end + SPAN - 1)
        a, b = _words(self.data, reach), _words(self.data, reach, 8)
        mixed = _stir(a * np.uint64(0x9E3779B97F4A7C15) ^ _stir(b * np.uint64(0xC2B2AE3D27D4EB4F)))
        low = (mixed >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | np.arange(len(mixed), dtype=np.uint64)
        n, width = end - begin, 1
        while 2 * width <= SPAN:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:n], low[SPAN - width : SPAN - width + n])
        least = (low & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
        whole = np.ones(n, dtype=bool)  # windows within one document
        k = np.searchsorted(self.ends, begin, side="right")
        while k < len(self.ends) and self.ends[k] - LENGTH + 1 < end:
            whole[max(0, self.ends[k] - LENGTH + 1 - begin) : max(0, self.ends[k] - begin)] = False
            k += 1
        least[~whole] = -1
        cut = np.concatenate(([0], np.flatnonzero(np.diff(least)) + 1))
        out = np.stack([least[cut], cut, np.concatenate((cut[1:], [n])) - 1])
        return out[:, out[0] >= 0] + begin

    def sort(self) -> None:
        """Sets order (anchors by suffix), group (number of each one's suffix), and high and low, the different suffixes."""
        high, low = _words(self.data, self.anchor, 0, ">u8"), _words(self.data, self.anchor, 8, ">u8")
        self.order = np.lexsort((low, high))
        high, low = high[self.order], low[self.order]
        new = np.ones(len(high), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.group = np.cumsum(new) - 1
        self.high, self.low = high[new], low[new]

    def shared_here(self) -> np.ndarray:
        """Which suffixes two documents of the run have."""
        starts = np.flatnonzero(np.diff(self.group, prepend=-1))
        ids = self.doc_ids[self.doc[self.order]]
        return np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts) if len(starts) else np.zeros(0, dtype=bool)

    def ranges(self, splitters: list[tuple[int, int]]) -> np.ndarray:
        """Where the suffixes of each range begin, and their number at the end."""
        cuts = [0]
        for high, low in splitters:
            a, b = np.searchsorted(self.high, np.uint64(high), side="left"), np.searchsorted(self.high, np.uint64(high), side="right")
            cuts.append(int(a + np.searchsorted(self.low[a:b], np.uint64(low), side="left")))
        return np.array([*cuts, len(self.high)])


_NO_ID = np.iinfo(np.int64).min


def front_coded(high: np.ndarray, low: np.ndarray) -> bytes:
    """Sorted different suffixes as shared prefix lengths and the bytes after them."""
    letters = np.stack([high, low], axis=1).astype(">u8").view(np.uint8).reshape(-1, DEPTH)
    same = np.zeros(len(high), dtype=np.uint8)
    if len(high) > 1:
        same[1:] = (letters[1:] != letters[:-1]).argmax(axis=1)
    return pack(same, letters[np.arange(DEPTH) >= same[:, None]])


def decoded(data: bytes) -> tuple[list[int], list[int]]:
    """The suffixes of a front-coded part as numbers, and the lengths that each shares with the one before."""
    same, rest = unpack(data)
    n = len(same)
    own = np.arange(DEPTH) >= same[:, None]
    letters = np.zeros((n, DEPTH), dtype=np.uint8)
    letters[own] = rest
    for j in range(DEPTH):
        at = np.maximum.accumulate(np.where(own[:, j], np.arange(n), 0))
        letters[:, j] = letters[at, j]
    words = letters.view(">u8").reshape(n, 2)
    return [h << 64 | x for h, x in zip(words[:, 0].tolist(), words[:, 1].tolist(), strict=True)], same.tolist()


def merge_runs(runs: list[tuple[list[int], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, length shared with the suffix before) of all suffixes of sorted runs, in order.

    A loser tree. shared[r] is what the head of run r shares with the suffix that went out last; when a head meets
    the loser at a node, the one that shares more comes first, unread. Only if both share the same are the rests
    of the strings, without what they share, compared, and the loser then keeps the length that it shares with the winner.
    """
    k = len(runs)
    rests = [(1 << 8 * (DEPTH - n)) - 1 for n in range(DEPTH + 1)]
    width = 1 << max(0, (k - 1).bit_length())
    last_key = 1 << (8 * DEPTH)
    keys = [r[0] for r in runs] + [[]] * (width - k)
    sames = [r[1] for r in runs] + [[]] * (width - k)
    place = [0] * width
    head = [x[0] if x else last_key for x in keys]
    shared = [0 if x else -1 for x in keys]
    losers = [0] * width
    winners = [0] * width + list(range(width))
    for node in range(width - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        if head[b] < head[a]:
            a, b = b, a
        if shared[b] >= 0:
            shared[b] = DEPTH - ((head[a] ^ head[b]).bit_length() + 7) // 8
        winners[node], losers[node] = a, b
    now = winners[1]
    while True:
        common = shared[now]
        if common < 0:
            return
        at = place[now]
        yield now, at, common
        at += 1
        place[now] = at
        own = keys[now]
        if at < len(own):
            key, common = own[at], sames[now][at]
        else:
            key, common = last_key, -1
        head[now], shared[now] = key, common
        node = (now + width) >> 1
        while node:
            other = losers[node]
            theirs = shared[other]
            if theirs > common:
                losers[node], now, common = now, other, theirs
                key = head[now]
            elif theirs == common >= 0:
                mine, rest = key & rests[common], head[other] & rests[common]
                length = DEPTH - ((mine ^ rest).bit_length() + 7) // 8
                if rest < mine:
                    shared[now] = length
                    losers[node], now, key = now, other, head[other]
                else:
                    shared[other] = length
            node >>= 1


def alive(parts: list[bytes]) -> list[np.ndarray]:
    """For the parts of one range, which suffixes are in more than one of them."""
    runs = [decoded(p) for p in parts]
    marks = [bytearray(len(r[0])) for r in runs]
    before_run = before_at = -1
    for run, at, common in merge_runs(runs):
        if common == DEPTH:
            marks[run][at] = 1
            marks[before_run][before_at] = 1
        before_run, before_at = run, at
    return [np.frombuffer(bytes(m), dtype=np.uint8) for m in marks]


_SHIFTS = (*range(0, LENGTH - 7, 8), LENGTH - 8)


def _window_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the LENGTH bytes from each place."""
    out = np.full(len(at), 0x243F6A8885A308D3, dtype=np.uint64)
    for shift in _SHIFTS:
        out = _stir(out * np.uint64(0x9E3779B97F4A7C15) ^ _words(data, at, shift))
    return out


def window_groups(data: np.ndarray, at: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(order, new) of the LENGTH-byte windows from each place: equal ones side by side, and where another begins.

    They are sorted by a hash, and neighbours with the same hash are compared byte by byte; if two different windows ever
    have one hash, all are sorted by their bytes instead.
    """
    hashes = _window_hashes(data, at) if hashes is None else hashes
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    same = np.flatnonzero(~new)
    for k in range(0, len(same), _BLOCK):
        here, before = at[order[same[k : k + _BLOCK]]], at[order[same[k : k + _BLOCK] - 1]]
        if any((_words(data, here, shift) != _words(data, before, shift)).any() for shift in _SHIFTS):
            order = np.lexsort([_words(data, at, shift) for shift in _SHIFTS])
            new[1:] = False
            for shift in _SHIFTS:
                word = _words(data, at[order], shift)
                new[1:] |= word[1:] != word[:-1]
            break
    return order, new


def verdicts(texts: list[bytes], doc_ids: np.ndarray) -> np.ndarray:
    """For each piece a mask of its windows (lowest bit the first) that a piece of a smaller doc_id has too."""
    number: dict[bytes, int] = {}
    kind = np.array([number.setdefault(t, len(number)) for t in texts], dtype=np.int64)
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, kind, doc_ids)
    sizes = np.array([len(t) for t in number], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes
    data = np.frombuffer(b"".join([*number, b"\0" * 8]), dtype=np.uint8)
    del number
    windows = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), windows)
    shift = (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)).astype(np.uint8)
    order, new = window_groups(data, starts[owner] + shift)
    ids = least[owner]
    smallest = np.empty(len(order), dtype=np.int64)
    if len(order):
        smallest[order] = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    bits = np.where(smallest < ids, np.uint64(1) << shift.astype(np.uint64), np.uint64(0))
    part = np.bitwise_or.reduceat(bits, np.cumsum(windows) - windows) if len(bits) else np.zeros(0, dtype=np.uint64)
    whole = (np.uint64(1) << windows.astype(np.uint64)) - np.uint64(1)
    return np.where(doc_ids > least[kind], whole[kind], part[kind])


# ---- stages -------------------------------------------------------------------------------------------------


def _splitters(docs: DataFrame, n: int, each: int = 64) -> list[tuple[int, int]]:
    """n - 1 cuts between suffixes, from about n * each documents; they only balance the ranges.

    A document gives the bytes from one place that its own hash picks.
    """
    raw = F.encode(F.col("text"), "UTF-8")
    size = F.octet_length("text")
    at = (F.pmod(F.xxhash64("doc_id", F.lit(1)), size - DEPTH) + 1).cast("int")
    step = max(1, docs.count() // (n * each))
    picked = docs.filter((size > DEPTH) & (F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0))
    found = picked.select(F.substring(raw, at, F.lit(DEPTH)).alias("s")).limit(2 * n * each).collect()
    keys = sorted(int.from_bytes(r["s"], "big") for r in found if len(r["s"]) == DEPTH)
    cuts = sorted({keys[i * len(keys) // n] for i in range(1, n)}) if keys else []
    return [(k >> 64, k & (1 << 64) - 1) for k in cuts]


def _run_of(docs: bytes, text: bytes) -> Run:
    doc_ids, sizes = unpack(docs)
    data = np.zeros(int(sizes.sum()) + 8, dtype=np.uint8)
    with zstandard.ZstdDecompressor().stream_reader(text) as source:
        source.readinto(memoryview(data)[: len(data) - 8])
    return Run(doc_ids, sizes, data)


def _suffixes(run: Run) -> Run:
    run.find_anchors()
    run.sort()
    return run


def runs(docs: DataFrame, splitters: list[tuple[int, int]], run_bytes: int = RUN_BYTES) -> DataFrame:
    """(run, docs, text, rest, parts): each run's documents, their other columns, and its suffixes front-coded by range."""
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            first = 0
            for i, k in enumerate(pa.compute.binary_length(batch.column("text")).to_pylist()):
                if size and size + k > run_bytes:
                    full, held = [*held, batch.slice(first, i - first)], []
                    yield stored(f"{task}-{n}", full)
                    size, first, n = 0, i, n + 1
                size += k
            held.append(batch.slice(first))
        if any(b.num_rows for b in held):
            yield stored(f"{task}-{n}", held)

    def stored(name: str, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        batches.clear()
        ids = table.column("doc_id").cast(pa.int64()).fill_null(_NO_ID).to_numpy()
        sizes = pa.compute.binary_length(table.column("text")).to_numpy().astype(np.int64)
        data = np.zeros(int(sizes.sum()) + 8, dtype=np.uint8)
        at = 0
        for chunk in table.column("text").chunks:
            offsets = np.frombuffer(chunk.buffers()[1], dtype=np.int64 if pa.types.is_large_string(chunk.type) else np.int32)
            a, b = int(offsets[chunk.offset]), int(offsets[chunk.offset + len(chunk)])
            if b > a:
                data[at : at + b - a] = np.frombuffer(chunk.buffers()[2], dtype=np.uint8)[a:b]
            at += b - a
        other = table.select(rest)
        del table
        docs, packed = pack(ids, sizes), zstandard.ZstdCompressor(level=9).compress(memoryview(data)[: len(data) - 8])
        sorted_run = _suffixes(Run(ids, sizes, data))
        cuts = sorted_run.ranges(splitters)
        parts = [{"range": i, "part": front_coded(sorted_run.high[a:b], sorted_run.low[a:b])} for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < b]
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, other.schema) as out:
            out.write_table(other)
        kind = pa.list_(pa.struct([("range", pa.int32()), ("part", pa.binary())]))
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([docs], pa.binary()), pa.array([packed], pa.binary()), pa.array([zstandard.compress(sink.getvalue())], pa.binary()), pa.array([parts], kind)],
            ["run", "docs", "text", "rest", "parts"],
        )

    kind = "run string, docs binary, text binary, rest binary, parts array<struct<range: int, part: binary>>"
    return docs.withColumn("text", or_empty(F.col("text"))).mapInArrow(batched(run), kind)


def live_suffixes(stored: DataFrame) -> DataFrame:
    """(run, range, live): for each run and range, one bit for each suffix that another run has too."""
    parts = stored.select("run", F.explode("parts").alias("p")).select("p.range", "run", "p.part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in grouped(batches, "range"):
            marks = alive([r["part"] for r in rows])
            found = [(r["run"], zstandard.compress(np.packbits(m).tobytes())) for r, m in zip(rows, marks, strict=True) if m.any()]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.string()), pa.array([number] * len(found), pa.int32()), pa.array([m for _, m in found], pa.binary())], ["run", "range", "live"])

    return by_key(parts, "range", "run").mapInArrow(batched(run), "run string, range int, live binary")


def own_pieces(run: Run, keep: np.ndarray, n_parts: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Verdicts within a run, as (first, mask), and the pieces that go on, as (first, last, part), for the suffixes to keep.

    Equal pieces have equal suffixes, so they are found among a few suffixes at a time. Of each piece the smallest doc_id's goes on.
    """
    order = run.order[keep[run.group]]
    cuts = np.flatnonzero(np.diff(run.group[keep[run.group]], prepend=-1))
    later: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint64))]
    dealt: list[tuple[np.ndarray, ...]] = [(np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int32))]
    raw, begin = memoryview(run.data), 0
    while begin < len(order):
        after = cuts[np.searchsorted(cuts, begin + _PIECES)] if begin + _PIECES <= (cuts[-1] if len(cuts) else 0) else len(order)
        at, begin = order[begin:after], int(after)
        first, last, anchor, ids = run.first[at], run.last[at], run.anchor[at], run.doc_ids[run.doc[at]]
        number: dict[bytes, int] = {}
        kind = np.array([number.setdefault(bytes(raw[a:b]), len(number)) for a, b in zip(first.tolist(), (last + LENGTH).tolist(), strict=True)], dtype=np.int64)
        least = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(least, kind, ids)
        gone = ids > least[kind]
        whole = (np.uint64(1) << (last - first + 1).astype(np.uint64)) - np.uint64(1)
        later.append((first[gone].astype(np.uint32), whole[gone]))
        first, last, anchor = first[~gone], last[~gone], anchor[~gone]
        letters = np.sort(run.data[anchor[:, None] + np.arange(DEPTH)], axis=1)
        few = (np.diff(letters, axis=1) != 0).sum(axis=1) < _FEW_BYTES
        half = (SPAN - 1) // 2
        left, right = few & (first < anchor - half), few & (last >= anchor - half)
        key = lambda which, back, size: [zlib.crc32(raw[a - back : a - back + size]) % n_parts for a in anchor[which].tolist()]
        # windows that begin over `half` bytes before the suffix have half + 1 bytes there in common, the others as many after it
        for which, low, high, back, size in (
            (~few, first, last, 0, DEPTH),
            (left, first, np.minimum(last, anchor - half - 1), half + 1, half + 1 + DEPTH),
            (right, np.maximum(first, anchor - half), last, 0, DEPTH + SPAN - 1 - half),
        ):
            dealt.append((low[which].astype(np.uint32), high[which].astype(np.uint32), np.array(key(which, back, size), dtype=np.int32)))
    first, last, part = (np.concatenate(x) for x in zip(*dealt, strict=True))
    return tuple(np.concatenate(x) for x in zip(*later, strict=True)), first, last, part


def pieces(stored: DataFrame, live: DataFrame, splitters: list[tuple[int, int]], n_parts: int) -> DataFrame:
    """(part, run, rows): the strings around live anchors, dealt by suffix, and, with a null part, verdicts within a run."""
    texts = stored.select("run", F.lit(-1).alias("range"), "docs", "text", F.lit(None).cast("binary").alias("live"))
    marks = live.select("run", "range", F.lit(None).cast("binary").alias("docs"), F.lit(None).cast("binary").alias("text"), "live")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in grouped(batches, "run"):
            found = _suffixes(_run_of(rows[0]["docs"], rows[0]["text"]))
            cuts = found.ranges(splitters)
            keep = found.shared_here()
            for row in rows[1:]:
                a, b = cuts[row["range"]], cuts[row["range"] + 1]
                bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["live"]), dtype=np.uint8)
                keep[a:b] |= np.unpackbits(bits, count=int(b - a)).astype(bool)
            rows.clear()
            found.high = found.low = None
            later, first, last, part = own_pieces(found, keep, n_parts)
            yield row_of(None, name, pack(*later))
            order = np.lexsort((first, part))
            begins = np.flatnonzero(np.diff(part[order], prepend=-1))
            for mine in np.split(order, begins[1:]) if len(order) else ():
                a, size = first[mine].astype(np.int64), (last[mine] - first[mine] + LENGTH).astype(np.int64)
                inside = np.repeat(a - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                ids = found.doc_ids[np.searchsorted(found.ends, a, side="right")]
                yield row_of(int(part[mine[0]]), name, pack(size.astype(np.uint8), ids, first[mine], found.data[inside]))

    def row_of(part: int | None, name: str, data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([data], pa.binary())], ["part", "run", "rows"])

    return by_key(texts.unionByName(marks), "run", "range").mapInArrow(batched(run), "part int, run string, rows binary")


def judged(dealt: DataFrame, n_parts: int) -> DataFrame:
    """(run, verdict): window starts and masks, for pieces that met with those of other runs, and as they were within a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in grouped(batches, "part"):
            if part is None:
                for r in rows:
                    yield out([(r["run"], r["rows"])])
                continue
            texts, ids, places = [], [], []
            for r in rows:
                sizes, own, first, joined = unpack(r["rows"])
                raw, ends = joined.tobytes(), np.cumsum(sizes.astype(np.int64))
                texts += [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                ids.append(own)
                places.append(first)
            masks = verdicts(texts, np.concatenate(ids))
            found, at = [], 0
            for r, first in zip(rows, places, strict=True):
                mine = masks[at : at + len(first)]
                at += len(first)
                if mine.any():
                    found.append((r["run"], pack(first[mine > 0], mine[mine > 0])))
            yield out(found)

    def out(found: list[tuple[str, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.string()), pa.array([v for _, v in found], pa.binary())], ["run", "verdict"])

    # verdicts within runs have no part of their own to go to, so they spread by run
    spread = F.coalesce("part", F.pmod(F.hash("run"), F.lit(n_parts))).alias("to")
    keyed = dealt.select(spread, "part", "run", "rows")
    return keyed.repartition(shuffle_width(dealt.sparkSession), "to").sortWithinPartitions("part", "run").select("part", "run", "rows").mapInArrow(batched(run), "run string, verdict binary")


def cut(stored: DataFrame, found: DataFrame, rest_schema, as_text: bool = False) -> DataFrame:
    """(row, kept, n_bytes, n_removed, n_spans, spans) of each document: row has its columns but text, kept what is left."""
    from pyspark.sql.types import StructField, StructType

    none = lambda name: F.lit(None).cast("binary").alias(name)
    texts = stored.select("run", F.lit(0).alias("kind"), "docs", "text", "rest", none("verdict"))
    all_rows = texts.unionByName(found.select("run", F.lit(1).alias("kind"), none("docs"), none("text"), none("rest"), "verdict"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "run"):
            own = _run_of(rows[0]["docs"], rows[0]["text"])
            gone = np.zeros(own.n, dtype=bool)
            for r in rows[1:]:
                first, masks = unpack(r["verdict"])
                for bit in range(SPAN):
                    gone[first[masks >> np.uint64(bit) & np.uint64(1) > 0].astype(np.int64) + bit] = True
            reach = 1
            while reach < LENGTH:  # a window's start reaches LENGTH bytes, twice as far with each step
                step = min(reach, LENGTH - reach)
                gone[step:] |= gone[:-step]
                reach += step
            with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(rows[0]["rest"])) as source:
                rest = source.read_all().combine_chunks()
            rows.clear()
            for k in range(0, len(own.sizes), 512):
                yield block(own, gone, rest.slice(k, 512), k)

    def block(own: Run, gone: np.ndarray, rest: pa.Table, begin: int) -> pa.RecordBatch:
        kept, n_removed, n_spans, spans = [], [], [], []
        sizes = own.sizes[begin : begin + 512]
        for end, size in zip(own.ends[begin : begin + 512].tolist(), sizes.tolist(), strict=True):
            mine, raw = gone[end - size : end], own.data[end - size : end]
            edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
            kept.append(raw[~mine].tobytes() if len(edges) else raw.tobytes())
            n_removed.append(int(mine.sum()))
            n_spans.append(len(edges) // 2)
            spans.append([{"first": int(a), "after": int(b)} for a, b in edges.reshape(-1, 2)])
        row = pa.StructArray.from_arrays([rest.column(c).combine_chunks() if isinstance(rest.column(c), pa.ChunkedArray) else rest.column(c) for c in rest.column_names], fields=list(rest.schema))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [row, pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, n_removed, n_spans)), pa.array(spans, kind)],
            ["row", "kept", "n_bytes", "n_removed", "n_spans", "spans"],
        )

    columns = StructType([StructField(f.name, f.dataType, True) for f in rest_schema])
    kind = f"row {columns.simpleString()}, kept {"string" if as_text else "binary"}, n_bytes long, n_removed long, n_spans long, spans array<struct<first: long, after: long>>"
    return by_key(all_rows, "run", "kind").mapInArrow(batched(run), kind)


def deduplicated(docs: DataFrame, run_bytes: int = RUN_BYTES, as_text: bool = False) -> DataFrame:
    """(row, kept, n_bytes, n_removed, n_spans, spans) of each row of docs(doc_id long, text, ...).

    row is a struct of all other columns, so their names clash with nothing. kept are the bytes that no LENGTH-byte string
    covers that also starts in a document with a smaller doc_id; spans are the maximal runs removed. Strings never cross
    documents and are judged on the input. With as_text kept is text, without characters of which a cut left half. A null text is empty. Rows with the same doc_id don't act on each other; a null
    doc_id is smaller than none and none is smaller than it, and one that is no whole number is an error. An empty table gives an empty result.
    """
    check_ids(docs)
    width = shuffle_width(docs.sparkSession)
    splitters = _splitters(docs.select("doc_id", "text"), 2 * width)
    stored = durable(runs(docs, splitters, run_bytes))
    dealt = pieces(stored, live_suffixes(stored), splitters, 4 * width)
    rest = [f for f in docs.schema if f.name != "text"]
    return cut(stored, judged(dealt, 4 * width), rest, as_text)


#: The rows of the query by brute force: all windows, as hex, grouped.
SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM d WHERE length(h) >= 100)),
m AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT w.doc_id, w.p FROM w JOIN m USING (s) WHERE m.first_id < w.doc_id),
i AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS fresh FROM r)),
g AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY doc_id, span),
k AS (SELECT g.doc_id, a, b, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY g.doc_id ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY g.doc_id ORDER BY a), 0))) AS before FROM g JOIN d ON d.doc_id = g.doc_id),
c AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_b, string_agg(before, '' ORDER BY a) AS front FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN last_b IS NULL THEN h ELSE front || substr(h, 2 * last_b + 1) END)) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id
"""
