"""Token counts from pre-token frequencies.

No piece of the vocabulary has a space after another character, nor a line feed, so merges never cross the start of a
run of spaces or of a line: the pieces of a text are those of its pre-tokens, one after the other.

1. Frequencies. A task reads its texts in chunks and stores, for each, its different pre-tokens, dealt by their hash, and,
   packed, how often each document has which of them. The text is not needed again.
2. Pieces. All chunks' pre-tokens with the same hash meet; each different one is counted once, wherever and however often
   it stands, and its count returns to the chunks that have it.
3. Sums. Each document's frequencies are multiplied by the counts and added up. The ids of a text never exist.

A pre-token is sent once by each chunk however often it stands there, so a very common one is no hot key, and what is
sent is packed: pre-tokens of one chunk and hash are a row.
"""

from __future__ import annotations

import io
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import BATCH_ROWS, batched, by_key, durable, grouped, pack, shuffle_width, slices, unpack

#: Bytes of text in a chunk, about; a longer text is a chunk by itself.
CHUNK_BYTES = 8 << 20
SPACE = "▁"


def piece_counter(model: str) -> Callable[[list[str]], list[int]]:
    """Number of pieces for each pre-token; see pre_tokens for what they look like."""
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model)

    def count(keys: list[str]) -> list[int]:
        # the library puts one space before all; it is the first of a run of spaces, but none that a line has
        return [1 if k == "" else len(ids) - (k[0] == "\n") for k, ids in zip(keys, pieces.encode(keys, num_threads=1), strict=True)]

    return count


_PARTS = re.compile(r"\n[^ \n]*| +[^ \n]*")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text: a word with the spaces before it but one, or a line feed with the word after it."""
    text = text.replace(SPACE, " ")
    if not text:
        return []
    if "  " in text or " \n" in text or text[0] in " \n" or text[-1] == " ":
        return [x[1:] if x[0] == " " else x for x in _PARTS.findall(f" {text}")]
    return text.replace("\n", " \n").split(" ")


def packed_words(words: list[bytes]) -> bytes:
    return pack(np.array([len(w) for w in words], dtype=np.uint32), np.frombuffer(b"".join(words), dtype=np.uint8))


def unpacked_words(data: bytes) -> list[bytes]:
    sizes, joined = unpack(data)
    raw, ends = joined.tobytes(), np.cumsum(sizes, dtype=np.int64).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def frequencies(docs: DataFrame, n_parts: int) -> DataFrame:
    """(chunk, ids, freq, parts) for chunks of rows.

    parts has the chunk's different pre-tokens, packed by the part that their hash deals them to. A place is that of a
    pre-token among all parts, one after the other. freq packs the documents' sizes in bytes, how many places each has, the
    places, sorted, as steps from one to the next, and the counts. ids is the doc_id column as an Arrow stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        size = 0
        for part in slices(batches, "text", CHUNK_BYTES):
            own = pa.compute.sum(pa.compute.binary_length(part.column("text"))).as_py() or 0
            if held and size + own > CHUNK_BYTES:
                full, held, size = held, [], 0
                yield chunk(f"{task}-{n}", full)
                n += 1
            held.append(part)
            size += own
        if held:
            yield chunk(f"{task}-{n}", held)

    def chunk(name: str, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        number: dict[str, int] = {}
        lengths, places, counts = [], [], []
        for batch in batches:
            for text in batch.column("text").to_pylist():
                freq = Counter(pre_tokens(text or ""))
                lengths.append(len(freq))
                places.append(np.fromiter((number.setdefault(k, len(number)) for k in freq), dtype=np.int32, count=len(freq)))
                counts.append(np.fromiter(freq.values(), dtype=np.int32, count=len(freq)))
        words = [w.encode("utf-8", "surrogatepass") for w in number]
        del number
        part = np.fromiter((zlib.crc32(w) % n_parts for w in words), dtype=np.int32, count=len(words))
        order = np.argsort(part, kind="stable")
        rank = np.empty(len(words), dtype=np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        place, count = rank[np.concatenate(places)], np.concatenate(counts)
        by_doc = np.lexsort((place, doc))
        place, count = place[by_doc], count[by_doc]
        step = np.diff(place, prepend=np.int32(0))
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        step[first] = place[first]
        cuts = np.flatnonzero(np.diff(part[order], prepend=-1)).tolist()
        parts = [{"part": int(part[order[a]]), "words": packed_words([words[i] for i in order[a:b].tolist()])} for a, b in zip(cuts, [*cuts[1:], len(words)], strict=True)]
        table = pa.Table.from_batches(batches)
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, table.select(["doc_id"]).schema) as out:
            out.write_table(table.select(["doc_id"]))
        sizes = pa.compute.fill_null(pa.compute.binary_length(table.column("text")), 0).to_numpy().astype(np.int64)
        freq = pack(sizes, np.array(lengths, dtype=np.int64), step, count)
        kind = pa.list_(pa.struct([("part", pa.int32()), ("words", pa.binary())]))
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([zstandard.compress(sink.getvalue())], pa.binary()), pa.array([freq], pa.binary()), pa.array([parts], kind)], ["chunk", "ids", "freq", "parts"])

    return docs.select("doc_id", "text").mapInArrow(batched(run), "chunk string, ids binary, freq binary, parts array<struct<part: int, words: binary>>")


def piece_counts(chunks: DataFrame, model: str) -> DataFrame:
    """(chunk, part, counts): the number of pieces of each pre-token of a chunk and part, in order.

    A part's pre-tokens are all in one task, one chunk's after the other's; each different one is counted once.
    """
    parts = chunks.select("chunk", F.explode("parts").alias("p")).select("p.part", "chunk", "p.words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, now, known = piece_counter(model), None, {}
        for batch in batches:
            out = []
            for part, words in zip(batch.column("part").to_pylist(), batch.column("words"), strict=True):
                if part != now:
                    now, known = part, {}
                asked = unpacked_words(words.as_py())
                new = [w for w in asked if w not in known]
                known.update(zip(new, count([w.decode("utf-8", "surrogatepass") for w in new]), strict=True))
                out.append(pack(np.array([known[w] for w in asked], dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("part"), pa.array(out, pa.binary())], ["chunk", "part", "counts"])

    return by_key(parts, "part", "chunk").mapInArrow(batched(run), "chunk string, part int, counts binary")


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row, for the vocabulary at path model, the same on every machine.

    A null text counts as empty: no bytes, no tokens. Repeated rows count each by itself, an empty table gives an
    empty result, other columns are not looked at. A text is counted whole, however long.
    """
    chunks = durable(frequencies(docs, 2 * shuffle_width(docs.sparkSession)))
    none = lambda name: F.lit(None).cast("binary").alias(name)
    own = chunks.select("chunk", F.lit(-1).alias("part"), "ids", "freq", none("counts"))
    told = piece_counts(chunks, model).select("chunk", "part", none("ids"), none("freq"), "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, "chunk"):
            pieces = np.concatenate([np.zeros(0, dtype=np.int64), *(unpack(r["counts"])[0] for r in rows[1:])])
            sizes, lengths, step, counts = unpack(rows[0]["freq"])
            ends = np.cumsum(lengths)
            begins = ends - lengths
            reach = np.concatenate(([0], np.cumsum(step, dtype=np.int64)))
            place = reach[1:] - np.repeat(reach[begins], lengths)  # steps begin anew with each document
            total = np.concatenate(([0], np.cumsum(pieces[place] * counts)))
            sums = pa.array(total[ends] - total[begins], pa.int64())
            with pa.ipc.open_stream(zstandard.decompress(rows[0]["ids"])) as source:
                ids = source.read_all().column("doc_id").combine_chunks()
            whole = pa.RecordBatch.from_arrays([ids, pa.array(sizes), sums, pa.compute.greater(sums, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])
            for k in range(0, whole.num_rows, BATCH_ROWS):
                yield whole.slice(k, BATCH_ROWS)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_key(own.unionByName(told), "chunk", "part").mapInArrow(batched(run), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
