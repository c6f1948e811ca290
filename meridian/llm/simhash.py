"""SimHash near-duplicates, candidates by the pigeonring principle.

A fingerprint is a ring of M segments. If two differ in at most MOST_BITS bits, then from some segment on, for every
length l, the l segments that follow differ in at most floor(l * MOST_BITS / M) bits. With seven segments and three
bits the first two of such a chain are equal, which is the key that candidates share; the budgets of the longer
chains (1, 1, 2, 2) drop most of them before their full distance is taken.

Equal fingerprints are one node before anything is compared, and a bucket tells only how its nodes hang together, not
its pairs, so a group of thousands of copies, exact or near, costs little more than its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import batched, check_ids, durable, keyed, output, shuffle_width, slices
from meridian.llm.components import components

MOST_BITS = 3
SHINGLE = 3
SEED = 42
#: Bits of each segment; the ring begins at the lowest bit.
SEGMENTS = (10, 9, 9, 9, 9, 9, 9)
_M = len(SEGMENTS)
_FIRST = np.cumsum((0, *SEGMENTS[:-1])).astype(np.uint64)
_MASKS = np.array([((1 << w) - 1) << int(s) for w, s in zip(SEGMENTS, _FIRST, strict=True)], dtype=np.uint64)
_BUDGET = [length * MOST_BITS // _M for length in range(_M + 1)]
#: Larger buckets are divided by the bits that are not in their key.
DIVIDE = 64


def fingerprint(text: str) -> int:
    """A bit is 1 if it is set in over half of the hashes of the text's word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = [0, *ends[: -SHINGLE].tolist()]
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)]
    ones, n = np.zeros(64, dtype=np.int64), len(hashes)
    for k in range(0, n, 1 << 16):
        part = np.array(hashes[k : k + (1 << 16)], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, carry: bool = False) -> DataFrame:
    """(doc_id, or row with carry, fp) of each row, fp as a signed 64-bit number; a text without words, or null, has 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            fps = np.array([fingerprint(x or "") for x in part.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps.view(np.int64))], [part.schema.names[0], "fp"])

    rows = keyed(docs, carry)
    return rows.mapInArrow(batched(run), output(rows, "fp long"))


def near(a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which pairs are within MOST_BITS and have their chain from segment `first` on within all budgets."""
    diff = a ^ b
    alive = np.arange(len(diff))
    spent = np.zeros(len(diff), dtype=np.int64)
    first = np.broadcast_to(first, diff.shape)
    for length in range(1, _M + 1):
        spent = spent + np.bitwise_count(diff[alive] & _MASKS[(first[alive] + length - 1) % _M])
        keep = spent <= _BUDGET[length]
        alive, spent = alive[keep], spent[keep]
    out = np.zeros(len(diff), dtype=bool)
    out[alive] = True  # the last chain is the whole ring, so its budget is the full distance
    return out


def _grow(fps: np.ndarray, ids: np.ndarray, first: int, edges: list) -> None:
    """Stars that connect what is linked within one bucket: each node is compared with those not yet reached only."""
    rest = np.argsort(ids, kind="stable")
    while len(rest) > 1:
        root, queue, rest = rest[0], [rest[0]], rest[1:]
        while queue and len(rest):
            linked = near(fps[rest], fps[queue.pop()], np.int64(first))
            for x in rest[linked]:
                edges.append((ids[x], ids[root]))
                queue.append(x)
            rest = rest[~linked]


def _compared(group: np.ndarray, fps: np.ndarray, ids: np.ndarray, first: int, free: list[int], edges: list) -> None:
    """Edges within rows sorted by group, all of one table.

    In small groups every two are compared, all groups at once. A large one is divided by the free bits: three differences
    leave one of four parts of them equal, and a group within a part is compared in the same way.
    """
    if len(ids) < 2:
        return
    starts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1))
    sizes = np.diff(np.concatenate((starts, [len(ids)])))
    end = np.repeat(starts + sizes, sizes)
    here = np.flatnonzero(np.repeat(sizes <= DIVIDE, sizes))
    for step in range(1, DIVIDE):
        here = here[here + step < end[here]]
        if not len(here):
            break
        ok = near(fps[here], fps[here + step], np.int64(first))
        a, b = ids[here[ok]], ids[here[ok] + step]
        edges.append(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1))
    large = np.repeat(sizes > DIVIDE, sizes)
    if not large.any():
        return
    if len(free) <= MOST_BITS:
        for a, n in zip(starts[sizes > DIVIDE], sizes[sizes > DIVIDE], strict=True):
            found: list[tuple[int, int]] = []
            _grow(fps[a : a + n], ids[a : a + n], first, found)
            edges.append(np.array(found, dtype=np.int64).reshape(-1, 2))
        return
    group, fps, ids = group[large], fps[large], ids[large]
    for k in range(MOST_BITS + 1):
        part = free[k :: MOST_BITS + 1]
        key = fps & np.uint64(sum(1 << b for b in part))
        order = np.lexsort((key, group))
        inner = np.cumsum(np.concatenate(([True], (np.diff(group[order]) != 0) | (np.diff(key[order]) != 0)))) - 1
        _compared(inner, fps[order], ids[order], first, [b for b in free if b not in part], edges)


def _forest(edges: np.ndarray) -> np.ndarray:
    """As many of the edges (a, b) as it takes to connect what they connect."""
    root: dict[int, int] = {}
    keep = []
    for i, (a, b) in enumerate(edges.tolist()):
        while (up := root.get(a, a)) != a:
            root[a] = a = root.get(up, up)
        while (up := root.get(b, b)) != b:
            root[b] = b = root.get(up, up)
        if a != b:
            root[max(a, b)] = min(a, b)
            keep.append(i)
    return edges[keep]


def _links(tables: np.ndarray, keys: np.ndarray, fps: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Edges that connect what is linked within rows sorted by (table, key), all rows of a bucket being there."""
    edges = [np.zeros((0, 2), dtype=np.int64)]
    group = np.cumsum(np.concatenate(([True], (np.diff(tables) != 0) | (np.diff(keys) != 0)))) - 1
    for t in np.unique(tables).tolist():
        mine = tables == t
        fixed = int(_MASKS[t] | _MASKS[(t + 1) % _M])
        _compared(group[mine], fps[mine], ids[mine], t, [b for b in range(64) if not fixed >> b & 1], edges)
    return _forest(np.concatenate(edges))


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all nodes(fp, node) within MOST_BITS of each other, fp being distinct."""
    keyed = nodes.select(
        "fp",
        "node",
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(t).alias("at"), F.col("fp").bitwiseAND(F.lit(int((_MASKS[t] | _MASKS[(t + 1) % _M]).astype(np.int64)))).alias("key"))
                    for t in range(_M)
                )
            )
        ).alias("b"),
    ).select("b.at", "b.key", "fp", "node")
    width = shuffle_width(nodes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "key", "fp", "node")]
            if not len(now[0]):
                continue
            if held and any(held[-1][k][-1] != now[k][0] for k in (0, 1)):
                yield out(held)
                held = []
            change = np.flatnonzero((np.diff(now[0]) != 0) | (np.diff(now[1]) != 0))
            last = int(change[-1]) + 1 if len(change) else 0  # the last bucket may go on in the next batch
            if last:
                yield out([*held, [x[:last] for x in now]])
                held = []
            held.append([x[last:] for x in now])
        if held:
            yield out(held)

    def out(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        rows = [np.concatenate(x) for x in zip(*parts, strict=True)]
        edges = _links(rows[0].astype(np.int64), rows[1], rows[2].view(np.uint64), rows[3])
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(edges[:, k])) for k in (0, 1)], ["a", "b"])

    return keyed.repartition(width, "at", "key").sortWithinPartitions("at", "key").mapInArrow(batched(run), "a long, b long")


def named(fps: DataFrame) -> DataFrame:
    """(fp, component_id) of each different fp of fps(doc_id, fp), stored."""
    nodes = durable(fps.groupBy("fp").agg(F.min("doc_id").cast("long").alias("node")))
    found = components(links(nodes.filter("node IS NOT NULL")))
    return durable(nodes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) of each row; component_id is the smallest doc_id that links reach.

    A null text or one without words has fingerprint 0 and is linked like any other. A null doc_id never names a
    component; such rows get that of their fingerprint, or null. Repeated rows come out as often as they come in, an
    empty table gives an empty result, other columns are not looked at.
    """
    check_ids(docs)
    fps = durable(fingerprints(docs))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(named(fps), "fp").select("doc_id", "fp", hexed, "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs for each component, that of its smallest doc_id, with all columns.

    Rows with the same doc_id are one document. Rows without a doc_id stay if no document with one is linked to their
    fingerprint, one for each fingerprint.
    """
    check_ids(docs)
    rows = durable(fingerprints(docs, carry=True))
    fps = rows.select("row.doc_id", "fp")
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp")).alias("group")
    own = fps.join(named(fps), "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = own.groupBy(group).agg(F.min(F.struct("doc_id", "fp")).alias("k")).select(F.col("k.doc_id").alias("kept_id"), F.col("k.fp").alias("kept_fp"))
    here = F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (F.col("fp") == F.col("kept_fp"))
    stay = rows.join(kept, here, "left_semi").withColumn("doc_id", F.col("row.doc_id"))
    return stay.dropDuplicates(["doc_id", "fp"]).select("row.*")
