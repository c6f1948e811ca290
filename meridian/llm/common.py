"""Pieces that the text operators share: durable intermediate tables and Arrow batch helpers."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import ctypes
import functools
import gc
import io
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

#: What a word is for every operator here: a run of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The session names it in spark.checkpoint.dir. Only where that is unset and all runs in one process (tests) does this
    make a folder of its own, which goes when Python ends; on a cluster each executor would write to its own disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='meridian-')}"
        atexit.register(shutil.rmtree, found.removeprefix("file://"), True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_folder(spark: SparkSession, name: str) -> str:
    """A place in the shared folder that no other call has, for files that stay."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: The lists, of this thread's callers, that get the paths of stored tables.
_collecting: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("collecting", default=())


def _place(spark: SparkSession, path: str):
    """The path for Hadoop, and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def durable(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: short lineage that outlives any executor.

    The table goes when the driver ends, if nothing removes it before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/meridian/{uuid.uuid4().hex}"
    for paths in _collecting.get():
        paths.append(path)
    df.write.parquet(path)
    place, files = _place(spark, path)
    files.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def collecting(paths: list[str]):
    """Adds to paths what durable() stores meanwhile in this thread."""
    token = _collecting.set((*_collecting.get(), paths))
    try:
        yield
    finally:
        _collecting.reset(token)


def remove_tables(spark: SparkSession, paths: list[str], still_read: DataFrame) -> None:
    """Removes stored tables, and their paths from the list, but for those that still_read reads from."""
    files = still_read.inputFiles()
    for path in list(paths):
        if not any(path.rpartition("/")[2] in f for f in files):
            place, at = _place(spark, path)
            at.delete(place, True)
            paths.remove(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about most_bytes of text; one row at least in each.

    It bounds what Python holds at once by the longest text and most_bytes, not by the row count of a batch.
    """
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        first = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most_bytes:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        if first < batch.num_rows:
            yield batch.slice(first)


def check_ids(docs: DataFrame) -> None:
    """Raises TypeError unless doc_id is a whole number, by whose order documents go."""
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"doc_id has to be a whole number, not {kind.simpleString()}")


def keyed(docs: DataFrame, carry: bool) -> DataFrame:
    """(doc_id, text), or with carry (row, text) where row is a struct of all columns, so names clash with nothing."""
    return docs.select(F.struct("*").alias("row") if carry else "doc_id", "text")


def output(keyed_docs: DataFrame, columns: str) -> StructType:
    """The schema of the key of keyed() and then of columns, a DDL string."""
    key = keyed_docs.schema[0]
    return StructType([StructField(key.name, key.dataType, True), *StructType.fromDDL(columns)])


#: Rows and bytes of an Arrow batch at most; texts can be long, and both the JVM and Python hold whole batches.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def batched(run):
    """A function over Arrow batches of at most BATCH_ROWS rows and about BATCH_BYTES that gives memory back to the system when it ends.

    Spark keeps Python workers for later tasks, and an idle one would otherwise hold its largest batch's memory. Both
    bounds are settings of the session, which are lowered where they are larger; Spark has none for a single query.
    """
    conf = SparkSession.active().conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key).lower().rstrip("b")
        if not 0 < int(now.rstrip("kmg")) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1], 1) <= most:
            conf.set(key, most)

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def or_empty(column) -> Column:
    return F.coalesce(column, F.lit(""))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length or another in one compressed string, their bytes dealt into planes."""
    out = io.BytesIO()
    for a in arrays:
        raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
        head = a.dtype.str.encode()
        out.write(len(head).to_bytes(1, "big") + head + len(a).to_bytes(8, "big") + raw)
    return zstandard.ZstdCompressor(level=5).compress(out.getvalue())


def unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n = raw[at]
        kind, at = np.dtype(raw[at + 1 : at + 1 + n].decode()), at + 1 + n
        n, at = int.from_bytes(raw[at : at + 8], "big"), at + 8
        size = n * kind.itemsize
        out.append(np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n).T.copy().view(kind).reshape(n) if n else np.zeros(0, kind))
        at += size
    return out


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by the first of the keys and sorted by all of them in each task."""
    return df.repartition(shuffle_width(df.sparkSession), keys[0]).sortWithinPartitions(*keys)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Rows with the same key, one after the other."""
    now, rows = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            if rows and row[key] != now:
                yield now, rows
                rows = []
            now = row[key]
            rows.append(row)
    if rows:
        yield now, rows
