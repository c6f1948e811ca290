"""Two tables in the same buckets, one Parquet file for each table and bucket.

A bucket is a checksum of the key, so rows that join lie in files with the same number and a join of two files needs no
exchange. Rows of the second table whose key the first one lacks are orphans: a semi join and an anti join tell them
apart, and they share one bucket; null keys share another. repartitionById sends each row to the partition with its
bucket's number, sortWithinPartitions orders the partition by all columns, and each partition becomes one file. A hot key
lies in one file by contract; its partition is sorted with spills and written row by row, and all sums over it are made
before anything is exchanged.

Rewriting a folder appends the new files before it removes the old ones, so an interrupted run loses no row; files that
already hold exactly one bucket are left as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import _place, batched, durable, shuffle_width

N_BUCKETS = 300


@dataclass(frozen=True)
class Layout:
    """n buckets by a checksum of salt and key; the next two numbers are for orphans and for null keys."""

    n: int = N_BUCKETS
    salt: str = "line"

    @property
    def orphans(self) -> int:
        return self.n

    @property
    def no_key(self) -> int:
        return self.n + 1

    def bucket(self, key: Column) -> Column:
        """The bucket of a key that is no orphan."""
        hashed = F.pmod(F.crc32(F.concat(F.lit(self.salt), key.cast("string"))), F.lit(self.n))
        return F.coalesce(hashed, F.lit(self.no_key)).cast("int")


def file_of_sale(key: Column, layout: Layout) -> Column:
    """The starting file of a row of the first table: its bucket, or the one before where that leaves 1 divided by 3."""
    b = layout.bucket(key)
    return F.when(b % 3 == 1, b - 1).otherwise(b)


def file_of_line(item: Column, layout: Layout) -> Column:
    """The starting file of a row of the second table, by a checksum of another column."""
    return F.coalesce(F.pmod(F.crc32(item.cast("string")), F.lit(layout.n)), F.lit(0)).cast("int")


def _files(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and path, as Spark writes it, of each data file of the folder; markers of finished jobs are removed."""
    place, files = _place(spark, folder)
    out = {}
    for status in files.listStatus(place) if files.exists(place) else ():
        path = status.getPath()
        if path.getName().endswith(".parquet"):
            out[path.getName()] = path.toString()
        elif path.getName().startswith("_SUCCESS"):
            files.delete(path, False)
    return out


def _remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place, files = _place(spark, path)
        files.delete(place, False)


def number_of(name: str) -> int:
    """The partition that wrote a file, which is the file's number."""
    return int(name.split("-")[1])


def write_numbered(rows: DataFrame, number: Column, n: int, columns: list[str], key: str, folder: str) -> dict[int, str]:
    """Appends rows(row, ...) to the folder, one file for each number from 0 to n - 1 that has rows; the new files' names by number.

    A file has the columns of row only, in their order, and is sorted by key and then by all columns, nulls first.
    """
    spark = rows.sparkSession
    before = _files(spark, folder)
    order = [F.col("row")[c].asc_nulls_first() for c in [key, *(c for c in columns if c != key)]]
    dealt = rows.repartitionById(n, number).sortWithinPartitions(*order).select("row.*")
    dealt.write.mode("append").option("maxRecordsPerFile", 0).parquet(folder)
    new = {k: v for k, v in _files(spark, folder).items() if k not in before}
    # Spark writes a file for partition 0 even where it has no row; such a file says so in its footer
    first = [v for k, v in new.items() if number_of(k) == 0]
    if first and spark.read.parquet(*first).isEmpty():
        _remove(spark, first)
        new = {k: v for k, v in new.items() if number_of(k) != 0}
    return {number_of(k): k for k in new}


def lay_out(table: DataFrame, number: Column, n: int, key: str, folder: str) -> dict[int, str]:
    """The table written in numbered files."""
    return write_numbered(table.select(F.struct("*").alias("row"), number.alias("number")), F.col("number"), n, table.columns, key, folder)


def read_numbered(spark: SparkSession, folder: str, schema, key: str) -> DataFrame:
    """(row, key, file) of every row of a folder of numbered files."""
    rows = spark.read.schema(schema).parquet(folder)
    name = rows.metadataColumn("_metadata")["file_name"]
    return rows.select(F.struct("*").alias("row"), F.col(key).alias("key"), F.split(name, "-")[1].cast("int").alias("file"))


def with_buckets(first: DataFrame, second: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Both tables (row, key, file) with their bucket; the second one's orphans have theirs.

    The keys of the first table are stored once, each once, so that the joins can split a hot key of the second. The hint
    keeps the keys, which grow with the table, from being sent to every task.
    """
    keys = durable(first.select("key").filter("key IS NOT NULL").distinct()).hint("merge")
    with_key = second.filter("key IS NOT NULL")
    known = with_key.join(keys, "key", "left_semi").withColumn("bucket", layout.bucket(F.col("key")))
    orphans = with_key.join(keys, "key", "left_anti").withColumn("bucket", F.lit(layout.orphans))
    no_key = second.filter("key IS NULL").withColumn("bucket", F.lit(layout.no_key))
    return first.withColumn("bucket", layout.bucket(F.col("key"))), known.unionByName(orphans).unionByName(no_key)


def lineage(rows: DataFrame) -> DataFrame:
    """(bucket, file, n): how many rows of each starting file a bucket has; at most buckets x files rows."""
    return rows.groupBy("bucket", "file").agg(F.count(F.lit(1)).alias("n"))


def settled(flows: DataFrame) -> dict[int, int]:
    """The buckets that are one whole starting file, and that file's number: at most one entry for each bucket."""
    by_file = flows.groupBy("file").agg(F.count(F.lit(1)).alias("buckets"))
    by_bucket = flows.groupBy("bucket").agg(F.count(F.lit(1)).alias("files"), F.min("file").alias("file"))
    alone = by_bucket.filter("files = 1").join(by_file.filter("buckets = 1"), "file")
    return {r.bucket: r.file for r in alone.select("bucket", "file").collect()}


def joined_rows(first: DataFrame, second: DataFrame, layout: Layout) -> DataFrame:
    """(bucket, n_joined): rows of the inner join on the key, from the counts of each key, so no pair is made."""
    left = first.filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("left"))
    right = second.filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("right"))
    pairs = left.join(right.hint("merge"), "key")
    return pairs.groupBy(layout.bucket(F.col("key")).alias("bucket")).agg(F.sum(F.col("left") * F.col("right")).alias("n_joined"))


def rewrite(folder: str, rows: DataFrame, flows: DataFrame, start: dict[int, str], columns: list[str], key: str, layout: Layout) -> DataFrame:
    """Rewrites the folder by bucket and gives (bucket, name, rewritten) of each final file, two for each bucket's number at most."""
    spark = rows.sparkSession
    stay = settled(flows)
    moving = rows.filter(~F.col("bucket").isin(list(stay))) if stay else rows
    new = write_numbered(moving, F.col("bucket"), layout.no_key + 1, columns, key, folder)
    there, kept = _files(spark, folder), {start[s] for s in stay.values()}
    _remove(spark, [there[name] for name in start.values() if name not in kept])
    final = [(b, start[s], False) for b, s in stay.items()] + [(b, name, True) for b, name in new.items()]
    return spark.createDataFrame(final, "bucket int, name string, rewritten boolean")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, at, key) of a scan to runs (path, at, n, key) of one key in a file, so a hot key is a row for each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, at = batch.column("path").dictionary_encode(), batch.column("at").to_numpy()
        key = batch.column("key")
        null, value = key.is_null().to_numpy(zero_copy_only=False), key.fill_null(0).to_numpy(zero_copy_only=False)
        code = path.indices.to_numpy()
        new = np.ones(len(at), bool)
        new[1:] = (code[1:] != code[:-1]) | (at[1:] != at[:-1] + 1) | (value[1:] != value[:-1]) | (null[1:] != null[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(at)))
        take = pa.array(first)
        yield pa.RecordBatch.from_arrays([batch.column("path").take(take), pa.array(at[first]), pa.array(n), key.take(take)], names=["path", "at", "n", "key"])


#: Keys of one run that are joined into text at once.
_AT_ONCE = 1 << 16


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in the order of their files to one row (path, n_rows, ids_sha256) for each file; no file's keys are held."""
    path, n_rows, digest, rows = None, 0, None, []
    for batch in batches:
        # runs of one path stand together, and in their order: batches only continue them
        for p, n, key in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "key"))):
            if p != path:
                if path is not None:
                    rows.append((path, n_rows, digest.hexdigest()))
                path, n_rows, digest = p, 0, hashlib.sha256()
            text = "" if key is None else str(key)
            for k in range(0, n, _AT_ONCE):
                some = ",".join([text] * min(_AT_ONCE, n - k))
                digest.update((some if not n_rows and not k else "," + some).encode())
            n_rows += n
    if path is not None:
        rows.append((path, n_rows, digest.hexdigest()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "n_rows", "ids_sha256"])


def file_digests(spark: SparkSession, folder: str, schema, key: str) -> DataFrame:
    """(path, name, n_rows, ids_sha256) of each file, from its rows as they stand there: SHA-256 of the keys, joined by commas, a null as nothing."""
    rows = spark.read.schema(schema).parquet(folder)
    meta = rows.metadataColumn("_metadata")
    scanned = rows.select(meta["file_path"].alias("path"), meta["row_index"].alias("at"), F.col(key).cast("long").alias("key"))
    runs = scanned.mapInArrow(batched(_runs), "path string, at long, n long, key long")
    ordered = runs.repartition(shuffle_width(spark), "path").sortWithinPartitions("path", "at")
    out = ordered.mapInArrow(batched(_hashed), "path string, n_rows long, ids_sha256 string")
    return out.withColumn("name", F.element_at(F.split("path", "/"), -1))


def co_bucketed(spark: SparkSession, folder: str, first: DataFrame, second: DataFrame, key: str, names: tuple[str, str], numbers: tuple[Column, Column], layout: Layout = Layout()) -> DataFrame:
    """Writes both tables to folder/<name> in numbered files, rewrites them by bucket, and describes each final file.

    (table_name, path, columns, ids_sha256, lineage_sha256, bucket, n_rows, n_joined, rewritten). The key is a whole
    number. Null keys lie in the last bucket, orphans of the second table in the one before; n_joined is 0 for both.
    Repeated rows are all kept, and so are further columns, whatever their names: their rows are handled as structs. Columns have to be
    of kinds that can be sorted. An empty table has no file, and two empty tables give no row.
    """
    schemas = first.schema, second.schema
    folders = [f"{folder}/{name}" for name in names]
    start = [lay_out(t, number, layout.no_key + 1, key, at) for t, number, at in zip((first, second), numbers, folders)]
    # an unread folder may have no file at all
    read = [read_numbered(spark, at, schema, key) if there else spark.createDataFrame([], schema).select(F.struct("*").alias("row"), F.col(key).alias("key"), F.lit(0).alias("file")) for at, schema, there in zip(folders, schemas, start)]
    left, right = (durable(x) for x in with_buckets(*read, layout))
    joined = durable(joined_rows(left, right, layout))
    out = []
    for name, at, schema, rows, begun in zip(names, folders, schemas, (left, right), start):
        flows = durable(lineage(rows))
        final = rewrite(at, rows, flows, begun, schema.names, key, layout)
        if not begun:
            continue
        # at most one entry for each starting file
        origin = flows.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("file", "n"))).alias("of"))
        origin = origin.select("bucket", F.sha2(F.array_join(F.transform("of", lambda x: F.concat_ws(":", x["file"].cast("string"), x["n"].cast("string"))), ","), 256).alias("lineage_sha256"))
        out.append(
            file_digests(spark, at, schema, key)
            .join(final, "name")
            .join(origin, "bucket")
            .join(joined, "bucket", "left")
            .select(
                F.lit(name).alias("table_name"), "path", F.lit(",".join(schema.names)).alias("columns"), "ids_sha256", "lineage_sha256",
                F.col("bucket").cast("long").alias("bucket"), "n_rows", F.coalesce("n_joined", F.lit(0)).cast("long").alias("n_joined"), "rewritten",
            )
        )
    if not out:
        return spark.createDataFrame([], "table_name string, path string, columns string, ids_sha256 string, lineage_sha256 string, bucket long, n_rows long, n_joined long, rewritten boolean")
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def sales_and_lines(sales: DataFrame, lines: DataFrame, folder: str, layout: Layout = Layout()) -> DataFrame:
    """The shop's sales and their lines by sale_id, which start in files by bucket and by item."""
    numbers = file_of_sale(F.col("sale_id"), layout), file_of_line(F.col("item_id"), layout)
    return co_bucketed(sales.sparkSession, folder, sales, lines, "sale_id", ("sales", "sale_lines"), numbers, layout)
