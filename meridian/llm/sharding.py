"""Sharding by fixed virtual slots.

A record's key is hashed into one of n_slots slots, for good. Bytes are summed per slot, and a slot map
(version, slot, shard, bytes, rows) deals the slots to shards so that shard sizes come out near equal. A
rebalance writes a new version of the map that moves only as many slots as it must; records never rehash.

Only the map decides where a record lies, so a hot source or a large group of copies has no effect: its
records have different ids and spread over all slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import durable, or_empty

N_SLOTS = 4096
MAP_SCHEMA = "version int, slot_id int, shard int, bytes long, rows long"


def slotted(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, slot_id) of every row; a null text has size 1, and a null doc_id has a slot too.

    The slot comes from the MD5 of doc_id as text, which any engine can work out.
    """
    number = F.conv(F.substring(F.md5(or_empty(F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long")
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(or_empty(F.col("text"))).alias("text_crc32"),
        F.pmod(number, F.lit(n_slots)).cast("int").alias("slot_id"),
    )


def slot_sizes(rows: DataFrame) -> DataFrame:
    """(slot_id, bytes, rows): at most n_slots rows, summed on the map side first."""
    return rows.groupBy("slot_id").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def deal(slots: DataFrame, n_shards: int, version: int = 1) -> DataFrame:
    """A slot map for slots(slot_id, bytes, rows, kept_shard): slots with a kept_shard stay there, and the
    others go, largest first, each to the shard that is least full by then.

    The fold runs over the slots, whose number is fixed, in one task: at most n_slots rows whatever the input.
    """
    entry = F.struct(F.col("bytes"), F.col("slot_id"), F.col("rows"), F.col("kept_shard"))
    all_slots = slots.agg(F.sort_array(F.collect_list(entry), asc=False).alias("slots"))
    base = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda s: F.aggregate(
            F.filter("slots", lambda x: x["kept_shard"] == s), F.lit(0).cast("long"), lambda a, x: a + x["bytes"]
        ),
    )
    free = F.filter("slots", lambda x: x["kept_shard"].isNull())

    def put(acc, x):
        to = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int") - 1
        load = F.transform(acc["load"], lambda v, i: F.when(i == to, v + x["bytes"]).otherwise(v))
        return F.struct(load.alias("load"), F.concat(acc["shard"], F.array(to)).alias("shard"))

    start = F.struct(base.alias("load"), F.array().cast("array<int>").alias("shard"))
    dealt = all_slots.select(
        free.alias("free"), F.filter("slots", lambda x: x["kept_shard"].isNotNull()).alias("kept"), F.aggregate(free, start, put)["shard"].alias("to")
    )
    rows = F.concat(
        F.transform("kept", lambda x: F.struct(x["slot_id"].alias("slot_id"), x["kept_shard"].alias("shard"), x["bytes"].alias("bytes"), x["rows"].alias("rows"))),
        F.transform("free", lambda x, i: F.struct(x["slot_id"].alias("slot_id"), F.get("to", i).alias("shard"), x["bytes"].alias("bytes"), x["rows"].alias("rows"))),
    )
    return dealt.select(F.inline(rows)).select(F.lit(version).alias("version"), "slot_id", "shard", "bytes", "rows")


def slot_map(rows: DataFrame, n_shards: int) -> DataFrame:
    """Version 1 of the map."""
    return deal(slot_sizes(rows).withColumn("kept_shard", F.lit(None).cast("int")), n_shards)


def rebalance(old: DataFrame, sizes: DataFrame, n_shards: int) -> DataFrame:
    """The next version of map old for the present slot sizes and n_shards.

    A shard over the mean gives up its smallest slots while half of each at least fits into what it has too much; the slots
    of a shard that is no more go too, and a new slot needs a place. All other slots stay where they are.
    """
    now = sizes.join(old.select("slot_id", "shard", F.col("version").alias("old_version")), "slot_id", "left")
    mean = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)) / n_shards).first()[0]
    last = old.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]
    by_shard = Window.partitionBy("shard")
    run = F.sum("bytes").over(by_shard.orderBy("bytes", "slot_id"))
    over = F.sum("bytes").over(by_shard) - F.lit(mean)
    kept = now.withColumn("gives", (F.col("shard") >= n_shards) | (run - F.col("bytes") / 2 <= over)).select(
        "slot_id", "bytes", "rows", F.when(~F.col("gives"), F.col("shard")).alias("kept_shard")
    )
    return deal(kept, n_shards, last + 1)


def save_map(mapping: DataFrame, path: str) -> None:
    """Adds this version to the table of maps at path; older versions stay readable."""
    mapping.write.mode("append").partitionBy("version").parquet(path)


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """One version of the map, the newest unless named."""
    maps = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version)


def placed(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """rows with shard, and slot: the row's place in its shard, gapless from 0.

    A place is the slot's start in its shard, a running sum over the map's few rows, plus the rank in the slot.
    So no window ever holds a whole shard, only one slot in n_slots.
    """
    start = F.sum("rows").over(Window.partitionBy("shard").orderBy("slot_id")) - F.col("rows")
    starts = mapping.select("slot_id", "shard", start.alias("start"))
    rank = F.row_number().over(Window.partitionBy("slot_id").orderBy("doc_id", "text_crc32", "size"))
    # the map has at most n_slots rows: a bound that no input moves
    return rows.withColumn("rank", rank).join(F.broadcast(starts), "slot_id").withColumn("slot", F.col("start") + F.col("rank") - 1)


def shard(docs: DataFrame, n_shards: int = 8, n_slots: int = N_SLOTS) -> DataFrame:
    """Every row of docs(doc_id, text, ...) with its size, slot and shard.

    Nulls: a null text counts one byte, a null doc_id hashes as null. Repeated rows each get a place of their own.
    An empty table gives an empty result. Other columns are not looked at.
    """
    rows = durable(slotted(docs, n_slots))
    return placed(rows, durable(slot_map(rows, n_shards)))


#: The rows of the query: CRC-32 by a table of 256 steps, byte by byte; slots by MD5; the largest slots dealt first, one at a time.
SQL = """
WITH RECURSIVE steps AS (
  SELECT n, n AS c, 0 AS k FROM range(256) t(n)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8
), flat AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), rows AS (
  SELECT doc_id, CAST(n + 1 AS BIGINT) AS size,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * n, 2), lambda p: CAST('0x' || substr(h, p, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) AS text_crc32,
    CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 4096 AS INTEGER) AS slot_id
  FROM flat, crc
), slots AS (
  SELECT slot_id, sum(size) AS bytes, count(*) AS n, row_number() OVER (ORDER BY sum(size) DESC, slot_id DESC) AS k FROM rows GROUP BY slot_id
), dealt AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST(-1 AS INTEGER) AS slot_id, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS shard, [0, 0, 0, 0, 0, 0, 0, 0]::HUGEINT[] AS load
  UNION ALL
  SELECT s.k, s.slot_id, s.n, list_position(d.load, list_min(d.load)) - 1,
    list_transform(d.load, lambda v, i: CASE WHEN i = list_position(d.load, list_min(d.load)) THEN v + s.bytes ELSE v END)
  FROM dealt d JOIN slots s ON s.k = d.k + 1
), starts AS (
  SELECT slot_id, shard, sum(n) OVER (PARTITION BY shard ORDER BY slot_id) - n AS start FROM dealt WHERE k > 0
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(start + row_number() OVER (PARTITION BY slot_id ORDER BY doc_id, text_crc32, size) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, slot_id
FROM rows JOIN starts USING (slot_id)
"""
