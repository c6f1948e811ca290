"""Incremental export by a cursor: what to send again, as what, and in which bodies."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian import schemas
from meridian.functions import geo, hashing, times
from meridian.functions import text as T
from meridian.operators.tables import read_text, replace_text, stored

WINDOW_DAYS, TEXT_HOURS, COLD_START = 7, 24, 20_000
MAX_BATCH, TARGET_BYTES = 500, 3 << 20


def run_limit(cursor, limit: int) -> int:
    """A first run sends the whole window at once."""
    return limit if cursor else max(limit, COLD_START)


def run_limits(cursor: Column, limit: Column) -> Column:
    """run_limit() of columns."""
    return F.when(F.coalesce(cursor, F.lit("")) != "", limit).otherwise(F.greatest(limit, F.lit(COLD_START)))


def rows_since(stories: DataFrame, texts: DataFrame, extractions: DataFrame, extract_hash: str, cursor: Column, floor: Column, limit: int) -> DataFrame:
    """Stories seen, or read, after the cursor and seen after the floor, the longest ago first.

    A story whose reading is newer than the cursor goes again. A story without one has no such time, which is neither
    before nor after: then only when it was seen counts.
    """
    read = extractions.filter(F.col("config_hash") == extract_hash).drop("config_hash", "text_hash")
    j = stories.join(texts.select("story_id", "text"), "story_id", "left").join(read, "story_id", "left")
    due = ((F.col("last_seen_at") > cursor) | (F.col("created_at") > cursor)) & (F.col("last_seen_at") > floor)
    return j.filter(due & ~F.col("outlet").isin(schemas.DROPPED_OUTLETS)).orderBy("last_seen_at", "story_id").limit(limit)


def with_sections(rows: DataFrame, sections: DataFrame) -> DataFrame:
    lists = sections.groupBy("story_id").agg(F.sort_array(F.collect_list("section")).alias("sections"))
    return rows.join(lists, "story_id", "left").withColumn("sections", F.coalesce("sections", F.array().cast("array<string>")))


def pin_veto(category, place_kind) -> Column:
    """Why a reading may not draw a place; null if it may."""
    return F.when(~geo.can_pin(category), F.lit("category_never_pins")).when(
        F.lower(F.trim(F.coalesce(T.col(place_kind), F.lit("")))).isin(schemas.NEVER_PINNED_KINDS), F.lit("precision_never_pins")
    )


def event() -> Column:
    """The reading of a row as it is sent: without its place if it draws none; null if the story was not read or came from a feed."""
    physical = F.col("is_physical_event") & pin_veto("category", "place_kind").isNull()
    place = lambda c: F.when(physical, F.col(c))
    first = lambda c: F.slice(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x) != ""), 1, 12)
    whole = F.struct(
        physical.alias("isPhysical"),
        F.col("category").alias("category"),
        F.date_format("event_date", "yyyy-MM-dd").alias("eventDate"),
        place("place_name").alias("placeName"),
        place("place_within").alias("placeWithin"),
        place("place_country").alias("placeCountry"),
        place("place_kind").alias("placeKind"),
        place("place_quote").alias("quote"),
        first("other_places").alias("otherPlaces"),
        first("key_entities").alias("keyEntities"),
    )
    return F.when(F.col("is_physical_event").isNotNull() & ~F.col("status").eqNullSafe("feed"), whole)


def sends_text(cursor: Column, now: Column) -> Column:
    """Is a row's text to go along: was it first seen lately, and after the cursor?"""
    has = F.coalesce("text", F.lit("")) != ""
    recent = F.col("first_seen_at") >= now - F.make_dt_interval(hours=F.lit(TEXT_HOURS))
    return F.coalesce(has & recent & (cursor.isNull() | (F.col("first_seen_at") > cursor)), F.lit(False))


def items(rows: DataFrame, cursor: Column, now: Column) -> DataFrame:
    """(last_seen_at, story_id, item): JSON of each row, with a hash over all that can change in it."""

    @F.pandas_udf("string")
    def hashed(material: pd.Series) -> pd.Series:
        return material.map(lambda x: hashing.item_hash(json.loads(x)))

    j = rows.withColumn("event", event())
    material = F.to_json(
        F.struct("headline", "description", "url", times.iso("published").alias("published"), "thumbnail", "word_count", "text_hash", "sections", F.array_sort("format_flags").alias("flags"), "event"),
        {"ignoreNullFields": "false"},
    )
    item = F.struct(
        F.col("story_id").alias("id"),
        "outlet",
        F.col("headline").alias("title"),
        "description",
        "url",
        times.iso("published").alias("published"),
        times.iso("first_seen_at").alias("firstSeenAt"),
        times.iso("last_seen_at").alias("lastSeenAt"),
        hashed(material).alias("itemHash"),
        "sections",
        F.col("format_flags").alias("formatFlags"),
        F.col("word_count").alias("wordCount"),
        "thumbnail",
        F.col("text_hash").alias("textHash"),
        F.map_keys("categories").alias("keywords"),
        F.array().cast("array<string>").alias("placeHints"),
        "event",
        F.when(sends_text(cursor, now), F.col("text")).alias("text"),
    )
    return j.select("last_seen_at", "story_id", F.to_json(item).alias("item"))


def batch_numbers(sizes, most: int = MAX_BATCH, target: int = TARGET_BYTES) -> Column:
    """The batch, from 0, of each of an array of sizes in order: a new one where the count or the bytes would be too much.

    What is too large by itself goes alone. The sum starts anew at each batch, which no window frame can do; a fold can.
    """
    fresh = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("bytes"), F.array().cast("array<int>").alias("out"))

    def step(acc, size):
        full = (acc["n"] > 0) & ((acc["n"] >= most) | (acc["bytes"] + size > target))
        batch = F.when(full, acc["batch"] + 1).otherwise(acc["batch"])
        return F.struct(
            batch.alias("batch"),
            F.when(full, F.lit(1)).otherwise(acc["n"] + 1).alias("n"),
            F.when(full, size).otherwise(acc["bytes"] + size).cast("long").alias("bytes"),
            F.concat(acc["out"], F.array(batch)).alias("out"),
        )

    return F.aggregate(T.col(sizes), fresh, step, lambda acc: acc["out"])


def _next_starts(sums: np.ndarray, most: int, target: int) -> np.ndarray:
    """Where the batch after one that begins at each row begins; sums are those of the sizes before each row."""
    n = len(sums) - 1
    here = np.arange(n)
    by_bytes = np.searchsorted(sums, sums[:-1] + target, side="right") - 1
    return np.maximum(np.minimum(np.minimum(here + most, by_bytes), n), here + 1)


def batched_rows(rows: DataFrame, group: str, order: str | list[str], size: str, most: int = MAX_BATCH, target: int = TARGET_BYTES) -> DataFrame:
    """rows with batch, the number that batch_numbers gives each within its group, for groups of any length.

    Rows are dealt by ranges of (group, order). How a chunk goes on depends only on where the first batch of its own begins, which
    is within its first `most` rows; so each chunk works out, for all of those, how many batches it begins and what the
    last one holds at its end. One short row for each chunk is then followed through a group, and chunks number their rows.
    """
    kinds, order = dict(rows.dtypes), [order] if isinstance(order, str) else order
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        for batch in batches:
            yield batch.assign(chunk=TaskContext.get().partitionId())

    dealt = stored(rows.repartitionByRange(width, group, *order).sortWithinPartitions(group, *order).mapInPandas(numbered, f"{columns}, chunk int"))

    def sums_of(part: pd.DataFrame) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(part[size].to_numpy(dtype=np.int64))))

    def summed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        sums = sums_of(part.sort_values(order))
        n = len(part)
        jump = _next_starts(sums, most, target)
        begun, last = np.ones(n, dtype=np.int64), np.arange(n)
        while (inside := jump < n).any():  # twice as far each time
            to = jump[inside]
            begun[inside] += begun[to]
            last[inside] = last[to]
            jump[inside] = jump[to]
        few = min(most, n)
        row = (key[0], key[1], n, sums[: few + 1].tolist(), begun[:few].tolist(), (n - last[:few]).tolist(), (sums[n] - sums[last[:few]]).tolist(), int(sums[n]))
        return pd.DataFrame([row], columns=["chunk", group, "n", "sums", "begun", "left_n", "left_bytes", "bytes"])

    shape = f"chunk int, `{group}` {kinds[group]}, n long, sums array<long>, begun array<long>, left_n array<long>, left_bytes array<long>, bytes long"
    chunks = dealt.groupBy("chunk", group).applyInPandas(summed, shape)

    def followed(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        out, begun, held_n, held_bytes = [], 0, most, 0
        for c in parts.sort_values("chunk").itertuples(index=False):
            fits = min(most - held_n, int(np.searchsorted(c.sums, target - held_bytes, side="right")) - 1, c.n)
            first = max(fits, 0) if begun else 0
            out.append((c.chunk, key[0], first, begun))
            if first >= c.n:
                held_n, held_bytes = held_n + c.n, held_bytes + c.bytes
            else:
                begun, held_n, held_bytes = begun + int(c.begun[first]), int(c.left_n[first]), int(c.left_bytes[first])
        return pd.DataFrame(out, columns=["chunk", group, "first", "begun"])

    entered = chunks.groupBy(group).applyInPandas(followed, f"chunk int, `{group}` {kinds[group]}, first long, begun long")

    def named(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order)
        jump = _next_starts(sums_of(part), most, target)
        first, begun = int(part["first"].iloc[0]), int(part["begun"].iloc[0])
        marks = np.zeros(len(part), dtype=np.int64)
        while first < len(part):
            marks[first] = 1
            first = int(jump[first])
        return part.assign(batch=begun - 1 + np.cumsum(marks))[[*kinds, "batch"]]

    back = dealt.join(entered.withColumnRenamed(group, "_group"), (dealt["chunk"] == entered["chunk"]) & F.col(group).eqNullSafe(F.col("_group"))).select(dealt["*"], "first", "begun")
    return back.groupBy("chunk", group).applyInPandas(named, f"{columns}, batch long")


def bodies(found: DataFrame, generated_at: str, most: int = MAX_BATCH, target: int = TARGET_BYTES) -> Iterator[bytes]:
    """Bodies to send, in order. One run sends at most run_limit rows; they pass through the driver one at a time."""
    batch, size = [], 0
    for row in found.orderBy("last_seen_at", "story_id").toLocalIterator():
        n = len(row["item"].encode())
        if batch and (len(batch) >= most or size + n > target):
            yield _body(batch, generated_at)
            batch, size = [], 0
        batch.append(row["item"])
        size += n
    if batch:
        yield _body(batch, generated_at)


def body_rows(found: DataFrame, generated_at: str, most: int = MAX_BATCH, target: int = TARGET_BYTES) -> DataFrame:
    """(batch, n, body): the same bodies as rows, numbered from 0, whatever their number.

    Only keys and sizes go through the batches; items meet again in the groups of their batch, which are as small as a body.
    """
    keys = found.select(F.lit(0).alias("all"), "last_seen_at", "story_id", F.octet_length("item").cast("long").alias("size"))
    numbered = batched_rows(keys, "all", ["last_seen_at", "story_id"], "size", most, target).select("story_id", "batch")
    listed = found.join(numbered, "story_id").groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("last_seen_at", "story_id", "item"))).alias("items"))
    head, tail = f'{{"version":1,"generatedAt":{json.dumps(generated_at)},"items":[', "]}"
    return listed.select("batch", F.size("items").alias("n"), F.concat(F.lit(head), F.array_join(F.transform("items", lambda x: x["item"]), ","), F.lit(tail)).alias("body"))


def signed_rows(bodies: DataFrame, secret: str, prefix: str, timestamp_ms: int) -> DataFrame:
    """bodies(body, ...) with content_sha256 and signature, those of signed(), worked out by Spark; compress a body after it is signed."""
    sha = F.sha2(F.encode("body", "UTF-8"), 256)
    text = F.concat_ws("\n", F.lit(prefix), F.lit(str(timestamp_ms)), sha)
    return bodies.withColumns({"content_sha256": sha, "signature": hashing.signature(secret, text)})


def load_state(spark: SparkSession, path: str) -> dict:
    """What a run left in the shared folder; empty if there is nothing, or nothing that can be read."""
    try:
        found = json.loads(read_text(spark, path) or "{}")
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def save_state(spark: SparkSession, path: str, **fields) -> dict:
    """The state with fields changed, replaced as a whole, so it outlives the driver; texts lose credentials first."""
    state = load_state(spark, path) | {k: T.redacted(v) if isinstance(v, str) else v for k, v in fields.items()}
    replace_text(spark, path, json.dumps(state, sort_keys=True, ensure_ascii=False))
    return state


def run_export(tables: dict[str, DataFrame], path: str, now: dt.datetime, send: Callable[[DataFrame], None], extract_hash: str, limit: int) -> int:
    """Sends the rows that are due, and moves the cursor in the state at `path` if send() ends well; gives their number.

    The start is the cursor, or the window's begin if there is none or it is older: so a state that is lost means that the
    window goes again. A run whose send() fails leaves the cursor and a note of the error, and the next one sends the same
    rows. The cursor is the newest last_seen_at that was sent; rows of that very time go together only if the limit does not part
    them, so it stays one step before them if it might have.
    """
    spark = tables["stories"].sparkSession
    state, at = load_state(spark, path), F.lit(now)
    cursor = F.timestamp_micros(F.lit(state.get("cursor_us")).cast("long"))
    most = run_limit(state.get("cursor_us"), limit)
    floor = times.start_point(F.lit(None).cast("timestamp"), at)
    found = stored(rows_since(tables["stories"], tables["story_texts"], tables["extractions"], extract_hash, times.start_point(cursor, at), floor, most))
    seen = found.select(F.unix_micros("last_seen_at").alias("us"))
    n, newest = seen.agg(F.count(F.lit(1)), F.max("us")).first()
    before = seen.filter(F.col("us") < newest).agg(F.max("us")).first()[0] if n >= most else None
    try:
        send(found)
    except Exception as error:
        save_state(spark, path, last_error=str(error)[:200])
        raise
    reached = max((x for x in (before or newest, state.get("cursor_us")) if x is not None), default=None)
    save_state(spark, path, cursor_us=reached, last_ok_at=now.isoformat(), last_error=None)
    return n


def _body(batch: list[str], generated_at: str) -> bytes:
    return f'{{"version":1,"generatedAt":{json.dumps(generated_at)},"items":[{",".join(batch)}]}}'.encode()


def signed(body: bytes, secret: str, prefix: str, timestamp_ms: int) -> tuple[dict[str, str], bytes]:
    """Headers and the compressed body of a request. The signature is over the body as it was before compression."""
    text = hashing.signing_text(prefix, timestamp_ms, body)
    headers = {
        "content-type": "application/json",
        "content-encoding": "gzip",
        "x-timestamp": str(timestamp_ms),
        "x-content-sha256": text.rpartition("\n")[2],
        "x-signature": hashing.sign(secret, text),
    }
    return headers, gzip.compress(body, mtime=0)


def read_state(path: str) -> dict:
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return {}


def write_state(path: str, **fields) -> dict:
    """State on the driver's disk with fields changed, swapped in as a whole."""
    state = read_state(path) | fields
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    handle, part = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    with os.fdopen(handle, "w", encoding="utf-8") as f:
        json.dump(state, f, sort_keys=True, ensure_ascii=False)
    os.replace(part, path)
    return state
