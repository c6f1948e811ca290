"""The same operators over a growing input: windows with watermarks, resumable exports, and clusters that are kept as state.

Every flow can run to the end of what is there (availableNow) from a schedule, and goes on from its checkpoint.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupStateTimeout


def read_stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def tumbling(events: DataFrame, at: str, width: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Counts and sums of value by window and keys; events later than `late` are dropped once their window is out."""
    w = events.withWatermark(at, late).groupBy(F.window(at, width), *keys)
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def sliding(events: DataFrame, at: str, width: str, step: str, keys: list[str], late: str = "1 day") -> DataFrame:
    w = events.withWatermark(at, late).groupBy(F.window(at, width, step), *keys)
    return w.agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, at: str, gap: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """Runs of events of a key with no pause longer than gap."""
    w = events.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys)
    return w.agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")


def near_founders(subjects: DataFrame, founders: DataFrame, hours: int = 48, late: str = "1 day") -> DataFrame:
    """(story_id, cluster_id) of two streams, as cluster.near_founders gives it for what they hold: same country, or both of none, and at most so many hours apart.

    Rows of either side may come up to `late` after newer ones, and before or after those that they meet. What no row to
    come can meet any more leaves the state: a row stays for `hours` and `late` beyond its own time, by the slower stream.

    State is kept by country and cell of twice that time, a founder in the two that it reaches: a row is compared to what is in
    its cell, half of which it meets, not to all that is kept of its country. Smaller cells would save little more, and copy more state.
    """
    cell = lambda seconds: F.floor(seconds / (hours * 7200))
    founded, reach = F.unix_timestamp("founder_published"), hours * 3600
    within = f"founder_published BETWEEN published - INTERVAL {hours} HOURS AND published + INTERVAL {hours} HOURS"
    a = subjects.select("story_id", "country", "published").withWatermark("published", late).withColumn("w", cell(F.unix_timestamp("published")))
    b = founders.select("cluster_id", "founder_country", "founder_published").withWatermark("founder_published", late)
    b = b.withColumn("reached", F.explode(F.sequence(cell(founded - reach), cell(founded + reach))))
    met = a.join(b, F.col("country").eqNullSafe(F.col("founder_country")) & (F.col("w") == F.col("reached")) & F.expr(within))
    return met.select("story_id", "cluster_id", "published", "founder_published")


def silent(events: DataFrame, key: str, at: str, now, hours: int) -> DataFrame:
    """(key, last, silent) of each key: has nothing come for so many hours?"""
    last = events.groupBy(key).agg(F.max(at).alias("last"))
    return last.withColumn("silent", F.unix_timestamp(now) - F.unix_timestamp("last") > hours * 3600)


def _kind(fields: tuple):
    """What equal fields have in common as a key; lists can't be one."""
    try:
        hash(fields)
    except TypeError:
        return pickle.dumps(fields)
    return fields


class _Known:
    """Founders that stories, which come in order of their time, are compared to.

    Founders with equal fields are one kind, in order of (time, id), and stories with equal fields know the kinds that they are the same
    as. So `same` is asked about two kinds, not about each story and founder, and only of kinds that are near in time.
    """

    def __init__(self, same: Callable[[tuple, tuple], bool], keep: float, founders: list[tuple]):
        self.same, self.keep = same, keep
        self.kinds: dict = {}  # kind: its fields, and (time, id) of its founders
        self.news: list = []  # kinds as they came up, again if they had been out of reach
        self.asked: dict = {}  # kind of a story: how many of the news it knows, and those that are the same
        for f in founders:
            self.add(f)

    def add(self, founder: tuple) -> None:
        story, at, *fields = founder
        kind = _kind(tuple(fields))
        _, found = self.kinds.setdefault(kind, (tuple(fields), []))
        if not found or at - found[-1][0] > self.keep:
            self.news.append(kind)
        insort(found, (at, story))

    def first(self, at: float, mine: tuple) -> tuple[float, str] | None:
        """(time, id) of the first founder near in time that mine is the same as."""
        kind = _kind(mine)
        known, alike = self.asked.get(kind, (0, {}))
        for k in self.news[known:]:
            fields, found = self.kinds[k]
            if k not in alike and at - found[-1][0] <= self.keep and self.same(mine, fields):
                alike[k] = found
        self.asked[kind] = len(self.news), alike
        best, gone = None, []
        for k, found in alike.items():
            if at - found[-1][0] > self.keep:
                gone.append(k)
                continue
            i = max(bisect_left(found, (at - self.keep,)) - 1, 0)
            while at - found[i][0] > self.keep:
                i += 1
            if found[i][0] - at <= self.keep and (best is None or found[i] < best):
                best = found[i]
        for k in gone:
            del alike[k]
        return best


def leaders(stories: DataFrame, same: Callable[[tuple, tuple], bool], key: str, fields: list[str], keep_hours: int = 48) -> DataFrame:
    """(key, story_id, founder_id) of a stream of stories: each joins the first founder of its key that it is the same as, or founds.

    The first is by (published, story_id), as in cluster.place, so stories that come in order give what that gives. State is the
    founders of a key within twice keep_hours of its newest story; older ones can't be joined any more. Within a
    trigger stories go in order of (published, story_id); one that comes late is compared to the founders there are by then and
    may join a later one, as what was said of others is not taken back. A story without a time founds its own
    cluster and is never joined.
    """

    def step(group: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        newest, kept = state.get if state.exists else (float("-inf"), [])
        founders = [tuple(x) for x in kept]
        known = _Known(same, keep_hours * 3600, founders)
        df = pd.concat(list(batches)).sort_values(["published", "story_id"])
        out = []
        for row in df.itertuples(index=False):
            if pd.isna(row.published):
                out.append((group[0], row.story_id, row.story_id))
                continue
            at = row.published.timestamp()
            newest = max(newest, at)
            mine = tuple(getattr(row, f) for f in fields)
            first = known.first(at, mine)
            if first is None:
                founders.append((row.story_id, at, *mine))
                known.add(founders[-1])
            out.append((group[0], row.story_id, first[1] if first else row.story_id))
        founders = sorted((f for f in founders if f[1] >= newest - 2 * keep_hours * 3600), key=lambda f: (f[1], f[0]))
        state.update((newest, [list(f) for f in founders]))
        yield pd.DataFrame(out, columns=[key, "story_id", "founder_id"])

    kinds = dict(stories.dtypes)
    founder = "struct<id:string,at:double," + ",".join(f"{f}:{kinds[f]}" for f in fields) + ">"
    picked = stories.select(key, F.col("story_id").cast("string").alias("story_id"), "published", *fields)
    return picked.groupBy(key).applyInPandasWithState(step, f"{key} {kinds[key]}, story_id string, founder_id string", f"newest double, founders array<{founder}>", "append", GroupStateTimeout.NoTimeout)


class _Founders(StatefulProcessor):
    """Founders of a key by the values that they have, and by the day on which they are to be forgotten."""

    def __init__(self, same: Callable[[tuple, tuple], bool], fields: list[str], founder: str, keep_hours: int):
        self.same, self.fields, self.founder, self.keep = same, fields, founder, keep_hours * 3600

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.by_value = handle.getMapState("by_value", "v string", f"founders array<{self.founder}>")
        self.by_hour = handle.getMapState("by_hour", "hour long", "values array<string>")

    def _at(self, state, key) -> list:
        return [tuple(x) if not isinstance(x, str) else x for x in state.getValue((key,))[0]] if state.containsKey((key,)) else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # each value's founders are read and written once a trigger, not for each row
        out, held, known, changed, hours = [], {}, {}, set(), {}
        for row in pd.concat(list(rows)).sort_values(["published", "story_id"]).itertuples(index=False):
            at, mine, values = row.published.timestamp(), tuple(getattr(row, f) for f in self.fields), sorted({v for v in row.values if v is not None})
            for v in values:
                if v not in held:
                    held[v] = self._at(self.by_value, v)
                    known[v] = _Known(self.same, self.keep, held[v])
            first = min((f for v in values if (f := known[v].first(at, mine))), default=None)
            if first is None:
                for v in values:
                    held[v].append((row.story_id, at, *mine))
                    known[v].add(held[v][-1])
                changed.update(values)
                if values:
                    hours.setdefault(int(at + 2 * self.keep) // 3600 + 1, set()).update(values)
            out.append((key[0], row.story_id, first[1] if first else row.story_id))
        for v in changed:
            self.by_value.updateValue((v,), (held[v],))
        for hour, values in hours.items():
            self.by_hour.updateValue((hour,), (sorted({*self._at(self.by_hour, hour), *values}),))
            self.handle.registerTimer(hour * 3_600_000)
        yield pd.DataFrame(out, columns=["key", "story_id", "founder_id"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        hour = expiredTimerInfo.getExpiryTimeInMs() // 3_600_000
        for v in self._at(self.by_hour, hour):
            left = [f for f in self._at(self.by_value, v) if int(f[1] + 2 * self.keep) // 3600 + 1 > hour]
            if left:
                self.by_value.updateValue((v,), (left,))
            elif self.by_value.containsKey((v,)):
                self.by_value.removeKey((v,))
        if self.by_hour.containsKey((hour,)):
            self.by_hour.removeKey((hour,))
        return iter(())

    def close(self) -> None:
        pass


def indexed_leaders(stories: DataFrame, same: Callable[[tuple, tuple], bool], key: str, values: str, fields: list[str], keep_hours: int = 48, late: str = "1 day") -> DataFrame:
    """leaders() for stories that can only be the same if they share one of the strings in the column `values`: places' cells, entities, words.

    Founders are kept by these, so a story is compared to those that share one, not to all of its key. A founder is
    forgotten by a timer, once the watermark is twice keep_hours past its time, whether or not its key gets another story;
    a story that comes later than `late` is dropped. A story without a time founds its own cluster, outside of the state.
    """
    kinds = dict(stories.dtypes)
    founder = "struct<id:string,at:double," + ",".join(f"{f}:{kinds[f]}" for f in fields) + ">"
    picked = stories.select(F.col(key).alias("key"), F.col("story_id").cast("string").alias("story_id"), "published", F.coalesce(values, F.array().cast("array<string>")).alias("values"), *fields)
    own = picked.filter("published IS NULL").select("key", "story_id", F.col("story_id").alias("founder_id"))
    timed = picked.filter("published IS NOT NULL").withWatermark("published", late)
    found = timed.groupBy("key").transformWithStateInPandas(_Founders(same, fields, founder, keep_hours), f"key {kinds[key]}, story_id string, founder_id string", "append", "eventTime")
    return found.unionByName(own).select(F.col("key").alias(key), "story_id", "founder_id")


#: The store of state that maps and timers need; Spark reads the setting when a query starts.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Each partition of state has files to write in each batch, rows or not; what is kept is short, so a few for each core do.
WIDTH = "spark.sql.shuffle.partitions"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_once(flow: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", keyed_state: bool = False) -> list[dict]:
    """All that has come since the last run, given to sink in batches; a batch that failed comes again with its number.

    keyed_state is for flows with indexed_leaders. What each batch reports of its state comes back: rows kept, and rows dropped as too late.
    """
    conf = flow.sparkSession.conf
    before, width = conf.get(STATE_STORE), conf.get(WIDTH)
    try:
        conf.set(WIDTH, str(min(int(width), 4 * flow.sparkSession.sparkContext.defaultParallelism)))  # a checkpoint keeps the number that it began with
        if keyed_state:
            conf.set(STATE_STORE, ROCKS)
        query = flow.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
        query.awaitTermination()
    finally:
        conf.set(STATE_STORE, before)
        conf.set(WIDTH, width)
    return [{"rows": p.numInputRows, "kept": sum(s.numRowsTotal for s in p.stateOperators), "late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators)} for p in query.recentProgress]
