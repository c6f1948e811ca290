"""Is everything still coming in? Checks with three answers, and when to say so."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions import text as T
from meridian.functions import times

FAILED_RUNS, SILENCE_HOURS, NEWEST_MINUTES, PUSH_MINUTES, RESTART_GRACE, DIGEST_HOURS = 3, 12, 60, 20, 10, 24
PRODUCTION_NEWEST = 60


def _check(name: Column, ok: Column, detail: Column) -> list[Column]:
    return [name.alias("name"), ok.cast("boolean").alias("ok"), detail.alias("detail")]


def store_checks(health: DataFrame, stories: DataFrame, now: Column, scraped: list[str], dropped: list[str]) -> DataFrame:
    """(name, ok, detail): failed runs of each outlet, silence of those that are read, and the newest story of all."""
    own = health.filter(~F.col("outlet").isin(dropped))
    failures = F.coalesce("consecutive_failures", F.lit(0))
    runs = own.select(*_check(F.concat(F.lit("runs:"), "outlet"), failures < FAILED_RUNS, F.concat_ws(" ", "outlet", failures.cast("string"), F.lit("failed runs in a row"), F.when(failures >= FAILED_RUNS, T.shorten("last_error")))))
    age = times.minutes_since("last_new_story_at", now)
    silence = own.filter(F.col("outlet").isin(scraped)).select(
        *_check(F.concat(F.lit("silence:"), "outlet"), F.coalesce(age <= SILENCE_HOURS * 60, F.lit(False)), F.coalesce(F.concat_ws(" ", "outlet", F.lit("last new story"), age.cast("string"), F.lit("min ago")), F.lit("")))
    )
    newest = stories.filter(~F.col("outlet").isin(dropped)).agg(F.max("first_seen_at").alias("t"))
    age = times.minutes_since("t", now)
    newest = newest.select(*_check(F.lit("newest"), F.coalesce(age <= NEWEST_MINUTES, F.lit(False)), F.coalesce(F.concat(age.cast("string"), F.lit(" min old")), F.lit("no story"))))
    return reduce(DataFrame.unionByName, [runs, silence, newest])


def push_check(state: dict, now_s: int) -> tuple[str, bool | None, str]:
    ok_at = state.get("last_ok_at_s")
    if ok_at is None:
        return "rail", False, "never pushed"
    age = (now_s - ok_at) // 60
    return "rail", age <= PUSH_MINUTES, f"pushed {age} min ago"


def production_check(status: dict | None, now_s: int) -> tuple[str, bool | None, str]:
    """What the far end says of itself; None while it can't tell yet."""
    if status is None:
        return "production", False, "no status"
    news = status.get("news")
    if not isinstance(news, dict):
        return "production", None, "no news block yet"
    age = lambda ms: int((now_s * 1000 - ms) // 60_000) if isinstance(ms, (int, float)) and ms > 0 else None
    newest, pushed = age(news.get("newestTs")), age(news.get("lastPushAt"))
    problems = ["headlines are old"] * (newest is None or newest > PRODUCTION_NEWEST) + ["no push"] * (pushed is None or pushed > PUSH_MINUTES) + ["nothing held"] * (not news.get("pushedHeld"))
    if not problems:
        return "production", True, f"newest {newest} min old"
    started = age((status.get("evidenceScope") or {}).get("observingSinceMs"))
    if pushed is None and started is not None and started < RESTART_GRACE:
        return "production", None, "restarted, waiting for the first push"
    return "production", False, "; ".join(problems)


def deltas(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(name, change): new, still or recovered, for previous(name) that were told of and current(name, ok)."""
    failing = current.filter(~F.coalesce("ok", F.lit(True))).select("name", F.lit(True).alias("now"))
    j = previous.select("name", F.lit(True).alias("before")).join(failing, "name", "full_outer")
    change = F.when(F.col("before").isNull(), F.lit("new")).when(F.col("now").isNull(), F.lit("recovered")).otherwise(F.lit("still"))
    return j.select("name", change.alias("change"))


def changes(told: list[str], told_at: float | None, failing: list[str], now_s: float) -> dict | None:
    """What to tell when these checks fail and those were told of last: new, still, recovered, and whether the day's digest is due; None if nothing."""
    before, now = set(told), sorted(set(failing))
    due = told_at is None or now_s - told_at >= DIGEST_HOURS * 3600
    found = {"new": [n for n in now if n not in before], "still": [n for n in now if n in before], "recovered": sorted(before - set(now)), "due": due}
    return found if found["new"] or found["recovered"] or due else None


def decide(state: dict, checks: list[tuple[str, bool | None, str]], now_s: int) -> tuple[str | None, dict]:
    """A message if something failed, recovered or a day has gone by, and the state to keep if it is sent."""
    failing = sorted(n for n, ok, _ in checks if ok is False)
    kept = state | {"checked_at": now_s, "checks": {n: ok for n, ok, _ in checks}}
    found = changes(state.get("told", []), state.get("told_at"), failing, now_s)
    if found is None:
        return None, kept
    detail = {n: d for n, _, d in checks}
    lines = [f"{len(failing)} checks failing" if failing else "all checks pass"]
    lines += [f"new: {detail[n]}" for n in found["new"]] + [f"still: {detail[n]}" for n in found["still"]] + [f"recovered: {n}" for n in found["recovered"]]
    return "\n".join(lines), kept | {"told_at": now_s, "told": failing}


def fold_digests(snapshots: DataFrame, key: str) -> DataFrame:
    """(key, at, new, still, recovered, due, sent): the messages that a monitor makes of snapshots(key, at, failing array, sent), in order of `at`.

    A message is made if a check fails that wasn't told of, if one that was told of is well again, or if the last one is a day old. What counts
    as told moves only with a message that was sent: `sent` says whether one could be sent then, so after a failure the next
    snapshot tries again. A null array is no failing check, a null `sent` is false. Each key's snapshots go by in one task, one at a time, with two numbers and a
    list of names as all that is kept; snapshots of one moment go by their failing checks.
    """
    kind = snapshots.schema[key].dataType.simpleString()

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, told, told_at = object(), [], None
        for df in batches:
            out = []
            for k, at, failing, sent in zip(df["key"], df["at"], df["failing"], df["sent"], strict=True):
                if k != now:
                    now, told, told_at = k, [], None
                failing = [] if failing is None else list(failing)
                found = changes(told, told_at, failing, at.timestamp())
                if found:
                    out.append((k, at, found["new"], found["still"], found["recovered"], found["due"], sent))
                    if sent:
                        told, told_at = sorted(set(failing)), at.timestamp()
            yield pd.DataFrame(out, columns=["key", "at", "new", "still", "recovered", "due", "sent"])

    rows = snapshots.filter(F.col(key).isNotNull() & F.col("at").isNotNull()).select(F.col(key).alias("key"), "at", F.array_sort("failing").alias("failing"), F.coalesce("sent", F.lit(False)).alias("sent"))
    told = rows.repartition("key").sortWithinPartitions("key", "at", "failing").mapInPandas(fold, f"key {kind}, at timestamp, new array<string>, still array<string>, recovered array<string>, due boolean, sent boolean")
    return told.withColumnRenamed("key", key)


def fold_alerts(snapshots: DataFrame) -> DataFrame:
    """(at, name, change) over snapshots(at, name, ok) in order: what each one would tell, for each check by itself.

    A check is new if it fails and did not before, recovered if it passed after failing; one that can't tell changes nothing.
    """
    w = Window.partitionBy("name").orderBy("at")
    known = snapshots.filter("ok IS NOT NULL").withColumn("before", F.lag("ok").over(w))
    change = F.when(~F.col("ok") & F.coalesce("before", F.lit(True)), F.lit("new")).when(F.col("ok") & ~F.coalesce("before", F.lit(True)), F.lit("recovered")).when(~F.col("ok"), F.lit("still"))
    return known.select("at", "name", change.alias("change")).filter("change IS NOT NULL")


def failure_runs(runs: DataFrame, key: str, at: str, failed: Column) -> DataFrame:
    """runs with in_a_row: failures up to each run since the last success."""
    w = Window.partitionBy(key).orderBy(at)
    marked = runs.withColumn("_f", failed.cast("int")).withColumn("_island", F.sum(1 - F.col("_f")).over(w))
    return marked.withColumn("in_a_row", F.sum("_f").over(Window.partitionBy(key, "_island").orderBy(at))).drop("_f", "_island")


def status(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Counts of a status report: by status, by outlet beside its health, by day and outcome, by flag, and the last five runs."""
    stories = tables["stories"]
    by_outlet = stories.groupBy("outlet").agg(F.count(F.lit(1)).alias("stories"))
    return {
        "by_status": stories.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy("status"),
        "by_outlet": tables["outlet_health"].join(by_outlet, "outlet", "left").withColumn("stories", F.coalesce("stories", F.lit(0))).orderBy("outlet"),
        "by_day": outcomes_by_day(tables["verifications"]),
        "by_flag": stories.select(F.explode("format_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "flag"),
        "runs": tables["scrape_runs"].orderBy(F.desc("started_at"), "run_id").limit(5),
        "data_as_of": tables["scrape_runs"].filter("finished_at IS NOT NULL").agg(F.max("finished_at").alias("data_as_of")),
    }


def outcomes_by_day(verifications: DataFrame, since: Column | None = None) -> DataFrame:
    """(day, outcomes): how many verdicts of each kind were last written on a day, from the day of `since` on."""
    if since is not None:
        verifications = verifications.filter(F.col("updated_at") >= F.date_trunc("day", since))  # as a bound that the scan can use
    n = verifications.groupBy(F.to_date("updated_at").alias("day"), "outcome").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("day").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("outcome", "n")))).alias("outcomes")).orderBy("day")


def spend_of_day(calls: DataFrame, day: Column) -> DataFrame:
    """(spent): what the calls of a day cost; only that day is read."""
    start = F.date_trunc("day", day)
    own = calls.filter((F.col("created_at") >= start) & (F.col("created_at") < start + F.expr("INTERVAL 1 DAY")))
    return own.agg(F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("spent"))


def counters(rows: DataFrame, keys: list[str], failed: Column, cost: str) -> DataFrame:
    """keys, done, failed and cost: the totals of a run by outlet, stage or outcome."""
    return rows.groupBy(*keys).agg(F.count_if(~failed).alias("done"), F.count_if(failed).alias("failed"), F.coalesce(F.sum(cost), F.lit(0.0)).alias("cost"))


def served_models(calls: DataFrame, asked: str) -> DataFrame:
    """Models that answered but were not asked."""
    return calls.select("model").distinct().filter(F.col("model") != asked)
