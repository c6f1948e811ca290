"""Upserts as pure functions: (current table, incoming rows) -> new table. Plain Parquet has no MERGE.

Each is one aggregate or one join by key, so a merge shuffles by its key once. merge_into() applies one to a table on disk and
rewrites only the buckets that incoming rows fall into.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def present(c: str) -> Column:
    """The value, or null if it counts as empty."""
    return F.nullif(F.col(c), F.lit(""))


def first_wins(current: DataFrame, incoming: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of current, and of incoming those whose key is new; among new ones the first by order."""
    new = incoming.join(current, keys, "left_anti")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return current.unionByName(new.withColumn("_rank", rank).filter("_rank = 1").drop("_rank"), allowMissingColumns=True)


def last_wins(current: DataFrame, incoming: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Rows of incoming, the last of each key, and rows of current with no new one."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    newest = incoming.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    return current.join(newest, keys, "left_anti").unionByName(newest, allowMissingColumns=True)


def merge_seen(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by key with the first first_seen_at and the last last_seen_at."""
    both = current.unionByName(incoming)
    return both.groupBy(*keys).agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"))


def merge_texts(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Texts by story; a new one takes over only if its hash differs."""
    new = incoming.select("story_id", *(F.col(c).alias(f"new_{c}") for c in ("text", "text_hash", "word_count", "updated_at")))
    joined = current.join(new, "story_id", "full_outer")
    changed = F.col("text_hash").isNull() | (F.col("text_hash") != F.col("new_text_hash"))
    pick = lambda c: F.when(changed & F.col("new_text_hash").isNotNull(), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
    return joined.select("story_id", *(pick(c) for c in ("text", "text_hash", "word_count", "updated_at")))


SIMPLE = ["url", "source_url", "headline", "description", "published", "published_raw", "updated", "updated_raw", "thumbnail", "word_count"]


def merge_stories(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stories by story_id. incoming has one row for each, with last_seen_at as the time of this run.

    A value that is there wins over an old one, an empty one never does; categories merge key by key, flags are
    united, authors are replaced as a whole. A changed headline or text sends a story back to be read again, but a row
    that only ever came from a feed stays one.
    """
    new = incoming.select(F.col("story_id").alias("new_id"), *(F.col(c).alias(f"new_{c}") for c in incoming.columns if c != "story_id"))
    joined = current.join(new, F.col("story_id") == F.col("new_id"), "full_outer")
    is_old, is_new = F.col("story_id").isNotNull(), F.col("new_id").isNotNull()
    types = dict(current.dtypes)

    def simple(c: str) -> Column:
        empty = F.nullif(F.col(f"new_{c}"), F.lit("")) if types[c] == "string" else F.col(f"new_{c}")
        return F.coalesce(empty, F.col(c)).alias(c)

    none = lambda c, kind: F.coalesce(F.col(c), F.expr(f"CAST({kind} AS {types[c]})"))
    old_flags, new_flags = F.coalesce("format_flags", F.array().cast("array<string>")), F.coalesce("new_format_flags", F.array().cast("array<string>"))
    added = F.map_filter(F.coalesce("new_categories", F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull() & (v != ""))
    kept = F.map_filter(F.coalesce("categories", F.create_map().cast("map<string,string>")), lambda k, v: ~F.array_contains(F.map_keys(added), k))
    changed = lambda c: F.col(c).isNotNull() & (F.col(c) != "") & F.coalesce(F.nullif(F.col(f"new_{c}"), F.lit("")) != F.col(c), F.lit(False))
    status = (
        F.when(~is_old, F.col("new_status"))
        .when(is_new & (F.col("status") != "feed") & (changed("headline") | changed("text_hash")), F.lit("scraped"))
        .otherwise(F.col("status"))
    )
    special = {
        "story_id": F.coalesce("story_id", "new_id"),
        "authors": F.when(F.size("new_authors") > 0, F.col("new_authors")).otherwise(F.coalesce("authors", "new_authors")),
        "categories": F.map_concat(kept, added),
        "format_flags": F.array_sort(F.array_union(old_flags, new_flags)),
        "text_hash": F.coalesce(F.nullif(F.col("new_text_hash"), F.lit("")), F.col("text_hash")),
        "text_fetched_at": F.coalesce("new_text_fetched_at", "text_fetched_at"),
        "last_seen_at": F.coalesce("new_last_seen_at", "last_seen_at"),
        "status": status,
    }
    keep_old = lambda c: F.coalesce(F.col(c), F.col(f"new_{c}")) if f"new_{c}" in new.columns else F.col(c)
    return joined.select(*(simple(c) if c in SIMPLE else special.get(c, None if c in special else keep_old(c)).alias(c) for c in current.columns))


def store_readings(stories: DataFrame, extractions: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stories, extractions) with new readings: each replaces that of the same story and settings as a whole.

    Their stories give up their leases and are extracted now; a row of a feed stays one.
    """
    read = incoming.select("story_id").distinct().withColumn("_read", F.lit(True))
    j = stories.join(read, "story_id", "left")
    done = F.col("_read").isNotNull()
    fresh = {
        "status": F.when(done & ~F.col("status").eqNullSafe("feed"), F.lit("extracted")).otherwise(F.col("status")),
        "lease_owner": F.when(~done, F.col("lease_owner")),
        "lease_until": F.when(~done, F.col("lease_until")),
    }
    after = j.select(*(fresh[c].alias(c) if c in fresh else c for c in stories.columns))
    return after, last_wins(extractions, incoming, ["story_id", "config_hash"], [F.col("created_at").desc()])


def end_runs(runs: DataFrame, ended: DataFrame) -> DataFrame:
    """runs(run_id, started_at, finished_at, ...) with what ended(run_id, finished_at, ...) says; one that never began is no run."""
    new = ended.select("run_id", *(F.col(c).alias(f"_{c}") for c in ended.columns if c != "run_id"))
    j = runs.join(new, "run_id", "left")
    return j.select(*(F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if f"_{c}" in j.columns else c for c in runs.columns))


def accumulate_verifications(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """New verdicts replace old ones; costs add up, the first created_at stays, attempts go on only for the same input."""
    new = incoming.select(*keys, *(F.col(c).alias(f"new_{c}") for c in incoming.columns if c not in keys))
    joined = current.join(new, keys, "full_outer")
    is_new = F.col("new_updated_at").isNotNull()
    same = F.coalesce(F.col("input_hash") == F.col("new_input_hash"), F.lit(False))
    special = {
        "cost_usd": F.coalesce("cost_usd", F.lit(0.0)) + F.coalesce("new_cost_usd", F.lit(0.0)),
        "created_at": F.coalesce("created_at", "new_created_at"),
        "attempts": F.when(is_new, F.when(same, F.coalesce("attempts", F.lit(0))).otherwise(0) + F.coalesce("new_attempts", F.lit(0))).otherwise(F.col("attempts")),
    }
    take = lambda c: F.when(is_new, F.col(f"new_{c}")).otherwise(F.col(c)) if f"new_{c}" in joined.columns else F.col(c)
    return joined.select(*keys, *(special.get(c, take(c)).alias(c) for c in current.columns if c not in keys))


def finish_runs(health: DataFrame, runs: DataFrame) -> DataFrame:
    """Outlet health after runs(outlet, finished_at, ok, new_stories, error): one finished run for each outlet.

    A success sets the failures in a row to 0, a failure adds one and keeps its message.
    """
    new = runs.select(F.col("outlet").alias("run_outlet"), "finished_at", "ok", "new_stories", "error")
    j = health.join(new, F.col("outlet") == F.col("run_outlet"), "full_outer")
    ran, good = F.col("run_outlet").isNotNull(), F.coalesce("ok", F.lit(False))
    at = lambda when, c: F.when(when, F.col("finished_at")).otherwise(F.col(c)).alias(c)
    return j.select(
        F.coalesce("outlet", "run_outlet").alias("outlet"),
        at(ran, "last_run_at"),
        at(ran & good, "last_success_at"),
        at(ran & (F.coalesce("new_stories", F.lit(0)) > 0), "last_new_story_at"),
        F.when(ran & ~good, F.col("error")).otherwise(F.col("last_error")).alias("last_error"),
        at(ran & ~good, "last_error_at"),
        F.when(~ran, F.col("consecutive_failures")).when(good, 0).otherwise(F.coalesce("consecutive_failures", F.lit(0)) + 1).cast("int").alias("consecutive_failures"),
        at(ran, "updated_at"),
    )


def claimable(stories: DataFrame, status: str, now) -> DataFrame:
    """Stories of a status without a lease, or with one that ended."""
    return stories.filter((F.col("status") == status) & (F.col("lease_until").isNull() | (F.col("lease_until") < now)))


def newest_first(stories: DataFrame, n: int) -> DataFrame:
    return stories.orderBy(F.coalesce("published", "first_seen_at").desc_nulls_last(), "story_id").limit(n)


def claim(stories: DataFrame, status: str, owner: str, now, n: int, seconds: int = 3600) -> DataFrame:
    """stories with the n newest claimable ones leased to owner."""
    taken = newest_first(claimable(stories, status, now), n).select("story_id", F.lit(True).alias("taken"))
    until = now + F.make_dt_interval(secs=F.lit(seconds))
    return (
        stories.join(taken, "story_id", "left")
        .withColumn("lease_owner", F.when(F.col("taken"), F.lit(owner)).otherwise(F.col("lease_owner")))
        .withColumn("lease_until", F.when(F.col("taken"), until).otherwise(F.col("lease_until")))
        .drop("taken")
    )


def release(stories: DataFrame, ids: DataFrame, status: str | None = None) -> DataFrame:
    """stories with the leases of ids(story_id) gone, and with a new status if one is given."""
    gone = ids.select("story_id", F.lit(True).alias("gone")).distinct()
    out = stories.join(gone, "story_id", "left").withColumn("lease_owner", F.when(F.col("gone").isNull(), F.col("lease_owner")))
    out = out.withColumn("lease_until", F.when(F.col("gone").isNull(), F.col("lease_until")))
    if status:
        out = out.withColumn("status", F.when(F.col("gone"), F.lit(status)).otherwise(F.col("status")))
    return out.drop("gone")


def within_budget(calls: DataFrame, day, order: list, cost: str, budget: float, part: Column | None = None, descending: bool = False) -> DataFrame:
    """The calls that were made while what had been spent that day was below the budget; one may overshoot it.

    part, such as the minute, goes with the order, up or down: then sums run within a part only, and over the parts' sums, so
    a day with any number of calls is no single task's work.
    """
    if part is None:
        before = F.sum(cost).over(Window.partitionBy(day).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
        return calls.withColumn("spent_before", F.coalesce(before, F.lit(0.0))).filter(F.col("spent_before") < budget)
    cut = calls.withColumns({"_day": day, "_part": part})
    parts = cut.groupBy("_day", "_part").agg(F.sum(cost).alias("_own"))
    ordered = Window.partitionBy("_day").orderBy(F.col("_part").desc() if descending else F.col("_part").asc()).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_day", "_part", F.coalesce(F.sum("_own").over(ordered), F.lit(0.0)).alias("_start"))
    within = F.sum(cost).over(Window.partitionBy("_day", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    # a part that begins over the budget has no call within it, so most rows go before they are sorted
    due = cut.join(starts.filter(F.col("_start") < budget), ["_day", "_part"])
    out = due.withColumn("spent_before", F.col("_start") + F.coalesce(within, F.lit(0.0))).filter(F.col("spent_before") < budget)
    return out.drop("_day", "_part", "_start")


#: Tables that lose rows with a story, by their column that names it.
CHILDREN = {
    "story_aliases": "story_id",
    "story_sections": "story_id",
    "story_texts": "story_id",
    "extractions": "story_id",
    "resolutions": "story_id",
    "clusters": "founder_story",
    "cluster_members": "story_id",
    "verifications": "story_id",
}


def checked_drop(outlets: list[str], allowed: list[str]) -> list[str]:
    if wrong := sorted(set(outlets) - set(allowed)):
        raise ValueError(f"not on the list of dropped outlets: {', '.join(wrong)}")
    return outlets


def orphans(clusters: DataFrame, members: DataFrame, stories: DataFrame, outlets: list[str]) -> DataFrame:
    """(cluster_id, story_id) of members that stay while their cluster's founder goes."""
    outlet_of = stories.select("story_id", "outlet")
    founders = clusters.select("cluster_id", F.col("founder_story").alias("story_id")).join(outlet_of.filter(F.col("outlet").isin(outlets)), "story_id").select("cluster_id")
    return members.join(founders, "cluster_id", "left_semi").join(outlet_of.filter(~F.col("outlet").isin(outlets)), "story_id", "left_semi").select("cluster_id", "story_id")


def drop_outlets(tables: dict[str, DataFrame], outlets: list[str], allowed: list[str]) -> dict[str, DataFrame]:
    """All tables without the outlets' stories and what hangs on them; calls stay on the ledger."""
    checked_drop(outlets, allowed)
    gone = tables["stories"].filter(F.col("outlet").isin(outlets)).select("story_id")
    out = dict(tables)
    lost = orphans(tables["clusters"], tables["cluster_members"], tables["stories"], outlets)
    out["cluster_members"] = tables["cluster_members"].join(lost, ["cluster_id", "story_id"], "left_anti")
    for name, column in CHILDREN.items():
        out[name] = out[name].join(gone.select(F.col("story_id").alias(column)), column, "left_anti").select(*tables[name].columns)
    out["stories"] = tables["stories"].join(gone, "story_id", "left_anti").select(*tables["stories"].columns)
    out["outlet_health"] = tables["outlet_health"].filter(~F.col("outlet").isin(outlets))
    return out


def drop_plan(tables: dict[str, DataFrame], outlets: list[str], allowed: list[str]) -> DataFrame:
    """(table, rows) that dropping the outlets would remove."""
    after = drop_outlets(tables, outlets, allowed)
    count = lambda df, name, sign: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), (F.col("n") * sign).alias("n"))
    parts = [p for name in after for p in (count(tables[name], name, 1), count(after[name], name, -1))]
    return reduce(DataFrame.unionByName, parts).groupBy("table").agg(F.sum("n").alias("rows"))


BUCKET = "key_bucket"


def _bucketed(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"))


def _write_buckets(rows: DataFrame, root: str) -> None:
    """A file for each bucket; buckets without a row here stay as they are."""
    rows.repartition(BUCKET).write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def lay_out(rows: DataFrame, root: str, keys: list[str], n: int) -> None:
    """Writes a table in n buckets by a hash of the keys, each a partition folder."""
    _write_buckets(_bucketed(rows, keys, n), root)


def read_buckets(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The table without its bucket."""
    return spark.read.schema(f"{schema}, {BUCKET} int").parquet(root).drop(BUCKET)


def merge_into(incoming: DataFrame, root: str, schema: str, keys: list[str], n: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Replaces the table at root by merge(current, incoming), and gives the buckets that were touched: at most n numbers.

    Only the buckets of incoming rows are read, merged and written; all other files stay, names included. merge has to
    look at rows of equal keys only, as the functions above do when `keys` are among theirs, and may not leave a touched bucket without
    a row. New files replace the old ones when all of them are written, so a run that fails before that leaves the table.
    """
    spark = incoming.sparkSession
    new = _bucketed(incoming, keys, n)
    touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())
    if touched:
        held = spark.read.schema(f"{schema}, {BUCKET} int").parquet(root).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        _write_buckets(_bucketed(merge(held, new.drop(BUCKET)).select(*held.columns), keys, n), root)
    return touched


def write_version(df: DataFrame, root: str, version: int) -> None:
    """A new version of a table beside the old ones; readers switch once it is whole."""
    df.write.parquet(f"{root}/version={version}")


def read_version(spark: SparkSession, root: str, schema: str, version: int) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/version={version}")
