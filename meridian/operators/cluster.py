"""Events out of stories: which pairs are worth judging, who joins whom, and what may be drawn."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions import geo, hashing, times
from meridian.functions import text as T
from meridian.operators.tables import written as stored

WINDOW_HOURS = 48
RADIUS_KM = 50.0
OVERLAP = 0.34
#: Degrees of a grid cell, a power of two that divides the circle; a circle of RADIUS_KM reaches into two to three cells of a row or column.
CELL = 1.0
#: What brings a story and a founder together, in the order in which a pair with several of them is given once.
REASONS = ("place", "entity", "words")


def facts(stories: DataFrame) -> DataFrame:
    """stories with what comparisons need: keys of entities, tokens of the headline, is_live."""
    return stories.withColumns({
        "keys": T.entity_keys("entities"),
        "tokens": T.headline_tokens("headline"),
        "is_live": F.array_contains(F.coalesce("format_flags", F.array().cast("array<string>")), "live"),
    })


def _days(published: str, before: int = 0, after: int = 0) -> Column:
    """Windows of time of a story, and so many before and after it."""
    day = F.floor(F.unix_timestamp(published) / (WINDOW_HOURS * 3600))
    return F.explode(F.sequence(day - before, day + after)) if before or after else day


def _cells(lat: str, lon: str, around: bool) -> Column:
    """Grid cells of a point; around: those that a circle of RADIUS_KM reaches into, more of them in a row nearer the poles."""
    n = int(360 / CELL)
    row, column = (lambda y: F.floor(y / CELL)), (lambda x: F.floor(x / CELL))
    cell = lambda r, c: r * n + F.pmod(c, F.lit(n))
    if not around:
        return cell(row(F.col(lat)), column(F.col(lon)))
    arc = RADIUS_KM / 111.0  # a degree of latitude has a little more than 111 km
    top = F.abs(F.col(lat)) + arc
    wide = F.when(top >= 89.0, F.lit(180.0)).otherwise(F.lit(arc) / F.cos(F.radians(top)))
    columns = F.sequence(column(F.col(lon) - wide), column(F.col(lon) + wide))
    cells = F.transform(F.sequence(row(F.col(lat) - arc), row(F.col(lat) + arc)), lambda r: F.transform(columns, lambda c: cell(r, c)))
    return F.explode(F.array_distinct(F.flatten(cells)))


def rare_tokens(stories: DataFrame, every: DataFrame) -> DataFrame:
    """(story_id, rare): the tokens of a headline that two which overlap by OVERLAP must share one of.

    Of n tokens, in one order for all from rare to frequent, these are the first n - ceil(OVERLAP * n) + 1 (prefix
    filtering). So words that half of the headlines have are hardly ever joined on.
    """
    each = lambda df: df.select("story_id", F.explode("tokens").alias("w"))
    freq = each(every).groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    sets = each(stories).join(freq.hint("merge"), "w").groupBy("story_id").agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("t"))
    first = F.size("t") - T.at_least("t", OVERLAP) + 1
    return sets.select("story_id", F.transform(F.slice("t", F.lit(1), first), lambda x: x["w"]).alias("rare"))


def _bits(tokens: str) -> Column:
    """A set of tokens as 64 bits, one that each token's hash picks."""
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(w), F.lit(64)).cast("int"))
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda acc, w: acc.bitwiseOR(bit(w)))


def _met(stories: DataFrame, founders: DataFrame, reasons: tuple[str, ...] = REASONS, earlier: bool = False) -> DataFrame:
    """candidate_pairs() with s_published and f_published.

    Rows carry what is compared into each join, so a pair is judged where it meets and only what passes goes on; of several
    reasons that a pair meets by, the first one in the order of REASONS gives it, also if not all are asked for. Joins sort and merge:
    tables of stories grow with the input, and compressed they look small enough to be broadcast long after they are. They
    sort by a number, as most of the work would be to compare texts. What is cheap to tell of a pair is asked first.
    """
    ok = (~F.col("is_live")) & (F.coalesce("country", F.lit("")) != "") & F.col("published").isNotNull()
    left = facts(stories).filter(ok)
    right = facts(founders).filter(ok)
    every = left.unionByName(right, allowMissingColumns=True)
    cols = ["published", "latitude", "longitude", "keys", "tokens", *(["rare", "n_tokens", "bits"] if "words" in reasons else [])]

    def side(df: DataFrame, name: str, prefix: str) -> DataFrame:
        rows = df.join(rare_tokens(df, every).hint("merge"), "story_id", "left").withColumns({"n_tokens": F.size("tokens"), "bits": _bits("tokens")}) if "words" in reasons else df
        return rows.select(F.col("story_id").alias(name), "country", *(F.col(c).alias(f"{prefix}_{c}") for c in cols))

    left, right = side(left, "story_id", "s"), side(right, "founder_id", "f")
    km = geo.distance_km("s_latitude", "s_longitude", "f_latitude", "f_longitude")
    near = F.coalesce((F.abs(F.col("s_latitude") - F.col("f_latitude")) <= RADIUS_KM / 111.0) & (km <= RADIUS_KM), F.lit(False))
    shared = F.get(F.array_sort(F.array_intersect("s_keys", "f_keys")), F.lit(0))
    overlap = T.jaccard("s_tokens", "f_tokens")
    none = F.lit(None).cast("string")
    at, founded = F.unix_micros("s_published"), F.unix_micros("f_published")
    in_time = times.within_hours("s_published", "f_published", WINDOW_HOURS)
    if earlier:
        in_time = ((founded < at) | ((founded == at) & (F.col("founder_id") < F.col("story_id")))) & in_time

    def branch(value: Callable[[str, bool], Column], reason: Column, shared: Column) -> DataFrame:
        # one side is put into the neighbouring windows of time and cells, the other into its own; no story has a value twice
        key = F.xxhash64("country", "d", "v").alias("h")
        a = left.withColumn("v", value("s", True)).withColumn("d", _days("s_published", 1, 0 if earlier else 1)).select("*", key)
        b = right.withColumn("v", value("f", False)).withColumn("d", _days("f_published")).select("*", key)
        met = a.join(b.hint("merge"), ["h", "country", "d", "v"]).filter("story_id <> founder_id").filter(in_time).filter(reason)
        return met.select("story_id", "founder_id", km.alias("km"), shared.alias("shared"), overlap.alias("overlap"), "s_published", "f_published")

    alone = F.least(F.size("s_keys"), F.size("f_keys")) <= 1  # then what they met by is all that they share
    first = F.get(F.array_intersect("s_rare", "f_rare"), F.lit(0))
    # each bit that only one of two headlines has is a word that only this one has: most pairs that share one word go by that
    only = lambda x, y: F.bit_count(F.col(f"{x}_bits").bitwiseAND(F.bitwise_not(f"{y}_bits")))
    most = F.least(F.col("s_n_tokens") - only("s", "f"), F.col("f_n_tokens") - only("f", "s"))
    may = most >= (F.col("s_n_tokens") + F.col("f_n_tokens")) * (OVERLAP / (1 + OVERLAP)) - 1e-9
    branches = {
        "place": lambda: branch(lambda side, around: _cells(f"{side}_latitude", f"{side}_longitude", around), near, shared),
        "entity": lambda: branch(lambda side, _: F.explode(f"{side}_keys"), (alone | (F.col("v") == shared)) & ~near, F.col("v")),
        "words": lambda: branch(lambda side, _: F.explode(f"{side}_rare"), may & (overlap >= OVERLAP) & (F.col("v") == first) & ~near & ~F.arrays_overlap("s_keys", "f_keys"), none),
    }
    return reduce(DataFrame.unionByName, [branches[x]() for x in REASONS if x in reasons])


def candidate_pairs(stories: DataFrame, founders: DataFrame, reasons: tuple[str, ...] = REASONS, earlier: bool = False) -> DataFrame:
    """(story_id, founder_id, km, shared, overlap) of pairs that may be one event.

    Same country, at most WINDOW_HOURS apart, neither a live page, and near in place, with an entity in common, or alike in
    their headlines. Each of the three reasons is an equi-join on country, a window of time and a cell, an entity or a
    token, so no pair is looked at that has no reason; two headlines that overlap share a token.

    Who knows that his judge wants more than some of the reasons alone leaves them out of reasons, and those pairs are not made.
    earlier: only founders before the story, in order of (published, id).
    """
    return _met(stories, founders, reasons, earlier).select("story_id", "founder_id", "km", "shared", "overlap")


#: So few open pairs are settled in one task, which takes them in order; more go in rounds.
SETTLED_AT_ONCE = 200_000


def place(stories: DataFrame, pairs: DataFrame | Callable[[DataFrame], DataFrame], at_once: int = SETTLED_AT_ONCE) -> DataFrame:
    """(story_id, cluster_id, verdict, compared_to): each story in one cluster, in order of (published, story_id).

    pairs(story_id, founder_id, same) holds the candidate pairs with what the judge said of each, asked once a pair. A story joins
    the first founder, in order of (founder's time, id), of which `same` holds; else it founds a cluster. It is compared to founders only, so
    events never chain. A story with a founder among its earlier same ones joins, whichever founder is the first; one whose
    earlier same ones all joined others founds.

    Stories are numbered in their order and pairs are pairs of numbers, as they are far more than stories. A function
    for pairs gets the stories with their numbers as story_id, and so gives the numbers itself; else they are looked up.

    Rounds settle what is next to those settled in the round before: pairs with one that joined are dropped, those with a
    founder decide. Only open pairs and the newly settled are stored, both of which shrink, and no country or event
    meets in one task; the last pairs, at_once at most, are settled by one task in order, which gives the same. They are stored
    as tables, whose size Spark knows: a checkpoint has the size that was guessed for its plan, which the joins of each round would
    square, until the driver plans with numbers of millions of digits.
    """
    order = [F.coalesce(F.unix_micros("published"), F.lit(-(1 << 62))), F.col("story_id")]
    numbered = stored(stories.orderBy(*order).withColumn("n", F.monotonically_increasing_id()))
    if callable(pairs):
        same = pairs(numbered.withColumn("story_id", F.col("n")).drop("n")).filter("same").select(F.col("story_id").alias("n"), F.col("founder_id").alias("f"))
    else:
        ids = numbered.select("story_id", "n")
        same = pairs.filter("same").join(ids.hint("merge"), "story_id").join(ids.select(F.col("story_id").alias("founder_id"), F.col("n").alias("f")).hint("merge"), "founder_id").select("n", "f")
    earlier = stored(same.filter("f < n"))

    def told(open_pairs: DataFrame, settled: DataFrame) -> DataFrame:
        return open_pairs.join(settled.withColumnRenamed("n", "f").hint("merge"), "f", "left")

    fresh = stored(earlier.select("f").distinct().join(earlier.select(F.col("n").alias("f")).hint("merge"), "f", "left_anti").select(F.col("f").alias("n"), F.lit(True).alias("founds")))
    settled, left, n = [fresh], earlier, earlier.count()
    while n > at_once:
        joins = F.coalesce(F.bool_or("founds"), F.lit(False))
        seen = told(left, fresh).groupBy("n").agg(joins.alias("joins"), F.collect_list(F.when(F.col("founds").isNull(), F.col("f"))).alias("open"))
        seen = stored(seen.select("n", "joins", F.when(~F.col("joins"), F.col("open")).alias("open")))
        fresh = seen.filter("joins OR size(open) = 0").select("n", (~F.col("joins")).alias("founds"))
        settled.append(fresh)
        left = seen.filter("NOT joins").select("n", F.explode("open").alias("f"))
        n = seen.filter("NOT joins").agg(F.coalesce(F.sum(F.size("open")), F.lit(0))).first()[0]
    if n:
        settled.append(stored(told(left, fresh).select("n", "f", "founds").repartition(1).sortWithinPartitions("n").mapInPandas(_in_order, "n long, founds boolean")))
    joined = reduce(DataFrame.unionByName, settled).filter("NOT founds").select("n")
    founders = earlier.join(joined.withColumnRenamed("n", "f").hint("merge"), "f", "left_anti")
    chosen = founders.join(joined.hint("merge"), "n", "left_semi").groupBy("n").agg(F.min("f").alias("joined"))
    own = hashing.cluster_id("outlet", "primary_alias")
    named = numbered.select(F.col("n").alias("joined"), F.col("story_id").alias("compared_to"), own.alias("joined_cluster"))
    all_rows = numbered.join(chosen.hint("merge"), "n", "left").join(named.hint("merge"), "joined", "left")
    return all_rows.select(
        "story_id",
        F.coalesce("joined_cluster", own).alias("cluster_id"),
        F.when(F.col("joined").isNull(), F.lit("founder")).otherwise(F.lit("same")).alias("verdict"),
        "compared_to",
    )


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(n, founds) for pairs(n, f, founds) in order of the stories, founds being what is known of the founder."""
    rows = pd.concat(list(batches))
    out: dict[int, bool] = {}
    for n, f, founds in zip(rows["n"], rows["f"], rows["founds"], strict=True):
        known = founds if founds is not None and founds == founds else out.get(f, True)
        out[n] = out.get(n, True) and not known
    yield pd.DataFrame({"n": list(out.keys()), "founds": list(out.values())})


def pin_decisions(clusters: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster_id, is_pin, not_pin_reason): a ladder of vetoes; the founder is what a pin is about.

    clusters: cluster_id, founder_story, is_live, is_physical_event, category, pinnable, latitude, longitude.
    members: cluster_id, story_id, latitude, longitude.
    """
    spots = clusters.select("cluster_id", F.col("founder_story"), F.col("latitude").alias("f_lat"), F.col("longitude").alias("f_lon"))
    others = members.join(spots, "cluster_id").filter("story_id <> founder_story AND latitude IS NOT NULL AND longitude IS NOT NULL")
    far = others.groupBy("cluster_id").agg(F.bool_or(geo.distance_km("latitude", "longitude", "f_lat", "f_lon") > RADIUS_KM).alias("far"))
    false_if_null = lambda c: F.coalesce(c, F.lit(False))
    placed = false_if_null(F.col("pinnable")) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    reason = (
        F.when(false_if_null(F.col("is_live")), F.lit("live_blog"))
        .when(~false_if_null(F.col("is_physical_event")), F.lit("founder_not_an_event"))
        .when(~geo.can_pin("category"), F.lit("founder_category_never_pins"))
        .when(~placed, F.lit("founder_place_not_pinnable"))
        .when(false_if_null(F.col("far")), F.lit("members_far_apart"))
    )
    return clusters.join(far, "cluster_id", "left").select("cluster_id", reason.isNull().alias("is_pin"), reason.alias("not_pin_reason"))


def pending(stories: DataFrame, extractions: DataFrame, resolutions: DataFrame, members: DataFrame, hashes: dict[str, str], n: int) -> DataFrame:
    """The oldest stories that were read but are in no cluster under these settings."""
    read = extractions.filter((F.col("config_hash") == hashes["extract"]) & F.col("accepted")).drop("config_hash")
    found = resolutions.filter(F.col("config_hash") == hashes["resolve"]).select("story_id", "latitude", "longitude", "place_precision", "pinnable")
    placed = members.filter(F.col("config_hash") == hashes["cluster"])
    dated = stories.filter(F.col("published").isNotNull())
    return dated.join(read, "story_id").join(found, "story_id", "left").join(placed, "story_id", "left_anti").orderBy("published", "story_id").limit(n)


def _read_and_found(stories: DataFrame, extractions: DataFrame, resolutions: DataFrame, hashes: dict[str, str]) -> DataFrame:
    """Stories with their reading and, if there is one, their place under these settings."""
    read = extractions.filter(F.col("config_hash") == hashes["extract"])
    found = resolutions.filter(F.col("config_hash") == hashes["resolve"]).select("story_id", "latitude", "longitude", "place_precision", "pinnable")
    new = [c for c in read.columns if c == "story_id" or c not in stories.columns]
    return stories.join(read.select(*new).drop("config_hash"), "story_id").join(found, "story_id", "left")


def open_founders(clusters: DataFrame, stories: DataFrame, extractions: DataFrame, resolutions: DataFrame, hashes: dict[str, str]) -> DataFrame:
    """Founders of open clusters, with cluster_id, founder_country and founder_published, and what is known of them as stories."""
    own = clusters.filter((F.col("config_hash") == hashes["cluster"]) & F.col("open"))
    named = own.select("cluster_id", F.col("founder_story").alias("story_id"), F.col("country").alias("founder_country"), "founder_published")
    return named.join(_read_and_found(stories, extractions, resolutions, hashes), "story_id")


def near_founders(subjects: DataFrame, founders: DataFrame, hours: int = WINDOW_HOURS) -> DataFrame:
    """(story_id, cluster_id) of subjects(story_id, country, published) and founders of the same country, or both of none, so close in time.

    Time is cut into cells of an eighth of that length; a subject is in its own, a founder in those that it reaches. Rows
    are dealt by country and cell into as many partitions as the session has for shuffles: pairs are far more than rows.
    """
    cell = lambda seconds: F.floor(seconds / (hours * 450))
    held = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")).alias("c")
    at, reach = F.unix_timestamp("founder_published"), hours * 3600
    a = subjects.select("story_id", held("country"), "published", cell(F.unix_timestamp("published")).alias("w"))
    b = founders.select("cluster_id", held("founder_country"), "founder_published", F.explode(F.sequence(cell(at - reach), cell(at + reach))).alias("w"))
    width = int(subjects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = a.filter("w IS NOT NULL").repartition(width, "c", "w").join(b.repartition(width, "c", "w"), ["c", "w"])
    return met.filter(times.within_hours("published", "founder_published", hours)).select("story_id", "cluster_id")


def members_of(members: DataFrame, stories: DataFrame, extractions: DataFrame, resolutions: DataFrame, hashes: dict[str, str]) -> DataFrame:
    """cluster_id and what is known of each member as a story."""
    own = members.filter(F.col("config_hash") == hashes["cluster"]).select("story_id", "cluster_id")
    return own.join(_read_and_found(stories, extractions, resolutions, hashes), "story_id")


def decide_again(clusters: DataFrame, members: DataFrame, stories: DataFrame, extractions: DataFrame, resolutions: DataFrame, hashes: dict[str, str]) -> DataFrame:
    """clusters with is_pin and not_pin_reason as their members now have it: one that lands far away takes a pin away."""
    own = clusters.filter(F.col("config_hash") == hashes["cluster"])
    known = _read_and_found(stories, extractions, resolutions, hashes).withColumnRenamed("story_id", "founder_story")
    known = known.withColumn("is_live", F.array_contains(F.coalesce("format_flags", F.array().cast("array<string>")), "live"))
    facts_of = ["is_live", "is_physical_event", "category", "pinnable", "latitude", "longitude"]
    founders = own.select("cluster_id", "founder_story").join(known.select("founder_story", *facts_of), "founder_story")
    told = pin_decisions(founders, members_of(members, stories, extractions, resolutions, hashes))
    new = told.select("cluster_id", F.lit(hashes["cluster"]).alias("config_hash"), F.col("is_pin").alias("_pin"), F.col("not_pin_reason").alias("_reason"))
    j = clusters.join(new, ["cluster_id", "config_hash"], "left")
    decided = F.col("_pin").isNotNull()
    fresh = {"is_pin": F.when(decided, F.col("_pin")).otherwise(F.col("is_pin")), "not_pin_reason": F.when(decided, F.col("_reason")).otherwise(F.col("not_pin_reason"))}
    return j.select(*(fresh[c].alias(c) if c in fresh else c for c in clusters.columns))


def unresolved(extractions: DataFrame, resolutions: DataFrame, hashes: dict[str, str]) -> int:
    """Number of happenings with a place that were not looked up yet; clustering waits for them."""
    happened = extractions.filter((F.col("config_hash") == hashes["extract"]) & F.col("accepted") & F.col("is_physical_event") & F.col("place_name").isNotNull())
    return happened.join(resolutions.filter(F.col("config_hash") == hashes["resolve"]), "story_id", "left_anti").count()


def pair_bound(stories: DataFrame) -> int:
    """How many pairs a judge could be asked about at most: each earlier candidate counts as a founder."""
    return _met(stories, stories, earlier=True).count()
