"""Listings that come in pages: all sections are read side by side, a page of each in every round, until each has nothing new."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.identity import known_rows
from meridian.operators.tables import stored, written


def read_listings(sections: DataFrame, list_page: Callable[[DataFrame], DataFrame], known: DataFrame, seen_in: DataFrame, most_pages: int = 0) -> tuple[DataFrame, DataFrame]:
    """The rows of sections(outlet, section) that were read, and (outlet, section, pages): how many pages of each had something new.

    list_page is given the pages that are wanted, (outlet, section, page) with pages from 0, and gives their rows: these columns, position,
    aliases and what else a row has. It may fetch them (mapInPandas over the sections) or join what was recorded. A row
    whose first alias its section had before is left out. A section ends after the first page with nothing new, which isn't counted, after
    one whose rows are all stored for it already (known(outlet, alias, story_id, first_seen_at), seen_in(story_id, section)), or after most_pages if that isn't 0. So a run
    takes a round for each page of the longest section and reads no page past an end; what a round keeps is its
    rows, and keys of those before for the sections still open. A row without an alias counts as new each time.
    """
    spark = sections.sparkSession
    open_, page = stored(sections.select("outlet", "section").distinct()), 0
    keys, read, counted = None, [], []
    while (not most_pages or page < most_pages) and not open_.isEmpty():
        rows = list_page(open_.withColumn("page", F.lit(page))).withColumn("_key", F.get("aliases", F.lit(0)))
        once = F.row_number().over(Window.partitionBy("outlet", "section", F.coalesce("_key", F.concat(F.lit("row "), F.col("position").cast("string")))).orderBy("position"))
        rows = rows.withColumn("_once", once).filter("_once = 1").drop("_once")
        if keys is not None:
            rows = rows.join(keys, ["outlet", "section", "_key"], "left_anti")
        rows = written(rows.withColumn("row_id", F.monotonically_increasing_id()))  # of known size: few rows don't make known move
        had = known_rows(rows.select("row_id", "outlet", "aliases", "section", "page"), known, seen_in).select("row_id", F.lit(True).alias("_had"))
        ends = stored(rows.select("row_id", "outlet", "section").join(had, "row_id", "left").groupBy("outlet", "section").agg(F.bool_and(F.coalesce("_had", F.lit(False))).alias("ends")))
        read.append(rows.drop("row_id", "_key"))
        counted.append(ends.select("outlet", "section"))
        open_ = ends.filter("NOT ends").select("outlet", "section")
        fresh = rows.select("outlet", "section", "_key")
        keys = stored((fresh if keys is None else keys.unionByName(fresh)).join(open_, ["outlet", "section"], "left_semi"))
        page += 1
    if not read:
        return list_page(sections.select("outlet", "section").withColumn("page", F.lit(0))).limit(0), spark.createDataFrame([], "outlet string, section string, pages long")
    pages = reduce(DataFrame.unionByName, counted).groupBy("outlet", "section").agg(F.count(F.lit(1)).alias("pages"))
    return reduce(DataFrame.unionByName, read), pages
