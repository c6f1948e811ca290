"""JSON columns that may be broken."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meridian.functions.text import col


def string_list(c) -> Column:
    """An array of strings, or of an object's keys, without blanks; anything else is an empty list."""
    c = F.trim(col(c))
    values = F.when(c.startswith("["), F.from_json(c, "array<string>")).when(c.startswith("{"), F.json_object_keys(F.when(F.try_parse_json(c).isNotNull(), c)))
    return F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda x: x.isNotNull() & (F.trim(x) != ""))


def first_of(variant, *paths: str) -> Column:
    """The first path of a variant that holds text or a number; empty text, objects and arrays count as missing."""

    def value(path: str) -> Column:
        at = F.try_variant_get(col(variant), path, "variant")
        return F.when(~F.schema_of_variant(at).rlike("^(OBJECT|ARRAY)"), F.nullif(F.trim(F.try_variant_get(at, "$", "string")), F.lit("")))

    return F.coalesce(*(value(p) for p in paths))


def opened(nodes, whole, inner, most: Column) -> Column:
    """An array of variants in which each node that isn't `whole` gives way to its `inner` array, in order, until all are.

    `most` is a number of rounds that surely suffices, which the row itself tells; rounds with nothing to open change nothing.
    """
    step = lambda found, _: F.when(
        F.exists(found, lambda b: ~whole(b)), F.flatten(F.transform(found, lambda b: F.when(whole(b), F.array(b)).otherwise(inner(b))))
    ).otherwise(found)
    return F.aggregate(F.array_repeat(F.lit(0), most), nodes, step)


def keys_in(value, *keys: str) -> Column:
    """How often a variant has one of the keys, at any depth."""
    return F.coalesce(F.regexp_count(F.to_json(value), F.lit('"(' + "|".join(keys) + ')":')), F.lit(0))


def text_of(value, keys=("basic", "text", "value")) -> Column:
    """The first text that isn't blank in a variant: itself, or what an object says under the keys, in their order, at any depth."""
    string = lambda v: F.when(F.schema_of_variant(v) == "STRING", F.nullif(F.trim(F.try_variant_get(v, "$", "string")), F.lit("")))
    inner = lambda v: F.filter(F.array(*(F.try_variant_get(v, f"$.{k}", "variant") for k in keys)), lambda x: x.isNotNull())

    def step(todo, _):
        first = F.get(todo, F.lit(0))
        return F.when((F.size(todo) == 0) | string(first).isNotNull(), todo).otherwise(F.concat(inner(first), F.slice(todo, F.lit(2), F.size(todo))))

    value = col(value)
    deep = F.aggregate(F.array_repeat(F.lit(0), keys_in(value, *keys) + 1), F.array(value), step)
    return F.when(F.schema_of_variant(value) == "STRING", string(value)).when(value.isNotNull(), string(F.get(deep, F.lit(0))))


def verdict(c, allowed=("same", "different", "unsure")) -> Column:
    """The verdict of a model's answer; what is not one of the allowed words is the last of them."""
    said = F.lower(F.trim(F.try_variant_get(F.try_parse_json(col(c)), "$.verdict", "string")))
    return F.when(said.isin(*allowed), said).otherwise(F.lit(allowed[-1]))
