"""Distances, and how well a feature fits what was asked for."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column
from pyspark.sql import functions as F

from meridian import schemas
from meridian.functions.text import col

EARTH_KM = 6371.0088


def distance_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance by the haversine formula."""
    a, b = F.radians(col(lat1)), F.radians(col(lat2))
    half = lambda x: F.pow(F.sin(x / 2), F.lit(2.0))
    h = half(b - a) + F.cos(a) * F.cos(b) * half(F.radians(col(lon2)) - F.radians(col(lon1)))
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def mapped(c, table: dict) -> Column:
    """The entry of a small constant table, null if there is none."""
    return F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), col(c))


def precision(feature_class, feature_code) -> Column:
    return F.when(col(feature_class) == "S", F.lit("point")).otherwise(mapped(feature_code, schemas.PRECISION_BY_CODE))


def pinnable(precision_column) -> Column:
    return F.coalesce(col(precision_column).isin(schemas.PINNABLE_PRECISIONS), F.lit(False))


def fit(kind, precision_column) -> Column:
    """0 for what was asked for, less the further from it; -99 for a feature without precision; 0 if no known kind was asked for."""
    wanted = mapped(mapped(F.lower(F.trim(F.coalesce(col(kind), F.lit("")))), schemas.KIND_PRECISION), schemas.PRECISION_ORDER)
    found = mapped(precision_column, schemas.PRECISION_ORDER)
    return F.when(found.isNull(), F.lit(-99)).when(wanted.isNull(), F.lit(0)).otherwise(-F.abs(found - wanted))


def decimals(c) -> Column:
    """Digits after the point of a number as text, also with an exponent."""
    text = F.lower(col(c).cast("string"))
    after = F.length(F.regexp_extract(text, r"\.(\d+)", 1)) - F.when(text.rlike(r"\.0(e|$)"), 1).otherwise(0)
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, r"e(-?\d+)$", 1), F.lit("")).cast("int"), F.lit(0))
    return F.greatest(after - exponent, F.lit(0))


def can_pin(category) -> Column:
    """May a story of this category be drawn? One that is not known may."""
    return F.coalesce(mapped(F.coalesce(col(category), F.lit("")), schemas.PIN_POSSIBLE), F.lit(True))


#: Dollars for a million tokens: cached input, other input, output.
PRICES = {"deepseek-flash": (0.006, 0.30, 1.20), "deepseek-v4-pro": (0.044, 1.32, 3.96)}


def cost_usd(model, hit, miss, out, peak, prices: dict[str, tuple[float, float, float]] = PRICES) -> Column:
    """Dollars of a call: tokens in and out at rates for a million, half of it off peak; an unknown model at the dearest rates."""
    dearest = max(prices.values(), key=lambda p: p[2])
    rate = lambda n: F.coalesce(mapped(model, {k: v[n] for k, v in prices.items()}), F.lit(dearest[n]))
    full = (col(hit) * rate(0) + col(miss) * rate(1) + col(out) * rate(2)) / 1_000_000
    return F.when(col(peak), full).otherwise(full / 2)


def cache_misses(prompt, hit, miss) -> Column:
    """Prompt tokens that were not cached; all of them if neither number came."""
    return F.when((F.coalesce(col(hit), F.lit(0)) == 0) & (F.coalesce(col(miss), F.lit(0)) == 0), col(prompt)).otherwise(F.coalesce(col(miss), F.lit(0)))


def _column(lon, degrees: float) -> Column:
    """The column of a grid whose columns are at most so wide and divide the circle evenly."""
    n = ceil(360 / degrees)
    return F.least(F.floor(F.pmod(col(lon), F.lit(360.0)) * (n / 360.0)), F.lit(n - 1))


def cell(lat, lon, degrees: float) -> Column:
    """The field of a grid that a point is in, degrees high and about as wide."""
    return F.concat_ws(",", F.floor(col(lat) / degrees), _column(lon, degrees))


def cells_around(lat, lon, km: float, degrees: float) -> Column:
    """An array of the fields that a circle of km around a point may reach into, each once; near a pole all of a row."""
    n, arc = ceil(360 / degrees), km / 111.0  # a degree of latitude has a little more than 111 km
    row = lambda y: F.floor(y / degrees)
    top = F.abs(col(lat)) + arc
    wide = F.when(top >= 89.0, F.lit(180.0)).otherwise(F.lit(arc) / F.cos(F.radians(top)))
    column = lambda x: F.floor(x * (n / 360.0))
    columns = F.transform(F.sequence(column(col(lon) - wide), F.least(column(col(lon) + wide), column(col(lon) - wide) + n)), lambda c: F.pmod(c, F.lit(n)))
    return F.array_distinct(F.flatten(F.transform(F.sequence(row(col(lat) - arc), row(col(lat) + arc)), lambda r: F.transform(columns, lambda c: F.concat_ws(",", r, c)))))
