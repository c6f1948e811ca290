"""Times from the shapes that sources send, as UTC timestamps; what does not parse is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meridian.functions.text import blank_to_null, col

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
_MONTHS = "(january|february|march|april|may|june|july|august|september|october|november|december)"


def day_only(c) -> Column:
    """A day without a time, "2026/11/5" or "Tuesday 3 November 2026", as its midnight."""
    text = F.lower(F.trim(col(c)))
    slash = F.regexp_replace(F.when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), text), "/", "-")
    words = rf"^(?:[a-z]+day,?\s+)?(\d{{1,2}})\s+{_MONTHS}\s+(\d{{4}})$"
    named = F.when(text.rlike(words), F.concat_ws(" ", *(F.regexp_extract(text, words, n) for n in (1, 2, 3))))
    return F.coalesce(F.try_to_timestamp(slash, F.lit("yyyy-M-d")), F.try_to_timestamp(F.initcap(named), F.lit("d MMMM yyyy")))


#: Zone names of mail dates.
ZONES = {"GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700"}
_MAIL = r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2} [A-Za-z]{3} \d{4}) (\d{2}:\d{2})(:\d{2})?(?:\s+(\S+))?$"


def mail_date(c) -> Column:
    """A date as in mail headers. Weekdays can't be parsed and nothing depends on them; no zone is UTC, an unknown one null."""
    part = lambda n: F.regexp_extract(col(c), _MAIL, n)
    zone = part(4)
    offset = F.when(zone.rlike(r"^[+-]\d{4}$"), zone).otherwise(F.element_at(F.create_map(*(F.lit(x) for pair in {"": "+0000", **ZONES}.items() for x in pair)), zone))
    whole = F.concat(part(1), F.lit(" "), part(2), F.when(part(3) == "", ":00").otherwise(part(3)), F.lit(" "), offset)
    return F.try_to_timestamp(F.when(part(1) != "", whole), F.lit("d MMM yyyy HH:mm:ss xx"))


def utc(c) -> Column:
    """ISO 8601, a mail date, seconds or milliseconds since 1970, or a day; a time without a zone is read as UTC."""
    text = blank_to_null(col(c).cast("string"))
    iso = F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text))
    number = F.when(text.rlike(r"^-?\d+(\.\d+)?$") & ~text.rlike(r"^\d{8}$"), text.cast("double"))
    epoch = F.timestamp_seconds(F.when(F.abs(number) > 1e11, number / 1000).otherwise(number))
    return F.date_trunc("second", F.coalesce(iso, mail_date(text), epoch, day_only(text)))


def iso(c) -> Column:
    return F.date_format(col(c), ISO)


def iso_from_millis(c) -> Column:
    return F.date_format(F.timestamp_millis(col(c)), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def strict_date(c) -> Column:
    """A YYYY-MM-DD date that there is, else null."""
    return F.to_date(F.try_to_timestamp(F.when(F.trim(col(c)).rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.trim(col(c))), F.lit("yyyy-M-d")))


def within_hours(a, b, hours: int = 48) -> Column:
    """At most so many hours apart, the edge included; false if a time is missing."""
    return F.coalesce(F.abs(F.unix_timestamp(col(a)) - F.unix_timestamp(col(b))) <= hours * 3600, F.lit(False))


def date_in_window(event, published, before: int = 3, after: int = 1) -> Column:
    """Is a date from `before` days before publication to `after` days after? Null without both."""
    day = F.to_date(col(published))
    return col(event).between(F.date_sub(day, before), F.date_add(day, after))


def minutes_since(then, now) -> Column:
    return F.floor((F.unix_timestamp(col(now)) - F.unix_timestamp(col(then))) / 60)


#: Hours of a working day, UTC, at which a call costs the full price.
PEAK_HOURS = [1, 2, 3, 6, 7, 8, 9]


def is_peak(c) -> Column:
    return F.weekday(col(c)).between(0, 4) & F.hour(col(c)).isin(PEAK_HOURS)


def start_point(cursor, now, days: int = 7) -> Column:
    """The cursor, but never further back than the window."""
    floor = col(now) - F.make_dt_interval(days=F.lit(days))
    return F.greatest(F.coalesce(col(cursor), floor), floor)


def retry_delay(attempt, jitter, base: float = 1.0, cap: float = 60.0, retry_after=None) -> Column:
    """Seconds to wait before another try: twice as long each time up to a cap, times 0.5 to 1.5 by a jitter from 0 to 1.

    What the other side asked for, as a number of seconds, comes before that, up to the same cap.
    """
    own = F.least(F.lit(base) * F.pow(F.lit(2.0), F.greatest(col(attempt) - 1, F.lit(0))), F.lit(cap)) * (F.lit(0.5) + col(jitter))
    if retry_after is None:
        return own
    asked = F.nullif(F.trim(col(retry_after)), F.lit("")).try_cast("double")
    return F.when(asked.isNull(), own).otherwise(F.greatest(F.least(asked, F.lit(cap)), F.lit(0.0)))
