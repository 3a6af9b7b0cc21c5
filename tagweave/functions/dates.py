"""Post dates: ``EEE MMM dd HH:mm:ss zzz yyyy`` (e.g. ``Mon Apr 06 22:19:45 PDT 2009``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed values. Spark refuses the day-of-week letter when parsing, so the
# weekday token is dropped and the rest is parsed with these patterns: a named region, or an offset.
PARSE_PATTERN = "MMM dd HH:mm:ss zzz yyyy"
OFFSET_PATTERN = "MMM dd HH:mm:ss xx yyyy"
# Abbreviations that name an offset from UTC, whatever the season of the date. (As a region's
# name Spark would read PST and PDT alike, by the date.)
ZONE_OFFSETS = {
    "UTC": "+0000", "GMT": "+0000", "UT": "+0000", "Z": "+0000", "WET": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600",
    "PST": "-0800", "PDT": "-0700", "AKST": "-0900", "AKDT": "-0800", "HST": "-1000",
    "BST": "+0100", "WEST": "+0100", "CET": "+0100", "CEST": "+0200", "EET": "+0200", "EEST": "+0300",
    "MSK": "+0300", "JST": "+0900",
}
# Compatibility constant of the legacy loader (every row got this instant),
# pinned to UTC so it does not move with the session time zone.
CONSTANT_CREATED_AT = "2009-01-01 00:00:00 UTC"


def parse_post_date(date) -> Column:
    """Parse a post date to a timestamp; malformed text or an unknown zone is null.

    The zone token, the one before the year, is an abbreviation of ``ZONE_OFFSETS``, an offset (``-0700`` or ``-07:00``), or a region's
    name (``America/Los_Angeles``), which is resolved by the date.
    """
    c = F.trim(as_col(date))
    rest = F.regexp_replace(c, r"^\s*\S+\s+", "")
    zone = F.upper(F.regexp_extract(c, r"(\S+)\s+\S+\s*$", 1))
    known = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])
    offset = F.coalesce(F.try_element_at(known, zone),
                        F.when(zone.rlike(r"^[+-][0-9]{2}:?[0-9]{2}$"), F.replace(zone, F.lit(":"), F.lit(""))))
    with_offset = F.regexp_replace(rest, F.lit(r"\S+(\s+\S+\s*)$"), F.concat(offset, F.lit("$1")))
    return F.when(offset.isNull(), F.try_to_timestamp(rest, F.lit(PARSE_PATTERN))).otherwise(
        F.try_to_timestamp(with_offset, F.lit(OFFSET_PATTERN)))


def constant_created_at() -> Column:
    return F.to_timestamp(F.lit(CONSTANT_CREATED_AT), "yyyy-MM-dd HH:mm:ss z")


def strip_zone(date) -> Column:
    """Drop the zone token: all but the last two tokens, then the last one.

    ``Mon Apr 06 22:19:45 PDT 2009`` -> ``Mon Apr 06 22:19:45 2009``. With fewer
    than three tokens the head is empty and the result starts with a blank
    (``junk`` -> `` junk``); null or blank input gives null.
    """
    toks = F.regexp_extract_all(as_col(date), F.lit(r"\S+"), F.lit(0))
    n = F.size(toks)
    head = F.array_join(F.slice(toks, 1, F.greatest(n - 2, F.lit(0))), " ")
    return F.when(n > 0, F.concat(head, F.lit(" "), F.element_at(toks, -1)))
