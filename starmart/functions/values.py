"""Bands, calendar days and time stamps as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Band edges.
TIER_EDGES = [(25, "budget"), (100, "standard")]
RATING_EDGES = [("4.5", "excellent"), ("4.0", "good"), ("3.0", "average")]

# Accepted forms of a date or time stamp, and the years it may name.
ISO_FORM = (
    r"^(\d{4})(?:-(\d{1,2})(?:-(\d{1,2}))?|(\d{2})(\d{2}))?"
    r"(?:[T ](\d{1,2})(?::?(\d{2})(?::?(\d{2})(?:\.(\d+))?)?)?\s?(Z|[+-]\d{2}(?::?\d{2})?)?)?\z"
)
FIRST_YEAR, LAST_YEAR = "1678", "2261"


def price_tier(price: Column) -> Column:
    out = None
    for edge, name in TIER_EDGES:
        out = F.when(price < edge, name) if out is None else out.when(price < edge, name)
    return out.otherwise("premium")


def rating_band(rate: Column) -> Column:
    out = F.when(rate.isNull(), "unrated")
    for edge, name in RATING_EDGES:
        out = out.when(rate >= F.lit(edge).cast("double"), name)
    return out.otherwise("poor")


def _rebuilt(text: Column) -> Column:
    """The instant of a text in any of the accepted forms, by its parts."""
    def part(i: int, default: str, width: int = 2) -> Column:
        got = F.regexp_extract(text, ISO_FORM, i)
        return F.when(got == "", default).otherwise(F.lpad(got, width, "0"))

    month = F.concat(F.regexp_extract(text, ISO_FORM, 2), F.regexp_extract(text, ISO_FORM, 4))
    day = F.concat(F.regexp_extract(text, ISO_FORM, 3), F.regexp_extract(text, ISO_FORM, 5))
    zone = F.regexp_replace(F.regexp_extract(text, ISO_FORM, 10), "^([+-]\\d{2}):?(\\d{2})?$", "$1:$2")
    rebuilt = F.concat(
        part(1, "1970", 4), F.lit("-"), F.when(month == "", "01").otherwise(F.lpad(month, 2, "0")),
        F.lit("-"), F.when(day == "", "01").otherwise(F.lpad(day, 2, "0")),
        F.lit("T"), part(6, "00"), F.lit(":"), part(7, "00"), F.lit(":"), part(8, "00"),
        F.lit("."), F.substring(F.concat(F.regexp_extract(text, ISO_FORM, 9), F.lit("000000")), 1, 6),
        F.when(zone.endswith(":"), F.concat(zone, F.lit("00"))).otherwise(zone),
    )
    return F.when(text.rlike(ISO_FORM), rebuilt.try_cast("timestamp"))


def iso_timestamp(text: Column) -> Column:
    """The instant an ISO 8601 text names, null for any other text. No offset means UTC.

    The usual forms need one match and one cast. The rare ones are rebuilt in a function over an array of one, whose code does not
    swell that of the usual ones beyond what the JVM compiles.
    """
    usual = text.rlike(r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:Z|[+-]\d{2}:\d{2})?)?\z")
    return F.when(~F.substring(text, 1, 4).between(FIRST_YEAR, LAST_YEAR), None).when(
        usual, text.try_cast("timestamp")
    ).otherwise(F.transform(F.array(text), _rebuilt)[0])


def utc_day(text: Column) -> Column:
    return F.to_date(iso_timestamp(text))


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_to_date(key: Column) -> Column:
    return F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)
