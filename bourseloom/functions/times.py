"""Market-zone time handling.

Parsed times are market wall-clock values of type TIMESTAMP_NTZ, so no result depends on
the session zone once the text is read. TIMESTAMP columns are instants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourseloom.session import MARKET_ZONE

# Time text formats, in the order they are tried.
LEGACY_FORMATS = ["d MMM yyyy, h:mm a", "d MMMM yyyy, h:mm a", "d MMM yyyy"]
ZONE_SUFFIX = " IST"
PAYLOAD_FORMAT = "dd-MMM-yyyy HH:mm:ss"
INTRADAY_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

_ISO_DATE = r"^\d{4}-\d{2}-\d{2}"
_ISO_CLOCK = r"([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?"
_ISO_OFFSET = r"(Z|[+-]\d{2}:?\d{2})"
ISO_ANY = _ISO_DATE + _ISO_CLOCK + _ISO_OFFSET + "?$"


def to_market(instant: Column, zone: str = MARKET_ZONE) -> Column:
    """TIMESTAMP (an instant) -> market wall clock."""
    return F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz"))


def utc_to_market(wall_utc: Column, zone: str = MARKET_ZONE) -> Column:
    """UTC wall clock (NTZ) -> market wall clock (NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), wall_utc)


def coerce_time(c: Column) -> Column:
    """Text -> wall clock, null when it is no ISO time; an offset in the text is ignored."""
    text = F.trim(c)
    return F.when(text.rlike(ISO_ANY), text.try_cast("timestamp_ntz"))


def parse_instant(c: Column, zone: str = MARKET_ZONE) -> Column:
    """ISO text with an offset -> market wall clock. Text without an offset counts as UTC.

    Missing seconds are zero, and so is a missing clock.
    """
    text = F.regexp_replace(F.trim(c), _ISO_DATE + "$", "$0T00:00:00")
    text = F.regexp_replace(text, f"({_ISO_DATE}[T ]\\d{{2}}:\\d{{2}})({_ISO_OFFSET}?)$", "$1:00$2")
    zoned = F.when(text.rlike(_ISO_OFFSET + "$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(ISO_ANY), to_market(zoned.try_cast("timestamp"), zone))


def parse_legacy(c: Column) -> Column:
    """``28 May 2026, 05:42 PM IST`` and its variants, first format that fits."""
    text = F.replace(F.trim(c), F.lit(ZONE_SUFFIX), F.lit(""))
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in LEGACY_FORMATS]
    return F.coalesce(*tries)


def parse_news_time(attribute: Column, title: Column, zone: str = MARKET_ZONE) -> Column:
    """Time of a news card: instant attribute, then local ISO title, then the legacy title."""
    return F.coalesce(parse_instant(attribute, zone), coerce_time(title), parse_legacy(title))


def parse_history_time(c: Column, zone: str = MARKET_ZONE) -> Column:
    """Stored time text: with an offset it is an instant, without one it is market time."""
    text = F.trim(c)
    has_offset = text.rlike(_ISO_CLOCK + _ISO_OFFSET + "$")
    return F.when(has_offset, parse_instant(text, zone)).otherwise(coerce_time(text))


def zone_offset(wall: Column, zone: str = MARKET_ZONE) -> Column:
    """``+05:30`` style offset of the market zone at a market wall-clock time."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    m = F.round((epoch_seconds(wall) - epoch_seconds(utc)) / 60).cast("int")
    return F.concat(
        F.when(m < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.floor(F.abs(m) / 60).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((F.abs(m) % 60).cast("string"), 2, "0"),
    )


def epoch_seconds(wall: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the same wall clock."""
    day = F.datediff(F.to_date(wall), F.lit("1970-01-01").cast("date")).cast("long")
    return day * 86400 + F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def iso_market(wall: Column, zone: str = MARKET_ZONE) -> Column:
    """ISO text with offset; microseconds appear only when they are not zero."""
    micros = F.date_format(wall, "SSSSSS")
    fraction = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit(""))
    return F.concat(F.date_format(wall, ISO_SECONDS), fraction, zone_offset(wall, zone))


def market_now(zone: str = MARKET_ZONE) -> Column:
    """Current market wall clock; kept out of checked queries."""
    return to_market(F.current_timestamp(), zone)


def market_date(df: DataFrame, name: str, zone: str = MARKET_ZONE) -> Column:
    """Calendar day of a time column: instants move to the market zone, wall clocks stay."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampType):
        return F.to_date(to_market(c, zone))
    if isinstance(dtype, T.StringType):
        return F.to_date(parse_history_time(c, zone))
    return F.to_date(c)


def payload_date(c: Column, fallback: Column | None = None) -> Column:
    """Trading date of a snapshot stamp; ``fallback`` (default: today's market date) if unreadable."""
    parsed = F.to_date(F.try_to_timestamp(F.trim(c), F.lit(PAYLOAD_FORMAT)).cast("timestamp_ntz"))
    return F.coalesce(parsed, fallback if fallback is not None else F.to_date(market_now()))


def intraday_text(wall: Column) -> Column:
    return F.date_format(wall, INTRADAY_FORMAT)
