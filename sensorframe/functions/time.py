"""Time grid and timestamp parsing (F01-F03). Timestamps are local and naive (TIMESTAMP_NTZ) unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds of the grid, and the zone that naive times are in.
STEP = 10
LOCAL_ZONE = "Asia/Singapore"


def seconds_of(ts: Column) -> Column:
    """Seconds since 1970 of a naive timestamp, as if it were UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def floor_to(ts: Column, seconds: int = STEP) -> Column:
    """Start of the grid slot that holds a naive timestamp (F01); a null stays null."""
    return F.timestamp_add("SECOND", seconds_of(ts) - F.pmod(seconds_of(ts), F.lit(seconds)), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


#: An offset or Z at the end of a time.
AWARE = r"([zZ]|[+-]\d{2}:?\d{2})\s*$"


def local_of(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    """The naive local time of an instant, whatever the zone of the session."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def to_local_naive(text: Column, aware_zone: str = LOCAL_ZONE, naive_means: str = "local") -> Column:
    """A naive local timestamp from text.

    Text with an offset or Z is moved to ``aware_zone``. Text without is local already, or UTC where
    ``naive_means`` is "utc". What cannot be parsed is null.
    """
    aware = text.rlike(AWARE)
    plain = text.try_cast("timestamp_ntz")
    if naive_means == "utc":
        plain = F.convert_timezone(F.lit("UTC"), F.lit(aware_zone), plain)
    return F.when(aware, local_of(F.try_to_timestamp(text), aware_zone)).otherwise(plain)


def message_time(text: Column, zone: str = LOCAL_ZONE) -> Column:
    """A naive local timestamp from a message's time in any of its forms (F03): ISO, blank or underscore between date and time, or seconds since 1970.

    Seconds and text with an offset or Z are instants, whose local time in ``zone`` counts; all other text is local already.
    """
    number = text.rlike(r"^\s*\d+(\.\d+)?\s*$")
    epoch = F.when(number, local_of(F.timestamp_seconds(text.try_cast("double")), zone))
    underscored = F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}\s*$"), F.regexp_replace(text, r"^\s*(\S+)_(\d+)-(\d+)-(\d+)\s*$", "$1 $2:$3:$4").try_cast("timestamp_ntz"))
    return F.coalesce(epoch, underscored, F.when(~number, to_local_naive(F.trim(text), zone)))
