"""Date and time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date layouts accepted in uploads beside ISO text. An upload's own values choose
# among them; where these leave it open, the first that fits wins, so the month goes first as
# in pandas.
UPLOAD_DATE_FORMATS = (
    "M/d/yyyy[ H:mm[:ss]]",
    "M/d/yyyy h:mm[:ss] a",
    "yyyy/M/d[ H:mm[:ss]]",
    "d.M.yyyy[ H:mm[:ss]]",
    "d-MMM-yyyy[ H:mm[:ss]]",
    "M/d/yy[ H:mm[:ss]]",
    "MMM d yyyy[ H:mm[:ss]]",
    "yyyyMMdd",
    "d/M/yyyy[ H:mm[:ss]]",
    "d/M/yyyy h:mm[:ss] a",
    "d/M/yy[ H:mm[:ss]]",
    "M-d-yyyy[ H:mm[:ss]]",
    "d-M-yyyy[ H:mm[:ss]]",
)

# Names for dayofweek(), which counts from 1 = Sunday.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def iso_timestamp(text: Column) -> Column:
    """Timestamp from ISO text, else null.

    The guard keeps bare clock times out of the cast, which would complete them with
    today's date.
    """
    return F.when(text.rlike(r"^\s*\d{4}-\d"), F.try_to_timestamp(text))


def parse_timestamp(text: Column, formats: Sequence[str] = UPLOAD_DATE_FORMATS) -> Column:
    """Timestamp from upload text by the first layout that fits; anything unreadable becomes null.

    Each value is read alone; ``date_votes`` reads it as its upload's other values suggest. ISO
    text goes first because it is parsed by the cast path, which raises no exception per bad row.
    """
    return F.coalesce(iso_timestamp(text), *(F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats))


def shift_date(moment: Column, months: int) -> Column:
    """Move by whole months and drop the time of day; month ends clamp.

    Twelve years are 626 weeks and one day, so a 144-month shift also moves every
    weekday by one.
    """
    return F.add_months(moment, months).cast("date")


def weekday_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.dayofweek(date))
