"""Optional removal of repeated ingestion runs; the raw layer itself only appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weathermart.sources.uploads import INGESTED_AT, SOURCE_FILE


def newest_batches(raw: DataFrame) -> DataFrame:
    """The last ``_ingested_at`` of every source file: one row per file."""
    return raw.groupBy(SOURCE_FILE).agg(F.max(INGESTED_AT).alias(INGESTED_AT))


def latest_uploads(raw: DataFrame, newest: DataFrame) -> DataFrame:
    """Lines of each source file's newest batch; equal lines inside it all stay.

    Pass ``newest`` as a written table (``materialize(newest_batches(raw))``), so
    that its size is known and a short list is broadcast: one source file may
    hold a third of the lines and must not be gathered by its name.
    """
    return raw.join(
        newest,
        raw[SOURCE_FILE].eqNullSafe(newest[SOURCE_FILE])
        & raw[INGESTED_AT].eqNullSafe(newest[INGESTED_AT]),
        "left_semi",
    )


def latest_weather(days: DataFrame) -> DataFrame:
    """One row per (city, date): the reading of the newest run.

    A struct maximum instead of a ranking window, so repeated runs collapse
    before the shuffle. Readings with equal stamps resolve by value.
    """
    values = ("temp_max", "temp_min", "precipitation")
    newest = F.max(F.struct("extracted_at", *values)).alias("newest")
    return (
        days.groupBy("city", "date")
        .agg(newest)
        .select("city", "date", *(F.col(f"newest.{name}").alias(name) for name in values))
    )
