"""The written pipeline: named stages that read the lake and write the lake.

Every stage reads the tables earlier stages wrote, so a failed run resumes at
the failed stage, no lineage grows across stages, and each join sees real table
sizes. Overwriting stages can be repeated; the two landing stages append.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType

from weathermart.functions.cities import CITIES, City
from weathermart.functions.temporal import UPLOAD_DATE_FORMATS
from weathermart.operators import bronze, dedupe, dimensions, facts, gold, rules, silver
from weathermart.plans.mart import Options
from weathermart.schemas import (
    CONTRACTS,
    RAW_SALES,
    RETAIL_UPLOAD,
    WEATHER_DAYS,
    check_contract,
)
from weathermart.sources import key_registry, ledger, tables, uploads, weather
from weathermart.sources.paths import layer_path, materialize, scratch_scope

logger = logging.getLogger(__name__)

# Where each table lives below the lake root: layer, entity, source.
LOCATIONS = {
    "raw_sales": ("raw", "retail_sales", "uci_online_retail"),
    "raw_weather": ("raw", "weather", "open_meteo"),
    "bronze_sales": ("bronze", "sales", "online_retail"),
    "bronze_weather": ("bronze", "weather", "open_meteo"),
    "silver_sales_daily": ("silver", "sales", "online_retail"),
    "silver_product_grain": ("silver", "sales", "product_grain"),
    "silver_weather": ("silver", "weather", "open_meteo"),
}


@dataclass(frozen=True)
class Lake:
    """Where the inputs and the tables are, and how the stages treat them.

    ``format`` is the table format of silver and gold; bronze is always Parquet.
    The ``upload_`` fields are passed to ``uploads.land_uploads``.
    ``line_rebalance`` shuffles the line tables of bronze and silver by city before they
    are written: fewer files where there are many cities, for one shuffle of all lines.
    ``latest_only`` keeps only the newest ingestion run of each upload and of each
    weather day, instead of every appended one.
    ``gold_check`` says what becomes of gold rows that break a rule, counted while gold is
    written: they are logged (``warn``), go to the table ``gold_quarantine`` instead
    (``quarantine``), or fail the stage before the table is replaced (``fail``).
    """

    root: str
    uploads: str
    landing: str
    upload_file: str | None = None
    upload_schema: StructType = RETAIL_UPLOAD
    upload_multiline: bool = False
    upload_encoding: str | None = None
    upload_rebalance: bool = True
    upload_date_formats: Sequence[str] = UPLOAD_DATE_FORMATS
    upload_on_error: str = "fail"
    upload_once: bool = False
    line_rebalance: bool = False
    format: str = "parquet"
    options: Options = Options()
    cities: Sequence[City] = field(default=CITIES)
    latest_only: bool = False
    gold_check: str = "warn"
    ingested_at: str | None = None

    def path(self, table: str) -> str:
        if table in LOCATIONS:
            return layer_path(self.root, *LOCATIONS[table])
        return f"{self.root.rstrip('/')}/gold/{table.removeprefix('gold_')}"

    def numbering(self, dimension: str) -> dimensions.Numbering:
        """Ids from the lake's key table of the dimension, which new members are added to."""
        path = f"{self.root.rstrip('/')}/keys/{dimension}"
        return lambda members, keys, id_column: key_registry.assign_keys(members, path, keys, id_column)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """A bronze, silver or gold table with the types of its contract.

        Parquet tables are read with the contract as their schema: no footer is
        opened for it, and a partition value that looks like a number stays text.
        """
        fmt = "parquet" if table.startswith("bronze_") else self.format
        schema = CONTRACTS[table] if fmt == "parquet" else None
        return tables.read(spark, self.path(table), fmt, schema)

    def write(
        self,
        df: DataFrame,
        table: str,
        partition_cols: str | Sequence[str] | None = None,
        rebalance: bool = False,
    ) -> dict[str, int]:
        fmt = "parquet" if table.startswith("bronze_") else self.format
        rows = Observation(table)
        tables.write(
            check_contract(df, table),
            self.path(table),
            fmt,
            partition_cols,
            rebalance=rebalance,
            observation=rows,
        )
        return {table: rows.get["rows"]}


def _land_weather(spark: SparkSession, lake: Lake) -> dict[str, int]:
    seen = Observation("raw_weather")
    weather.land_payloads(
        spark,
        lake.landing,
        lake.root,
        cities=lake.cities,
        extracted_at=lake.ingested_at,
        observation=seen,
    )
    counts = seen.get
    if counts["rejected"]:
        logger.warning("%d weather payloads failed validation", counts["rejected"])
    return {"raw_weather": counts["documents"]}


def _land_retail(spark: SparkSession, lake: Lake) -> dict[str, int]:
    seen, dates = Observation("raw_sales"), Observation("raw_sales_dates")
    landed = uploads.land_uploads(
        spark,
        lake.uploads,
        lake.root,
        file_name=lake.upload_file,
        ingested_at=lake.ingested_at,
        schema=lake.upload_schema,
        multiline=lake.upload_multiline,
        encoding=lake.upload_encoding,
        rebalance=lake.upload_rebalance,
        observation=seen,
        formats=lake.upload_date_formats,
        dates=dates,
        on_error=lake.upload_on_error,
        once=lake.upload_once,
    )
    if landed is None:
        logger.warning("no uploads in %s", lake.uploads)
        return {"raw_sales": 0}
    if unreadable := dates.get["unreadable_dates"]:
        logger.warning("%d upload rows have a date that no format reads", unreadable)
    return {"raw_sales": seen.get["rows"]}


def _bronze_sales(spark: SparkSession, lake: Lake) -> dict[str, int]:
    raw = spark.read.schema(RAW_SALES).parquet(lake.path("raw_sales"))
    if lake.latest_only:
        # The ledger has a row per upload; tables landed before there was one are scanned.
        landed = ledger.read_or_empty(spark, uploads.report_path(lake.root, "landed"), ledger.LANDED)
        newest = dedupe.newest_batches(raw) if landed.isEmpty() else ledger.newest_batches(landed)
        raw = dedupe.latest_uploads(raw, materialize(newest, "newest_batches"))
    names = lake.options.cities or [city.name for city in lake.cities]
    lines = bronze.sales(raw, names, lake.options.shift_months)
    return lake.write(lines, "bronze_sales", "city", lake.line_rebalance)


def _bronze_weather(spark: SparkSession, lake: Lake) -> dict[str, int]:
    documents = weather.read_documents(spark, lake.path("raw_weather"), WEATHER_DAYS)
    if lake.latest_only:
        days = dedupe.latest_weather(bronze.zip_days(documents))
    else:
        days = bronze.weather(documents)
    return lake.write(days, "bronze_weather", "city", rebalance=True)


def _silver_sales(spark: SparkSession, lake: Lake) -> dict[str, int]:
    lines = silver.product_grain(lake.read(spark, "bronze_sales"))
    counts = lake.write(lines, "silver_product_grain", "city", lake.line_rebalance)
    daily = silver.daily_sales(lake.read(spark, "silver_product_grain"))
    return counts | lake.write(daily, "silver_sales_daily", "city")


def _silver_weather(spark: SparkSession, lake: Lake) -> dict[str, int]:
    seen = Observation("bronze_weather_days")
    days = silver.weather(lake.read(spark, "bronze_weather"), seen)
    counts = lake.write(days, "silver_weather", "city")
    if dropped := seen.get["unreadable_dates"]:
        logger.warning("%d weather days have an unreadable date and were dropped", dropped)
    return counts


def _gold(spark: SparkSession, lake: Lake) -> dict[str, int]:
    df = gold.sales_weather(
        lake.read(spark, "silver_sales_daily"),
        lake.read(spark, "silver_weather"),
        lake.options.rolling_frame,
    )
    checks = rules.gold_rules(lake.options.cities or [city.name for city in lake.cities])
    if lake.gold_check not in ("warn", "quarantine", "fail"):
        raise ValueError(f"gold_check must be warn, quarantine or fail, not {lake.gold_check}")
    seen = Observation("gold_rules")
    with scratch_scope(spark):
        counted = rules.observed(df, checks, seen)
        if lake.gold_check != "warn":
            # Judged before gold is replaced, so that a broken run leaves the last good table.
            counted = materialize(counted, "gold")
            broken = {n: b for n, (_, b) in rules.results(seen, checks).items() if b}
            if broken and lake.gold_check == "fail":
                raise rules.RuleError(f"gold breaks its rules: {broken}")
            tables.write(rules.quarantined(counted, checks), lake.path("gold_quarantine"), lake.format)
            counted = rules.kept(counted, checks)
        counts = lake.write(counted, "gold_sales_weather", "city")
    for name, (checked, broken) in rules.results(seen, checks).items():
        if broken:
            logger.warning("%d of %d gold rows break the rule: %s", broken, checked, name)
    return counts


def _dim_date(spark: SparkSession, lake: Lake) -> dict[str, int]:
    df = dimensions.dim_date(lake.read(spark, "gold_sales_weather"))
    return lake.write(df, "dim_date")


def _dim_location(spark: SparkSession, lake: Lake) -> dict[str, int]:
    df = dimensions.dim_location(lake.read(spark, "gold_sales_weather"), lake.numbering("dim_location"))
    return lake.write(df, "dim_location")


def _dim_product(spark: SparkSession, lake: Lake) -> dict[str, int]:
    df = dimensions.dim_product(lake.read(spark, "silver_product_grain"), lake.numbering("dim_product"))
    return lake.write(df, "dim_product")


def _fact(spark: SparkSession, lake: Lake) -> dict[str, int]:
    df = facts.sales_weather(
        lake.read(spark, "gold_sales_weather"),
        lake.read(spark, "dim_date"),
        lake.read(spark, "dim_location"),
    )
    return lake.write(df, "fact_sales_weather", ["location_id"])


def _fact_product(spark: SparkSession, lake: Lake) -> dict[str, int]:
    df = facts.sales_weather_product(
        lake.read(spark, "silver_product_grain"),
        lake.read(spark, "silver_weather"),
        lake.read(spark, "dim_date"),
        lake.read(spark, "dim_location"),
        lake.read(spark, "dim_product"),
        lake.options.product_match,
    )
    return lake.write(df, "fact_sales_weather_product", ["location_id"])


# Stage names in the order of a full run.
STAGES: dict[str, Callable[[SparkSession, Lake], dict[str, int]]] = {
    "weather": _land_weather,
    "retail_sales": _land_retail,
    "sales_bronze": _bronze_sales,
    "weather_bronze": _bronze_weather,
    "sales_silver": _silver_sales,
    "weather_silver": _silver_weather,
    "gold": _gold,
    "dim_date": _dim_date,
    "dim_location": _dim_location,
    "dim_product": _dim_product,
    "fact": _fact,
    "fact_product": _fact_product,
}


def run(
    spark: SparkSession, lake: Lake, stages: Iterable[str] | None = None
) -> dict[str, int]:
    """Run the named stages, or all, in pipeline order; returns rows written per table."""
    wanted = set(STAGES if stages is None else stages)
    unknown = sorted(wanted - STAGES.keys())
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(unknown)}; known: {', '.join(STAGES)}")
    counts: dict[str, int] = {}
    for name, stage in STAGES.items():
        if name in wanted:
            written = stage(spark, lake)
            logger.info("stage %s wrote %s", name, written)
            counts |= written
    return counts
