"""All tables of the mart, derived lazily from the two raw inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from weathermart.operators import bronze, dimensions, facts, gold, silver


@dataclass(frozen=True)
class Options:
    """Choices of the transformations; the defaults are the standard behaviour."""

    cities: Sequence[str] | None = None
    shift_months: int = bronze.SHIFT_MONTHS
    rolling_frame: str = "rows"
    product_match: str = "code"


def _unstored(df: DataFrame, name: str) -> DataFrame:
    return df


class Mart:
    """Attribute access builds a table's plan; nothing runs until it is used.

    ``bronze_weather`` is the flat bronze table. ``store`` is called as
    ``store(df, name)`` on tables that feed several consumers; pass
    ``sources.paths.materialize`` to compute each of them once, or leave it out
    to get one lazy plan per table.
    """

    def __init__(
        self,
        raw_sales: DataFrame,
        bronze_weather: DataFrame,
        options: Options = Options(),
        store: Callable[[DataFrame, str], DataFrame] = _unstored,
    ):
        self.raw_sales = raw_sales
        self.bronze_weather = bronze_weather
        self.options = options
        self._store = store

    @cached_property
    def bronze_sales(self) -> DataFrame:
        return bronze.sales(self.raw_sales, self.options.cities, self.options.shift_months)

    @cached_property
    def silver_product_grain(self) -> DataFrame:
        return self._store(silver.product_grain(self.bronze_sales), "silver_product_grain")

    @cached_property
    def silver_sales_daily(self) -> DataFrame:
        return silver.daily_sales(self.silver_product_grain)

    @cached_property
    def silver_weather(self) -> DataFrame:
        return self._store(silver.weather(self.bronze_weather), "silver_weather")

    @cached_property
    def gold_sales_weather(self) -> DataFrame:
        return self._store(
            gold.sales_weather(
                self.silver_sales_daily, self.silver_weather, self.options.rolling_frame
            ),
            "gold_sales_weather",
        )

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.gold_sales_weather)

    @cached_property
    def dim_location(self) -> DataFrame:
        return dimensions.dim_location(self.gold_sales_weather)

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._store(dimensions.dim_product(self.silver_product_grain), "dim_product")

    @cached_property
    def fact_sales_weather(self) -> DataFrame:
        return facts.sales_weather(self.gold_sales_weather, self.dim_date, self.dim_location)

    @cached_property
    def fact_sales_weather_product(self) -> DataFrame:
        return facts.sales_weather_product(
            self.silver_product_grain,
            self.silver_weather,
            self.dim_date,
            self.dim_location,
            self.dim_product,
            self.options.product_match,
        )

    def tables(self) -> dict[str, DataFrame]:
        names = (
            "bronze_sales",
            "bronze_weather",
            "silver_product_grain",
            "silver_sales_daily",
            "silver_weather",
            "gold_sales_weather",
            "dim_date",
            "dim_location",
            "dim_product",
            "fact_sales_weather",
            "fact_sales_weather_product",
        )
        return {name: getattr(self, name) for name in names}
