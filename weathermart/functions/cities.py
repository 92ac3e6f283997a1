"""The configured cities and the rule that assigns a customer to one of them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class City(NamedTuple):
    name: str
    country: str
    lat: float
    lon: float


# The five configured cities, in their assignment order.
CITIES: tuple[City, ...] = (
    City("London", "GB", 51.5074, -0.1278),
    City("Manchester", "GB", 53.4808, -2.2426),
    City("Birmingham", "GB", 52.4862, -1.8904),
    City("Leeds", "GB", 53.8008, -1.5491),
    City("Glasgow", "GB", 55.8642, -4.2518),
)


def city_table(spark: SparkSession, cities: Sequence[City] = CITIES) -> DataFrame:
    """The city list as a local relation, so its exact size is known to the planner."""
    columns = list(zip(*cities, strict=True))
    return spark.createDataFrame(
        pa.table(dict(zip(("name", "country", "lat", "lon"), columns, strict=True)))
    )


def assign_city(customer_id: Column | str, names: Sequence[str] | None = None) -> Column:
    """City by ``customer_id % len(names)``; every other remainder gets the last name.

    ``%`` keeps the sign in Spark, so negative ids mostly fall to the last city,
    as does a null id.
    """
    names = tuple(names or (city.name for city in CITIES))
    remainder = (F.col(customer_id) if isinstance(customer_id, str) else customer_id) % len(names)
    *listed, last = names
    rule = F.when(F.lit(False), F.lit(last))
    for position, name in enumerate(listed):
        rule = rule.when(remainder == position, F.lit(name))
    return rule.otherwise(F.lit(last))
