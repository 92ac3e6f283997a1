"""Assertions over a table: rules that every row must keep, counted in the pass that writes it.

A rule is a condition on one row; a condition that is null counts as broken. ``observed`` counts
checked and broken rows of every rule while the table is written, so checking costs no job of its
own. Rows that break a rule can be set aside (``kept`` and ``quarantined``) or fail the table.
Keys, which no single row can show, are rules over groups (``repeated_keys``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weathermart.functions.measures import rain_flag, sales_bucket, temperature_bucket

BROKEN = "broken_rules"


@dataclass(frozen=True)
class Rule:
    """``holds`` is a condition as SQL text, or a column."""

    name: str
    holds: str | Column

    @property
    def broken(self) -> Column:
        holds = F.expr(self.holds) if isinstance(self.holds, str) else self.holds
        return ~F.coalesce(holds, F.lit(False))


def _same(column: str, value: Column) -> Column:
    return F.col(column).eqNullSafe(value)


def gold_rules(cities: Sequence[str]) -> list[Rule]:
    """What holds for every row of ``gold_sales_weather``, whatever the inputs were."""
    return [
        Rule("date is set", "date IS NOT NULL"),
        Rule("city is listed", F.col("city").isin(*cities)),
        Rule("sales are positive", "total_sales > 0"),
        Rule("rain flag fits the rain", _same("is_rainy", rain_flag(F.col("precipitation")))),
        Rule("temperature bucket fits", _same("temp_category", temperature_bucket(F.col("avg_temp")))),
        Rule("sales bucket fits", _same("sales_category", sales_bucket(F.col("total_sales")))),
        Rule("rolling mean is set", "rolling_7d_sales > 0"),
        Rule("rain is not negative", "coalesce(precipitation, 0) >= 0"),
    ]


class RuleError(ValueError):
    """Rows broke rules of a table that must keep them."""


def _metrics(rules: Sequence[Rule]) -> list[Column]:
    counts = [F.count_if(rule.broken).alias(f"broken_{i}") for i, rule in enumerate(rules)]
    return [F.count(F.lit(1)).alias("checked"), *counts]


def observed(df: DataFrame, rules: Sequence[Rule], observation: Observation) -> DataFrame:
    """``df`` whose rows are counted, by rule, by whatever action uses it first."""
    return df.observe(observation, *_metrics(rules))


def results(observation: Observation, rules: Sequence[Rule]) -> dict[str, tuple[int, int]]:
    """Rule -> rows checked, rows broken; waits for the action."""
    seen = observation.get
    return {rule.name: (seen["checked"], seen[f"broken_{i}"]) for i, rule in enumerate(rules)}


def summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule, checked, failed`` in one scan, for a table that is there already."""
    one = df.agg(*_metrics(rules))
    rows = [
        F.struct(F.lit(rule.name).alias("rule"), F.col("checked"), F.col(f"broken_{i}").alias("failed"))
        for i, rule in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*rows)))


def marked(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with the names of the rules that each row breaks."""
    return df.withColumn(
        BROKEN, F.array_compact(F.array(*(F.when(rule.broken, F.lit(rule.name)) for rule in rules)))
    )


def kept(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return marked(df, rules).filter(F.size(BROKEN) == 0).drop(BROKEN)


def quarantined(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that ``kept`` leaves out, with ``broken_rules``."""
    return marked(df, rules).filter(F.size(BROKEN) > 0)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that more than one row has, and how many."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
