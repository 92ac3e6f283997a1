"""Format-dispatched table reader and writer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

READ_FORMATS = ("delta", "parquet", "json")


def read(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Read a table; ``delta`` needs its package on the session's class path.

    ``json`` reads one document per file. ``merge_schema`` unions the columns of
    Parquet files that were appended with different schemas.
    """
    if format not in READ_FORMATS:
        raise ValueError(f"Unsupported format: {format}")
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "json":
        reader = reader.option("multiLine", True)
    if format == "parquet" and merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def write(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    partition_cols: str | Sequence[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool = False,
    observation: Observation | None = None,
) -> None:
    """Write a table, by one or several partition columns.

    ``rebalance`` shuffles rows by the partition columns first, for scans whose
    tasks would each leave a file in every one of many partition values; adaptive
    execution splits a hot value over several tasks and merges small ones. Leave
    it off where each task meets only a few values (line grain by city), since
    the shuffle then costs more than the files it saves, and after a shuffle,
    where adaptive execution already merges small partitions.
    ``observation`` collects the row count during the write, without a second
    job. It sits in the writing stage, so a repeated shuffle stage adds nothing.
    """
    columns = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols or ())
    if rebalance:
        df = df.hint("rebalance", *columns)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    writer = df.write.format(format).mode(mode)
    if format == "delta":
        writer = writer.option("mergeSchema", True)
    if format == "csv":
        writer = writer.options(
            header=True,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(path)
