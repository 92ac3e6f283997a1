"""Surrogate keys that stay: a stored table of the members seen so far, which only grows.

Each load numbers the members that the table lacks, densely after its highest id and in the
order of their digest, and appends them as one ``version=<n>`` folder. Ids handed out earlier
never change, so facts written with them stay valid when a dimension grows. A load without
new members adds nothing, and a failed one leaves no version behind. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from weathermart.functions.keys import with_dense_id
from weathermart.sources.paths import materialize

VERSION = "version"


def read_keys(spark: SparkSession, path: str, members: StructType, id_column: str) -> DataFrame:
    """All members with their id and the ``version`` that added them; empty before the first load."""
    schema = StructType(
        [*members.fields, StructField(id_column, LongType()), StructField(VERSION, IntegerType())]
    )
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def assign_keys(members: DataFrame, path: str, keys: Sequence[str], id_column: str) -> DataFrame:
    """The distinct ``members`` with their stored id, after the new ones were numbered and stored.

    ``keys`` name all columns of ``members``; nulls are members too. New members are found by an
    anti-join, so only they are sorted and written.
    """
    spark = members.sparkSession
    members = materialize(members.select(*keys).distinct(), "members")
    known = read_keys(spark, path, members.schema, id_column)

    def same(a: DataFrame, b: DataFrame):
        return reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys))

    state = known.agg(F.max(id_column).alias("last"), F.max(VERSION).alias("version")).first()
    new = materialize(members.join(known, same(members, known), "left_anti"), "new_members")
    if not new.isEmpty():
        numbered = with_dense_id(new, list(keys), id_column)
        if state.last is not None:
            numbered = numbered.withColumn(id_column, F.col(id_column) + F.lit(state.last + 1))
        version = 0 if state.version is None else state.version + 1
        numbered.write.mode("overwrite").parquet(f"{path}/{VERSION}={version}")
    stored = read_keys(spark, path, members.schema, id_column)
    return members.join(stored, same(members, stored)).select(*(members[k] for k in keys), stored[id_column])
