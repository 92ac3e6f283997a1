"""Dense surrogate keys that do not depend on how the data is partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The bucket is this many leading hex digits of a digest: 16**3 = 4096 buckets.
_BUCKET_DIGITS = 3


def with_dense_id(members: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Number distinct ``members`` 0..n-1 in the order of their key digest.

    Ids come from the key values alone, so two runs, other partition counts or a
    lost executor give the same ids. Digest buckets are even for any key
    distribution, so no task orders more than about n / 4096 members, and the
    running offset is taken over at most 4096 bucket counts; that bound is also
    what makes the broadcast safe.
    """
    digest, bucket = "__digest", "__bucket"
    hashed = members.withColumn(
        digest, F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys)))
    ).withColumn(bucket, F.substring(digest, 1, _BUCKET_DIGITS))

    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("__members"))
        .select(bucket, F.coalesce(F.sum("__members").over(before), F.lit(0)).alias("__offset"))
    )
    within = Window.partitionBy(bucket).orderBy(digest, *keys)
    return (
        hashed.withColumn("__position", F.row_number().over(within))
        .join(F.broadcast(offsets), bucket)
        .select(
            *members.columns,
            (F.col("__offset") + F.col("__position") - 1).cast("bigint").alias(id_column),
        )
    )
