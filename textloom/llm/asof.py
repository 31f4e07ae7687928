"""As-of joins that no key can overload: time is cut into slices, the latest earlier row is looked
for inside a slice, and else taken from the slices before, of which only one row each is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_before(events: DataFrame, keys: list[str], time: str, offered: Column, width: int) -> DataFrame:
    """Adds ``found``: of the rows with equal keys and an earlier ``time`` (long), the latest
    ``offered`` value, a struct that is null on rows that offer none; among rows of one time, the
    largest struct. Keys must not be null. ``width``: time units in a slice."""
    sliced = events.withColumn("__slice", F.floor(F.col(time) / width)).withColumn(
        "__offer", F.when(offered.isNotNull(), F.struct(F.col(time).alias("at"), offered.alias("value")))
    )
    earlier = W.partitionBy(*keys, "__slice").orderBy(time).rangeBetween(W.unboundedPreceding, -1)
    inside = sliced.withColumn("__inside", F.max("__offer").over(earlier))
    tails = sliced.groupBy(*keys, "__slice").agg(F.max("__offer").alias("__tail"))
    before = W.partitionBy(*keys).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    tails = tails.select(*keys, "__slice", F.max("__tail").over(before).alias("__carry"))
    joined = inside.join(tails, [*keys, "__slice"])
    found = F.coalesce("__inside", "__carry").getField("value")
    return joined.withColumn("found", found).drop("__slice", "__offer", "__inside", "__carry")
