"""Resolving mentions as they arrive: each micro-batch is resolved as a whole and appended; rows
that are there already are left out, so a batch that is tried again changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from textloom.operators.resolve import resolve_persons
from textloom.sources.writers import exists


def resolve_stream(mentions: DataFrame, forms: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """``mentions``: a stream of doc, ordinal, name. Writes the resolved rows below ``out``, one folder
    for each batch."""

    def batch(rows: DataFrame, number: int) -> None:
        resolve_persons(rows, forms).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        mentions.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def resolved_so_far(spark, out: str) -> DataFrame | None:
    return spark.read.parquet(out) if exists(spark, out) else None
