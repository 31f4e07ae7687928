"""Writing results: per-volume tables, CSV and JSON, and one file per segment on demand."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.export import NAME_COLUMNS


def write_volumes(df: DataFrame, path: str, force: bool = False) -> None:
    """Partitioned by volume. A volume that is there already is refused, or replaced if forced;
    other volumes stay."""
    spark = df.sparkSession
    if not force and exists(spark, path):
        there = spark.read.parquet(path).select("volume").distinct()
        again = df.select("volume").distinct().join(there, "volume", "left_semi").limit(1).count()
        if again:
            raise FileExistsError(f"{path} already has a volume of these rows")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("volume").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """With a header; further columns are left out, arrays are written as JSON."""
    df = df.select(*columns) if columns else df
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_names(rows: DataFrame, path: str) -> None:
    """The flat export of documents with names (see ``export.name_rows``); what a row lacks is empty."""
    have = set(rows.columns)
    write_csv(rows.select(*[(F.col(c) if c in have else F.lit("")).alias(c) for c in NAME_COLUMNS]), path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_both(df: DataFrame, path: str) -> None:
    write_json(df, f"{path}/json")
    write_csv(df, f"{path}/csv")


def write_flagged(df: DataFrame, path: str) -> None:
    """Replaces what an earlier run flagged; nothing flagged clears it."""
    write_csv(df, path)


def create_only(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def append_absent(existing: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Rows of ``fresh`` whose key isn't there are added; columns that either lacks are null."""
    return existing.unionByName(fresh.join(existing.select(key), key, "left_anti"), allowMissingColumns=True)


def append_checkpointed(df: DataFrame, path: str) -> None:
    """Appends: each call's rows are there whatever happens to later calls."""
    df.write.mode("append").parquet(path)


def write_segments(segments: DataFrame, path: str) -> None:
    """One text per segment, in a folder of its own name, beside the index."""
    named = segments.withColumn("segment", F.format_string("seg_%02d_%04d", F.col("volume").cast("int"), F.col("seq").cast("int")))
    named.select("segment", "text").write.mode("overwrite").partitionBy("segment").text(f"{path}/texts")
    write_csv(named.drop("text"), f"{path}/index")


def write_sheets(tables: dict[str, DataFrame], path: str) -> None:
    """A workbook with a sheet for each table; sheets of an earlier one that no table replaces are
    carried over. Needs a spreadsheet engine for pandas; a workbook is written by the driver."""
    import pandas as pd

    try:
        sheets = pd.read_excel(path, sheet_name=None) if os.path.exists(path) else {}
        sheets |= {name: df.toPandas() for name, df in tables.items()}
        with pd.ExcelWriter(path) as book:
            for name, frame in sheets.items():
                frame.to_excel(book, sheet_name=name, index=False)
    except ImportError as e:
        raise RuntimeError("writing workbooks needs an engine for pandas.ExcelWriter") from e
