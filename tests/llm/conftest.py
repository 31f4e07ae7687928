from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use inside.
CLASHING = ("id", "size", "key", "node", "rep", "digest", "label", "keep_id", "bucket", "h", "n", "score", "copies",
            "__gone", "__of", "__id", "__source", "__copies", "__turn", "__body", "__twins")


@pytest.fixture
def docs(spark):
    """Makes a table of documents from (doc_id, text[, source]) with a column for every clash."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for c in CLASHING:
            df = df.selectExpr("*", f"'x' as {c}")
        return df

    return make


@pytest.fixture
def awkward():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000))
    return [
        (1, "the quick brown fox jumps over the lazy dog"),
        (1, "the quick brown fox jumps over the lazy dog"),
        (2, "the quick brown fox jumps over the lazy dog"),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b\x0c\r "),
        (6, "one"),
        (7, "ONE"),
        (8, long),
        (9, long + " end"),
        (None, "no identifier here at all"),
        (10, "ünïcödé ÀÉ  two   spaces 😀 \x00 end"),
        (11, None, None),
    ]
