"""Every line of a text reaches the operators on lines, as it is."""

from __future__ import annotations

from collections import Counter

from oracle import SF
from pyspark.sql import functions as F

from textloom.operators import segment
from textloom.plans import adapters as A


def real_lines(spark):
    docs = A.table(spark, SF, "documents").select(F.regexp_extract("source", r"src(\d+)", 1).cast("int").alias("volume"), "text").collect()
    return Counter((d.volume, line) for d in docs for line in d.text.split("\n"))


def test_no_real_line_is_lost(spark):
    real = real_lines(spark)
    got = Counter((r.volume, r.line) for r in A.lines(spark, SF).collect())
    assert not real - got
    assert {"1) note", "", "834—1264."} <= {line for _, line in (got - real)}


def test_real_lines_are_no_headers(spark):
    tagged = segment.tag_lines(A.lines(spark, SF))
    headers = tagged.where("tag = 'page_header'").select("line").distinct().collect()
    assert headers and all(r.line.startswith("- ") for r in headers)
    kinds = {r.tag for r in tagged.select("tag").distinct().collect()}
    assert kinds == {"blank", "page_header", "strict_open", "footnote", "toc_entry", "candidate", "body"}


def test_texts_of_segments_have_all_bodies(spark):
    tagged = segment.tag_lines(A.lines(spark, SF))
    text = "".join(r.text for r in segment.assemble(tagged).select("text").collect())
    assert all(r.line + "\n" in text for r in tagged.where("tag = 'body'").select("line").distinct().collect())
