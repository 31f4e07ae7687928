from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import warc
from textloom.llm.asof import latest_before

KINDS = {"record_id": T.LongType(), "kind": T.StringType(), "url": T.StringType(), "date": T.LongType(), "status": T.IntegerType(), "headers": T.StringType(), "body": T.StringType()}
SCHEMA = T.StructType([T.StructField(k, v) for k, v in KINDS.items()])


def resolve(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as canonical", "'y' as found", "'z' as merged", "1 as full")
    return {r.record_id: r for r in warc.resolve_revisits(df).collect()}


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTP://WWW.Example.com:80/A/b/?b=2&a=1&#frag", "example.com/A/b?a=1&b=2"),
        ("https://user:pw@example.com/", "example.com"),
        ("example.com?", "example.com"),
        ("https://m.example.com:8443/x//", "m.example.com:8443/x"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_urls(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0] == want


def test_validators_and_headers(spark):
    full = 'ETag: "a"\r\nContent-Type: text/html\nSet-Cookie: x=1\r\nSet-Cookie: y=2\r\nCache-Control: max-age=1\r\nbroken line'
    rows = [
        (1, "response", "http://e.org/p", 100, 200, full, "one"),
        (2, "response", "http://e.org/p", 300, 200, 'Last-Modified: Mon\nETag: "b"', "two"),
        (3, "response", "http://e.org/p", 350, 404, 'ETag: "c"', "gone"),
        (10, "revisit", "https://www.e.org/p#x", 200, 304, 'etag: W/"a"\nCache-Control: max-age=9\nContent-Length: 0', None),
        (11, "revisit", "http://e.org/p", 400, 304, 'ETag: "a"', None),
        (12, "revisit", "http://e.org/p", 400, 304, "Last-Modified: Mon", None),
        (13, "revisit", "http://e.org/p", 400, 304, None, None),
        (14, "revisit", "http://e.org/p", 100, 304, 'ETag: "a"', None),
        (15, "revisit", "http://e.org/other", 900, 304, 'ETag: "a"', None),
        (16, "revisit", None, 900, 304, 'ETag: "a"', None),
        (17, "revisit", "http://e.org/p", None, 304, 'ETag: "a"', None),
        (18, None, None, None, None, None, None),
    ]
    got = resolve(spark, rows)
    assert len(got) == len(rows)
    assert {i: (r.outcome, r.source_id, r.content) for i, r in got.items() if i >= 10} == {
        10: ("resolved", 1, "one"), 11: ("mismatch", None, None), 12: ("resolved", 2, "two"), 13: ("unverified", 2, "two"),
        14: ("missing", None, None), 15: ("missing", None, None), 16: ("missing", None, None), 17: ("missing", None, None),
        18: ("other", 18, None),
    }
    assert [(h.name, h.value) for h in got[10].merged] == [
        ("content-type", "text/html"), ("set-cookie", "x=1"), ("set-cookie", "y=2"), ("etag", 'W/"a"'), ("cache-control", "max-age=9")
    ]
    assert got[1].outcome == "full" and got[1].content == "one" and got[3].outcome == "other"


def test_many_revisits_of_one_url_match_brute_force(spark):
    r = random.Random(1)
    rows = []
    for i in range(400):
        kind = r.choice(["response", "revisit", "revisit"])
        rows.append((i, kind, f"http://e.org/{'hot' if i % 3 else i % 5}", r.randrange(0, 900_000, 1000), 200 if kind == "response" else 304, None, f"body{i}"))
    got = resolve(spark, rows)
    for i, kind, url, date, *_ in rows:
        if kind == "revisit":
            earlier = [(x[3], x[0]) for x in rows if x[1] == "response" and x[2] == url and x[3] < date]
            assert got[i].source_id == (max(earlier)[1] if earlier else None)
            assert got[i].content == (f"body{max(earlier)[1]}" if earlier else None)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_as_of_in_any_slices(spark, width):
    r = random.Random(width)
    rows = [(r.choice("ab"), r.randrange(60), r.choice([None, 1, 2, 3])) for _ in range(200)]
    events = spark.createDataFrame(rows, "k string, t long, v int")
    found = latest_before(events, ["k"], "t", F.when(F.col("v").isNotNull(), F.struct("v")), width).collect()
    assert len(found) == len(rows)
    for row in found:
        earlier = [(t, v) for k, t, v in rows if k == row.k and t < row.t and v is not None]
        assert (row.found.v if row.found else None) == (max(earlier)[1] if earlier else None)


def test_repeated_and_empty(spark):
    assert resolve(spark, []) == {}
    row = (1, "response", "http://e.org/p", 100, 200, "ETag: a", "one")
    again = (2, "revisit", "http://e.org/p", 200, 304, "ETag: a", None)
    df = spark.createDataFrame([row, row, again, again], SCHEMA)
    assert sorted((r.record_id, r.content) for r in warc.resolve_revisits(df).collect()) == [(1, "one"), (1, "one"), (2, "one"), (2, "one")]
