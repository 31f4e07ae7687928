from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from textloom.llm import exact_dedup


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    out = []
    for r in rows:
        ids = [i for i in groups[r[1] or ""] if i is not None]
        out.append((r[0], keep(ids) if ids else None, len(groups[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_groups_match_brute_force(docs, awkward, keep):
    found = exact_dedup.exact_groups(docs(awkward), keep=keep).select("id", "keep_id", "n", F.lower(F.hex("digest")))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(awkward, min if keep == "min" else max)


def test_bytes_decide_when_digests_collide(docs, awkward):
    weak = lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 1))  # noqa: E731  16 digests
    found = exact_dedup.exact_groups(docs(awkward), keep="max", digest=weak)
    rows = found.collect()
    assert sorted(((r.id, r.keep_id, r.n) for r in rows), key=repr) == sorted((x[:3] for x in brute(awkward, max)), key=repr)
    assert any(r.collided for r in rows)


def test_one_row_stays_for_each_text(docs, awkward):
    kept = exact_dedup.deduplicate(docs(awkward), keep="max")
    assert kept.columns == docs(awkward).columns
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(t for _, t in got) == sorted({r[1] or "" for r in awkward})
    assert (2, awkward[0][1]) in got


def test_an_identifier_of_several_texts(docs):
    rows = [(5, "a"), (5, "b"), (9, "b"), (None, "b"), (None, "c"), (1, "a")]
    kept = exact_dedup.deduplicate(docs(rows), keep="max")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(5, "a"), (9, "b"), (None, "c")], key=repr)


def test_index_grows_run_by_run(spark, docs, awkward):
    index = exact_dedup.DigestIndex(spark, keep="min")
    rows = docs(awkward).select(exact_dedup.sha256_digest(F.coalesce("text", F.lit(""))).alias("digest"), F.col("doc_id").alias("id"))
    index.flush(rows.where("id <= 4"))
    index.compact()
    index.flush(rows.where("id > 4"))
    merged = {bytes(r.digest): (r.keep_id, r.n) for r in index.compact().collect()}
    want = defaultdict(list)
    for r in awkward:
        if r[0] is not None:
            want[hashlib.sha256((r[1] or "").encode()).digest()].append(r[0])
    assert merged == {k: (min(v), len(v)) for k, v in want.items()}
    probe = spark.createDataFrame([(bytearray(hashlib.sha256(b"one").digest()),), (bytearray(b"none"),)], "digest binary")
    assert sorted((r.keep_id for r in index.lookup(probe).collect()), key=repr) == [6, None]


def test_empty_table(docs):
    assert exact_dedup.exact_groups(docs([])).count() == 0
    assert exact_dedup.deduplicate(docs([])).count() == 0


def test_runs_are_probed_through_their_filters(spark, docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_TABLES", 5)
    built = []
    plain = exact_dedup.DigestIndex

    class Kept(plain):
        def __init__(self, *args):
            super().__init__(*args)
            built.append(self)

    monkeypatch.setattr(exact_dedup, "DigestIndex", Kept)
    rows = [(i, f"text {i % 90}") for i in range(180)] + [(1000 + i, f"alone {i}") for i in range(300)]
    found = exact_dedup.exact_groups(docs(rows), keep="max")
    assert sorted((r.id, r.keep_id, r.n) for r in found.collect()) == sorted(x[:3] for x in brute(rows, max))
    index = built[0]
    asked, passed, there = (sum(x) for x in zip(*index.probed, strict=True))
    assert index.flushed == 5 and len(index.live()) == 1 and index.live()[0].rows == 390
    assert 0 < there <= passed < asked / 2


def test_rows_that_differ_elsewhere_keep_the_first(spark):
    table = spark.createDataFrame([(1, "a", "z"), (1, "a", "b"), (1, "a", "y"), (2, "c", "q")], "doc_id long, text string, source string")
    assert sorted(tuple(r) for r in exact_dedup.deduplicate(table).collect()) == [(1, "a", "b"), (2, "c", "q")]
