from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textloom.operators import lookups


def test_scans(spark):
    people = spark.createDataFrame([(2, "canonical", 1, ""), (1, "canonical", 2, "ok"), (3, "provisional", 1, "")], "pk long, status string, source_volume int, review_status string")
    assert [r.pk for r in lookups.scan_entities(people).collect()] == [1, 2, 3]
    assert [r.pk for r in lookups.scan_entities(people, status="canonical", review_status="").collect()] == [2]
    docs = spark.createDataFrame([(1, 2, 0, 0, 0), (1, 1, 1, 0, 0), (0, 9, 0, 0, 1)], "volume int, sequence int, has_review_persons int, has_review_places int, has_parse_error int")
    counts = {h: [r.sequence for r in lookups.scan_documents(docs, h).collect()] for h in (None, True, False)}
    assert counts == {None: [9, 1, 2], True: [9, 1], False: [2]}


def test_new_keys(spark):
    rows = spark.createDataFrame([(2, "a"), (1, "c"), (1, "b"), (None, "d")], "volume int, n string")
    used = spark.createDataFrame([(7,), (3,)], "pk long")
    assert {r.n: r.pk for r in lookups.with_new_keys(rows, used, ["n"]).collect()} == {"d": 8, "b": 9, "c": 10, "a": 11}
    assert {r.n: r.pk for r in lookups.with_new_keys(rows, used.limit(0), ["n"]).collect()}["d"] == 1


@pytest.mark.parametrize(("ref", "want"), [("REVIEW:p12", ("pending_review", "p12")), ("p1", ("resolved", "p1")), (" ", ("new", None)), (None, ("new", None))])
def test_classify_reference(spark, ref, want):
    got = spark.createDataFrame([(ref,)], "r string").select(lookups.classify_reference(F.col("r")).alias("x")).first().x
    assert (got.state, got.legacy_id) == want


def test_small_tables(spark):
    rows = spark.createDataFrame([("l1", "Nes ", ""), ("l1", "Holt", "x")], "place_id string, canonical_name string, other string")
    splits = spark.createDataFrame([("l1", "nes", "l1a")], "old_id string, disambiguator string, new_display_id string")
    assert sorted(r.place_id for r in lookups.split_identifiers(rows, splits).collect()) == ["l1", "l1a"]
    named = lookups.renamed(rows, {"id": "place_id", "name": ("other", "canonical_name")})
    assert sorted(tuple(r) for r in named.collect()) == [("l1", "Nes "), ("l1", "x")]
    gate = spark.createDataFrame([(" OK ",), ("skip",), (None,)], "s string").select(lookups.may_export(F.col("s")))
    assert [r[0] for r in gate.collect()] == [True, False, True]
    label = spark.createDataFrame([(None,), (4,)], "v int").select(lookups.source_label(F.col("v")))
    assert [r[0] for r in label.collect()] == ["authority", "vol04"]


def test_suggestions(spark):
    forms = spark.createDataFrame([("jon holt", 1), ("anna", 2)], "form string, pk long")
    items = spark.createDataFrame([(1, "holt jon"), (2, "ann"), (3, "")], "item_id long, name string")
    got = {r.item_id: (r.pk, r.suggestion) for r in lookups.suggest(items, forms).collect()}
    assert got == {1: (1, "merge"), 2: (2, "add"), 3: (None, "add")}


def test_extraction_hook(spark):
    segments = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "filename string, text string")
    done = spark.createDataFrame([("a", None), ("b", "failed")], "filename string, error string")

    def upper(frames):
        for f in frames:
            yield pd.DataFrame({"filename": f.filename, "reply": f.text.str.upper()})

    assert {r.filename: r.reply for r in lookups.extract(segments, upper, done).collect()} == {"b": "Y", "c": "Z"}


def test_marked_changes():
    assert lookups.mark_changes("Nes <", "Nesi <") == ("Nes &lt;", "Nes<mark>i</mark> &lt;")
    assert lookups.mark_changes(None, "x") == ("", "<mark>x</mark>")
