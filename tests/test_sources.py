from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from textloom.operators.resolve import forms_last_wins
from textloom.sources import readers, writers
from textloom.sources.store import Store
from textloom.streaming.incremental import resolve_stream, resolved_so_far


def test_paged_text_and_files(spark, tmp_path):
    for name, text in (("vol10_a.txt", "one\ftwo"), ("vol9_a 2.txt", "x"), ("vol9_a 11.txt", "y")):
        (tmp_path / name).write_text(text)
    pages = readers.read_paged_text(spark, f"file://{tmp_path}/vol10_a.txt").orderBy("page_no").collect()
    assert [(r.page_no, r.text) for r in pages] == [(1, "one"), (2, "two")]
    assert [r.number for r in readers.list_files(spark, f"file://{tmp_path}", "vol9*.txt").collect()] == [2, 11]
    (tmp_path / "vol03_documents.csv").write_text("a\n")
    assert [r.volume for r in readers.discover_volumes(spark, f"file://{tmp_path}").collect()] == [3]


def test_tolerant_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿place_id, Canonical Name ,x\nl1,Nes\nl2,"Ho;lt",3,4\n'.encode())
    got = readers.read_csv(spark, f"file://{tmp_path}/a.csv", ["place_id", "canonical name", "missing"]).orderBy("place_id").collect()
    assert [tuple(r) for r in got] == [("l1", "Nes", ""), ("l2", "Ho;lt", "")]
    assert readers.read_csv_or_empty(spark, f"file://{tmp_path}/none.csv", ["a", "b"]).columns == ["a", "b"]


def test_extractions(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"filename": "f", "persons": [{"name": None}], "date_uncertain": True}, {"_api_error": "x"}]))
    rows = readers.read_extractions(spark, f"file://{tmp_path}/d.json").collect()
    assert rows[0].persons[0].name is None and rows[0].date_uncertain and rows[1]["_api_error"] == "x"
    replies = spark.createDataFrame([('```json\n{"date": "1300"}\n```',), ("sorry",)], "reply string")
    parsed = readers.parse_extractions(replies)
    assert [r.doc.date for r in parsed.collect()] == ["1300", None]
    assert [r[0] for r in parsed.select(readers.is_error()).collect()] == [False, True]


@pytest.mark.parametrize(
    ("text", "ids"),
    [
        ('{"results":[{"id":1,"name":"a"},{"id":2,"name":"b"}]}', [1, 2]),
        ('[{"id":1,"name":"a"}]', [1]),
        ('{"count":9,"results":[{"id":1,"name":"a"},{"id":2,"na', [1]),
        ('{"count":9,"results":[{"id":1,"name":"a","o":{"x":1}},{"id":2,"name":"b"},{"id":3', [1, 2]),
        ("junk {\"id\":1,\"name\":\"a\"} {\"id\":2} {", [1]),
        ("", []), (None, []),
    ],
)
def test_json_repair(text, ids):
    assert [r["id"] for r in readers.repair_json(text)] == ids


def test_gazetteers(spark):
    df = spark.createDataFrame([("{'id': 44, 'nafn': 'Holta hreppur'}", "[{'a': None, 'b': True}]")], "d string, l string")
    assert df.select(readers.literal_name(F.col("d"))).first()[0] == "Holta hreppur"
    assert df.select(readers.literal_list(F.col("l"), "array<struct<a:string,b:boolean>>")).first()[0][0].b is True
    rows = spark.createDataFrame([("Rv..", "A; B;"), ("", "C"), ("D", "")], "abbreviation string, full_names_modern string")
    assert {tuple(r) for r in readers.read_crosswalk(rows).collect()} == {("Rv..", "A"), ("Rv..", "B"), ("Rv", "A"), ("Rv", "B")}
    b = spark.createDataFrame([("Q1", "Nes", "Nesi", 1.0, 2.0), ("Q1", "Nes", "Nes ey", 1.0, 2.0), ("Q2", "x", None, None, 1.0), ("Q3", "y", None, 1.0, 1.0)], "qid string, label string, alt string, lat double, long double")
    assert {r.qid: r.all_labels for r in readers.group_labels(b).collect()} == {"Q1": "Nes|Nes ey|Nesi", "Q3": "y"}


def test_paged_rest():
    pages = {"u?type=x": {"results": [{"id": 1}], "next": "u2"}, "u2": [{"id": 2}, {"id": 3}], "one": {"id": 4}}
    reader = readers.PagedReader({"path": "u", "param.type": "x"}, pages.__getitem__)
    assert [json.loads(r[0])["id"] for r in reader.read(None)] == [1, 2, 3]
    reader = readers.PagedReader({"path": "u2"}, pages.__getitem__)
    assert [json.loads(r[0])["id"] for r in reader.read(None)] == [2, 3]
    loop = readers.PagedReader({"path": "l", "maxpages": "3"}, lambda u: {"results": [{"id": 0}], "next": "l"})
    assert len(list(loop.read(None))) == 3
    assert [json.loads(r[0])["id"] for r in readers.PagedReader({"path": "one"}, pages.__getitem__).read(None)] == [4]


def test_paged_rest_loses_no_page_in_silence():
    def fetch(pages):
        return lambda u: {"results": [{"id": int(u)}], "next": str(int(u) + 1) if int(u) < pages else None}

    read = lambda pages, **options: [json.loads(r[0])["id"] for r in readers.PagedReader({"path": "1"} | options, fetch(pages)).read(None)]
    assert read(200) == list(range(1, 201))
    with pytest.raises(RuntimeError, match="more than 200 pages"):
        read(201)
    assert len(read(201, maxpages="300")) == 201
    with pytest.warns(UserWarning, match="more than 3 pages"):
        assert read(5, maxpages="3") == [1, 2, 3]


def test_writers(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "volume int, seq int, text string")
    writers.write_volumes(rows, f"{root}/t")
    with pytest.raises(FileExistsError):
        writers.write_volumes(rows.where("volume = 1"), f"{root}/t")
    writers.write_volumes(rows.where("volume = 1").withColumn("text", F.lit("new")), f"{root}/t", force=True)
    assert {r.volume: r.text for r in spark.read.parquet(f"{root}/t").collect()} == {1: "new", 2: "b"}
    writers.write_segments(rows, f"{root}/s")
    assert sorted(p.name for p in (tmp_path / "s/texts").glob("segment=*")) == ["segment=seg_01_0001", "segment=seg_02_0001"]
    writers.write_both(rows.withColumn("l", F.array(F.lit(1))), f"{root}/b")
    assert spark.read.csv(f"{root}/b/csv", header=True).count() == spark.read.json(f"{root}/b/json").count() == 2
    writers.write_flagged(rows.limit(0), f"{root}/f")
    writers.create_only(rows, f"{root}/once")
    with pytest.raises(Exception, match="(?i)exists"):
        writers.create_only(rows, f"{root}/once")
    more = writers.append_absent(rows, spark.createDataFrame([(2, "x"), (3, "y")], "volume int, extra string"), "volume")
    assert {(r.volume, r.extra) for r in more.collect()} == {(1, None), (2, None), (3, "y")}


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    with pytest.raises(LookupError):
        store.undo()
    rows = lambda n: spark.range(n)
    store.commit({"a": rows(1), "b": rows(1)}, "first")
    store.commit({"a": rows(2)}, "second")
    store.commit({"a": store.read("a").union(rows(3))}, "third")
    assert store.read("a").count() == 5 and store.read("b").count() == 1
    assert store.undo() == "third" and store.read("a").count() == 2
    assert store.undo() == "second" and store.read("a", cached=True).count() == 1
    store.commit({"a": rows(9)}, "fourth")
    assert store.read("a", cached=True).count() == 9 and store.prune() == 2
    assert store.undo() == "fourth" and store.read("a").count() == 1


def test_stream(spark, tmp_path):
    authority = spark.createDataFrame([(1, "Jon Holt", "")], "pk long, canonical_name string, variant_names string")
    mentions = spark.createDataFrame([(1, 0, "jon holt"), (1, 1, "zz")], "doc long, ordinal int, name string")
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    assert resolved_so_far(spark, out) is None
    for _ in range(2):
        mentions.write.mode("append").parquet(source)
        stream = spark.readStream.schema(mentions.schema).parquet(source)
        resolve_stream(stream, forms_last_wins(authority), out, state).awaitTermination()
    got = resolved_so_far(spark, out)
    assert got.count() == 4 and got.where("band = 'accept'").count() == 2
