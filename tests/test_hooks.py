"""Hooks that fail, exports of names, and the guard of the driver's entry."""

from __future__ import annotations

import pandas as pd
import pytest

from textloom.operators import segment
from textloom.sources import writers


def contexts(spark):
    rows = [(1, p, f"line {p}", "", "", "") for p in range(6)]
    return spark.createDataFrame(rows, "volume int, pos long, line string, context_before string, context_after string, container_header string")


def test_a_failing_classifier_leaves_candidates_uncertain(spark):
    def broken(frames):
        raise RuntimeError("no answer")
        yield

    got = segment.classify_candidates(contexts(spark), broken).collect()
    assert sorted((r.pos, r["class"]) for r in got) == [(p, "uncertain") for p in range(6)]


def test_a_classifier_may_leave_candidates_out(spark):
    def some(frames):
        for f in frames:
            f = f[f["pos"] % 2 == 0]
            yield pd.DataFrame({"volume": f["volume"], "pos": f["pos"], "class": "new_charter", "correction": ""})

    classes = segment.classify_candidates(contexts(spark), some)
    assert sorted((r.pos, r["class"]) for r in classes.collect()) == [(p, "new_charter" if p % 2 == 0 else "uncertain") for p in range(6)]
    tagged = spark.createDataFrame([(1, 1, p, f"line {p}", "candidate") for p in range(6)], "volume int, page_no long, pos long, line string, tag string")
    assert segment.assemble(tagged, classes, opening="new_charter").count() == 3
    assert segment.assemble(tagged, classes).count() == 0


@pytest.mark.parametrize("slice_lines", [1, 2, 7, 4096])
def test_slices_change_nothing(spark, monkeypatch, slice_lines):
    lines = [(v, n // 10, n, "834." if n % 11 == 5 else "" if n % 7 == 3 else f"Text {n}") for v in (1, None) for n in range(60)]
    table = spark.createDataFrame(lines, "volume int, page_no long, pos long, line string")
    monkeypatch.setattr(segment, "SLICE", 10**6)
    tagged = segment.tag_lines(table).cache()
    whole = [sorted(map(tuple, f(tagged).collect()), key=repr) for f in (segment.assemble, segment.candidate_context)]
    monkeypatch.setattr(segment, "SLICE", slice_lines)
    assert whole == [sorted(map(tuple, f(tagged).collect()), key=repr) for f in (segment.assemble, segment.candidate_context)]
    assert whole[0]


def test_names_are_written_with_all_columns(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a; b")], "charter_id string, persons_by_role string")
    writers.write_names(rows, f"file://{tmp_path}/names")
    back = spark.read.option("header", True).csv(f"file://{tmp_path}/names")
    assert back.columns == writers.NAME_COLUMNS and back.first().persons_by_role == "a; b"
