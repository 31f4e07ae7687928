"""Every stage against plain code, on its own input."""

from __future__ import annotations

import sentencepiece
from oracle import SF
from test_mixing import WORD, targets
from test_near_dedup import brute

import corpus_pipeline
from textloom.llm import pieces
from textloom.llm.shared import documents


def run_stage(spark, docs, at):
    return corpus_pipeline.STAGES[at][1](spark, docs, SF)


def test_stages_in_turn(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    clean = run_stage(spark, docs, 0).cache()
    assert clean.columns == columns
    before, after = {r.doc_id for r in docs.collect()}, {r.doc_id for r in clean.collect()}
    assert after < before and len(after) > 0.6 * len(before)
    assert len(toxic - after) > len(toxic & after)

    single = run_stage(spark, clean, 1).cache()
    assert single.columns == columns
    largest = {}
    for r in clean.collect():
        largest[r.text] = max(largest.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in single.collect()) == sorted(largest.values())

    apart = run_stage(spark, single, 2).cache()
    assert apart.columns == columns
    groups = brute([(r.doc_id, r.text) for r in single.collect()], 5)
    assert sorted(r.doc_id for r in apart.collect()) == sorted({c for _, c in groups.values()})

    mixed = run_stage(spark, apart, 3).cache()
    assert mixed.columns == columns
    size, taken, seen = {}, {}, {}
    for r in apart.collect():
        size[r.source] = size.get(r.source, 0) + len(WORD.findall(r.text))
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + len(WORD.findall(r.text))
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    longest = max(len(WORD.findall(r.text)) for r in apart.collect())
    assert max(seen.values()) <= 2
    for s, t in targets(size).items():
        assert 0 <= t - taken.get(s, 0) <= longest

    encoded = run_stage(spark, mixed, 4).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    text = {r.doc_id: r.text for r in mixed.collect()}
    assert sorted(r.doc_id for r in encoded) == sorted(r.doc_id for r in mixed.collect())
    assert all(list(r.piece_ids) == library.encode(text[r.doc_id]) and r.round_trip for r in encoded[:60])


def test_run_applies_all(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0 and {"doc_id", "piece_ids"} <= set(found.columns)


def test_empty_documents(spark):
    docs = documents(spark, SF).limit(0)
    for at in range(5):
        docs = run_stage(spark, docs, at)
    assert docs.count() == 0
