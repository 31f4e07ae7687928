from __future__ import annotations

import re
from collections import defaultdict

import pytest

from textloom.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(3, 1, 2), percent=150, epochs=2):
    """Water-filling by rounds, in plain numbers."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, full = sum(sizes.values()) * percent / 100, set()
    while True:
        left = goal - sum(epochs * sizes[s] for s in full)
        total = sum(weight[s] for s in order if s not in full)
        share = {s: epochs * sizes[s] if s in full else left / total * weight[s] for s in order} if total else {s: epochs * sizes[s] for s in order}
        above = {s for s in order if s not in full and share[s] >= epochs * sizes[s]}
        if not above:
            return share
        full |= above


def make(n, seed=3):
    import random

    r = random.Random(seed)
    rows = []
    for i in range(n):
        s = "hot" if i % 3 == 0 else r.choice(["a", "b", "é", "z", None, ""])
        rows.append((i, " ".join("w" for _ in range(r.randint(0, 60))) if r.random() > 0.05 else None, s))
    return rows


def test_plan_meets_targets(docs):
    rows = make(900)
    plan = mixing.mix_plan(docs(rows)).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = targets(sizes)
    taken = defaultdict(int)
    for r in plan:
        assert r.size == len(WORD.findall(rows[r.id][1] or "")) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert 0 <= t - taken[s] <= max(2, 0.01 * t)


def test_reruns_agree_whatever_the_partitioning(docs):
    rows = make(300)
    first = {r.id: r.taken for r in mixing.mix_plan(docs(rows)).collect()}
    again = {r.id: r.taken for r in mixing.mix_plan(docs(rows[::-1]).repartition(7)).collect()}
    assert first == again
    other = {r.id: r.taken for r in mixing.mix_plan(docs(rows), seed=18).collect()}
    assert other != first


def test_mix_repeats_rows(docs):
    rows = make(300)
    df = docs(rows)
    copies = {r.id: r.copies for r in mixing.mix_plan(df).collect()}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    seen = defaultdict(int)
    for r in mixed.select("doc_id").collect():
        seen[r.doc_id] += 1
    assert {i: n for i, n in copies.items() if n} == dict(seen)


def test_awkward_rows(docs, awkward):
    plan = mixing.mix_plan(docs(awkward)).collect()
    assert len(plan) == len(awkward)
    assert all(r.taken == 0 for r in plan if r.size == 0)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", "s")]])
def test_tiny_tables(docs, rows):
    plan = mixing.mix_plan(docs(rows)).collect()
    assert len(plan) == len(rows) and mixing.mix(docs(rows)).count() >= 0


def test_texts_of_one_identifier_keep_their_own_copies(docs):
    rows = [(i, " ".join(["w"] * n), "a") for i in range(40) for n in (i % 7 + 1, i % 5 + 50)]
    rows += [(900, "same text twice", "b"), (900, "same text twice", "b")]
    table = docs(rows)
    plan = mixing.mix_plan(table).collect()
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns
    words = sum(len(r.text.split()) for r in mixed.collect())
    assert words == sum(r.taken for r in plan)
