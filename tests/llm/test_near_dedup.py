from __future__ import annotations

import random

import numpy as np
import pytest

from textloom.llm import near_dedup
from textloom.llm.components import components


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)])


def brute(rows, k, percent=80):
    sets = [shingles(r[1], k) for r in rows]
    parent = {r[0]: r[0] for r in rows}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                parent[y] = x
    return {r[0]: (len(s), find(r[0])) for r, s in zip(rows, sets, strict=True)}


def family(seed, n, words=120, edits=(0, 30)):
    """Texts around one original, each changed in its own way; some are linked, some are not."""
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    base = [r.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(r.randint(*edits)):
            text[r.randrange(words)] = r.choice(vocabulary)
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_same_components_as_brute_force(docs, words):
    r = random.Random(words)
    texts = family(1, 60) + family(2, 40, 60, (0, 12)) + family(3, 30, 200, (5, 25)) + ["Same Text here now"] * 25 + ["same text HERE now"] * 5
    texts += [t[: len(t) * 3 // 4] for t in family(4, 10, 100, (0, 2))] + [None, "", " \n", "one", "One", "two words"]
    r.shuffle(texts)
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    found = near_dedup.near_groups(docs(rows), words=words)
    got = {x.id: (x.n_shingles, x.component_id) for x in found.collect()}
    assert got == brute(rows, words)


def test_chains_are_joined(docs):
    """Each text is linked with the next, the ends are not linked with each other."""
    base = [f"a{i}" for i in range(100)]
    texts = [" ".join(base[: 100 - 4 * k] + [f"b{i}" for i in range(4 * k)]) for k in range(12)]
    rows = list(enumerate(texts, 1))
    got = {x.id: (x.n_shingles, x.component_id) for x in near_dedup.near_groups(docs(rows), words=2).collect()}
    assert got == brute(rows, 2)
    assert {c for _, c in got.values()} == {1}


def test_awkward_rows(docs, awkward):
    found = near_dedup.near_groups(docs(awkward)).collect()
    assert len(found) == len(awkward)
    comp = {r.id: r.component_id for r in found}
    assert comp[2] == 1 and comp[9] == 8 and comp[7] == 6
    assert all(comp[i] == i for i in (1, 3, 4, 5, 6, 8, 10, 11)) and comp[None] is None
    kept = near_dedup.near_deduplicate(docs(awkward))
    assert kept.columns == docs(awkward).columns
    assert sorted({r.doc_id for r in kept.collect()}, key=repr) == sorted({1, 3, 4, 5, 6, 8, 10, 11, None}, key=repr)


def test_empty_table(docs):
    assert near_dedup.near_groups(docs([])).count() == 0
    assert near_dedup.near_deduplicate(docs([])).count() == 0


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(40):
        common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (300, 60, 60))
        flat = np.concatenate([common, a, common, b])
        sig = near_dedup.min_max(flat, np.array([0, 360]), 80)
        errors.append((sig[0] == sig[1]).mean() - 300 / 420)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.05


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 101), (7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), 100: 100, 101: 100, 103: 100}
