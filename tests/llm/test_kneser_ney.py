from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs as pafs
import pytest

from textloom.llm import kneser_ney as kn


class Plain:
    """The same model in dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.count = [None] + [Counter() for _ in range(order)]
        for t in texts:
            for g in self.grams(self.tokens(t), order):
                self.count[order][g] += 1
        self.raw = Counter()
        for g, c in self.count[order].items():
            self.raw[g[-1]] += c
        for k in range(order - 1, 0, -1):
            for g in self.count[k + 1]:
                self.count[k][g[1:]] += 1
        self.discount, self.total, self.kinds = {}, {}, {}
        for k in range(1, order + 1):
            of = Counter(self.count[k].values())
            self.discount[k] = kn.discounts(of[1], of[2], of[3], of[4])
            self.total[k], self.kinds[k] = Counter(), defaultdict(lambda: [0, 0, 0])
            for g, c in self.count[k].items():
                self.total[k][g[:-1]] += c
                self.kinds[k][g[:-1]][min(c, 3) - 1] += 1
        self.known, self.n = len(self.raw), sum(self.raw.values())

    @staticmethod
    def tokens(text):
        return (text or "").encode().lower().split() + [b"\n"]

    @staticmethod
    def grams(tokens, order):
        padded = [b""] * (order - 1) + tokens
        return [tuple(padded[k - order + 1 : k + 1]) for k in range(order - 1, len(padded))]

    def p(self, k, g):
        if not k:
            return 1 / (self.known + 1)
        low, ctx = self.p(k - 1, g[1:]), g[:-1]
        if not self.total[k][ctx]:
            return low
        c, d = self.count[k].get(g, 0), self.discount[k]
        spare = sum(a * b for a, b in zip(d, self.kinds[k][ctx], strict=True)) / self.total[k][ctx]
        return max(c - (d[min(c, 3) - 1] if c else 0), 0) / self.total[k][ctx] + spare * low

    def score(self, text):
        return sum(math.log10(self.p(self.order, g)) for g in self.grams(self.tokens(text), self.order))

    def base(self, text):
        return sum(math.log10((self.raw[w] + 1) / (self.n + self.known + 1)) for w in self.tokens(text))


TEXTS = [
    "the cat sat on the mat", "the cat sat on the hat", "a dog sat on the mat and the cat sat", "The CAT ran", "", None, "é è é ü é",
    "on the mat the dog sat on the cat", "one", "one two three four one two three", "x " * 200, "the the the the cat cat cat",
]


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("shard_chars", [20, 10**9])
def test_matches_dictionaries(docs, order, shard_chars):
    table = docs(list(enumerate(TEXTS)))
    model = kn.fit(table.where("doc_id % 5 <> 2"), order=order, shard_chars=shard_chars)
    plain = Plain([t for i, t in enumerate(TEXTS) if i % 5 != 2], order)
    assert (model.tokens, model.known) == (plain.n, plain.known)
    got = {r.id: r for r in kn.score(table, model).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        assert got[i].n_tokens == len(plain.tokens(text))
        assert got[i].n_known == sum(plain.raw[w] > 0 for w in plain.tokens(text))
        assert got[i].score == pytest.approx(plain.score(text))
        assert got[i].base_score == pytest.approx(plain.base(text))
        assert got[i].perplexity == pytest.approx(10 ** (-plain.score(text) / len(plain.tokens(text))))


def test_probabilities_sum_to_one(docs):
    table = docs(list(enumerate(TEXTS)))
    model, plain = kn.fit(table, order=2), Plain(TEXTS, 2)
    hash_of = lambda w: kn.EOS if w == b"\n" else kn.Words()(w.decode())[0]
    words = np.sort(np.array([hash_of(w) for w in plain.raw] + [12345], np.uint64))
    _, p1 = model.words(words)
    for context in (b"the", b"cat", b"on", b"never seen"):
        ctx = kn.context_hash([np.full(len(words), hash_of(context.replace(b" ", b"")), np.uint64)])
        direct, spare = model.grams(2, ctx, words)
        assert (direct + spare * p1).sum() == pytest.approx(1)


def test_chunks_change_nothing(docs, monkeypatch):
    table = docs(list(enumerate(TEXTS)))
    whole = {r.id: r.score for r in kn.score(table, kn.fit(table)).collect()}
    counts = list(kn._count(2, 3)(iter([])))
    assert counts == []
    shards = []
    monkeypatch.setattr(kn, "COUNT_TOKENS", 5)
    import pyarrow as pa

    for batch in kn._count(2, 2)(iter([pa.RecordBatch.from_arrays([pa.array(TEXTS)], names=["text"])])):
        shards += [kn._unblock(b.as_py()) for b in batch.column(1)]
    assert sum(int(c[0].sum()) for _, c in shards) == sum(len(Plain.tokens(t)) for t in TEXTS)
    assert len(whole) == len(TEXTS)


def test_awkward_rows_and_no_training(docs, awkward):
    table = docs(awkward)
    scored = kn.score(table, kn.fit(table.where("false"))).collect()
    assert len(scored) == len(awkward) and all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in scored)
    again = kn.score(table, kn.fit(table)).collect()
    assert len(again) == len(awkward) and all(math.isfinite(r.score) and r.score <= 0 for r in again)
    assert kn.score(docs([]), kn.fit(docs([]))).count() == 0


def test_files_in_a_store_without_local_paths(tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    arrays = [np.array([1, 5, 9], np.uint64), np.array([2, 1, 7], np.uint64), np.array([4, 4, 5], np.uint32)]
    kn._save(root, "words-0", arrays)
    monkeypatch.setattr(kn.pafs, "LocalFileSystem", type("Other", (), {}))
    kn._MAPPED.clear()
    got = kn._mapped(root, "words-0", kn.WORD_FILE)
    assert [g.tolist() for g in got] == [a.tolist() for a in arrays]
    assert pafs.FileSystem.from_uri(root)[0].get_file_info(str(tmp_path / "words-0")).size % 8 == 0
    kn._MAPPED.clear()


def test_a_lost_file_is_an_error(docs):
    import os

    table = docs(list(enumerate(TEXTS)))
    model = kn.fit(table, shard_chars=10**9)
    files = [f for f in os.listdir(model.root.removeprefix("file://")) if f.startswith("grams2")]
    os.remove(f"{model.root.removeprefix('file://')}/{files[0]}")
    kn._MAPPED.clear()
    with pytest.raises(Exception, match="is lost"):
        kn.score(table, model).collect()


def test_paths_are_qualified_by_hadoop(spark, tmp_path):
    from textloom.llm.shared import worker_uri

    assert worker_uri(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert worker_uri(spark, f"file:{tmp_path}") == f"file://{tmp_path}"


def test_fetched_copies_are_bounded(tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    for k in range(6):
        kn._save(root, f"words-{k}", [np.arange(100, dtype=np.uint64)] * 2 + [np.arange(100, dtype=np.uint32)])
    monkeypatch.setattr(kn.pafs, "LocalFileSystem", type("Other", (), {}))
    monkeypatch.setattr(kn, "FETCHED", 5000)
    monkeypatch.setattr(kn, "_FETCHED", 0)
    kn._MAPPED.clear()
    for k in range(6):
        assert len(kn._mapped(root, f"words-{k}", kn.WORD_FILE)[0]) == 100
        assert len(kn._MAPPED) <= 2
    kn._MAPPED.clear()
