from __future__ import annotations

import random

import numpy as np
import pytest

from textloom.llm import toxicity

BAD = ["idiot", "worthless", "scumbag", "loser"]
STEMS = ["than", "ering", "thion", "nder", "ble", "ly", "ha", "re", "st", "on"]


def corpus(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(r.choices(STEMS, k=r.randint(1, 3))) for _ in range(r.randint(5, 150))]
        label = int(i % 4 == 0)
        if label:
            for _ in range(max(1, len(words) // 40)):
                words.insert(r.randrange(len(words)), r.choice(BAD))
        rows.append((i, " ".join(words), label))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus(800, 1)
    return toxicity.train([toxicity.bag(t) for _, t, _ in rows], np.array([y for *_, y in rows]))


def test_held_out_accuracy(model):
    rows = corpus(400, 2)
    predicted = np.array([model.score(t) >= 0.5 for _, t, _ in rows])
    truth = np.array([y == 1 for *_, y in rows])
    assert (predicted == truth).mean() > 0.97


def test_unseen_misspellings_share_ngrams(model):
    plain = "than erly onha ndering there on st"
    assert model.score(plain) < 0.5
    for word in ("idiiot", "worthles", "scumbagg", "loserr", "IDIOT,"):
        assert model.score(f"{plain} {word}") > 0.5


def test_long_text_is_read_whole(model, monkeypatch):
    filler = " ".join("".join(random.Random(5).choices(STEMS, k=2)) for _ in range(300))
    text = f"{filler} idiot idiots worthless"
    before = model.score(text)
    monkeypatch.setattr(toxicity, "CHUNK", 97)
    assert model.score(text) == pytest.approx(before)
    assert before > model.score(filler)


def test_fit_and_score(docs, awkward, spark):
    rows = corpus(200, 3)
    table = docs([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    fitted = toxicity.fit(table, labels)
    again = toxicity.fit(table.repartition(5), labels.repartition(3))
    assert np.allclose(fitted.odds, again.odds)
    odd = toxicity.score(docs(awkward), fitted).collect()
    assert len(odd) == len(awkward) and all(0 <= r.score <= 1 for r in odd)
    kept = toxicity.reject(table, fitted)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {r.id for r in toxicity.score(table, fitted).where("score < 0.5").collect()}


def test_sample_is_bounded(docs, spark):
    rows = corpus(120, 4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    assert np.isfinite(toxicity.fit(docs([(i, t) for i, t, _ in rows]), labels, sample_per_class=10).odds).all()


@pytest.mark.parametrize(("labels", "score"), [([], 0.0), ([(1, 0)], 0.0), ([(1, 1)], 1.0)])
def test_without_both_classes(docs, spark, labels, score):
    table = docs([(1, "some text"), (2, None)])
    model = toxicity.fit(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [r.score for r in toxicity.score(table, model).collect()] == pytest.approx([score, score])


def test_empty_table(docs, spark):
    model = toxicity.fit(docs([]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs([]), model).count() == 0


def plain_buckets(text):
    """Distinct n-gram buckets, one n-gram at a time."""
    found = set()
    raw = (text or "").lower().encode("utf-8", "replace")
    codes = [0] + [b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b >= 128 else 0 for b in raw] + [0]
    for n in toxicity.NGRAMS:
        for at in range(len(codes) - n + 1):
            gram = codes[at : at + n]
            if all(gram[1:-1]):
                h = 2166136261 + n
                for c in gram:
                    h = (h ^ c) * 16777619 % 2**32
                h ^= h >> 15
                found.add((h * 0x85EBCA6B % 2**32) >> (32 - toxicity.BUCKETS.bit_length() + 1))
    return found


@pytest.mark.parametrize("text", ["", None, "than IDIOT st", "a", "é ü idiiot, 12 x_y\n\tend", "worthless " * 50])
def test_score_is_the_average_of_embeddings_in_a_softmax(model, text):
    ids = plain_buckets(text)
    assert set(toxicity.bag(text).tolist()) == ids
    average = sum(float(model.odds[i]) for i in ids) / len(ids) if ids else 0.0
    assert model.score(text) == pytest.approx(1 / (1 + np.exp(-(model.bias + average))))


def test_gradients_agree_with_finite_differences():
    rng = np.random.default_rng(0)
    emb, out, bias = rng.normal(size=(12, 3)), rng.normal(size=(3, 2)), rng.normal(size=2)
    ids, sizes = np.array([0, 3, 5, 1, 3, 7, 8, 11]), np.array([3, 1, 4])
    target, weight = np.array([[1.0, 0], [0, 1], [1, 0]]), np.array([0.5, 2.0, 1.5])

    def loss():
        total, at = 0.0, 0
        for n, t, w in zip(sizes, target, weight, strict=True):
            z = np.mean([emb[i] for i in ids[at : at + n]], axis=0) @ out + bias
            total -= w * float(t @ (z - np.log(np.exp(z).sum()))) / len(sizes)
            at += n
        return total

    g_mean, g_out, g_bias = toxicity.gradients(emb, out, bias, ids, sizes, target, weight)
    g_emb = np.zeros_like(emb)
    np.add.at(g_emb, ids, g_mean[np.repeat(np.arange(3), sizes)])
    for param, grad in ((emb, g_emb), (out, g_out), (bias, g_bias)):
        flat, got = param.reshape(-1), grad.reshape(-1)
        for k in range(len(flat)):
            kept, step = flat[k], 1e-6
            flat[k] = kept + step
            above = loss()
            flat[k] = kept - step
            below = loss()
            flat[k] = kept
            assert got[k] == pytest.approx((above - below) / (2 * step), abs=1e-7)
