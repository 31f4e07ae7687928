"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A text is the bag of its words' character n-grams (in UTF-8 bytes, with a mark at either end of
the word), each hashed to one of ``BUCKETS`` embeddings. The average over the bag's distinct
buckets goes through a linear softmax with two classes; embeddings and softmax weights are learned
together. Counting a bucket once keeps frequent function words from drowning a few telling words
in a long text. A misspelling that was never seen still shares most n-grams with the word that was.

Training takes a bounded sample: of each class, the ``SAMPLE_PER_CLASS`` labelled rows with the
smallest hashed identifiers. Executors reduce those texts, whole, to their buckets; the driver
holds these and the model (fixed size). As average and softmax are linear, what a bucket adds to
the log odds is one number, so workers score a text by one gather over its buckets. The model is
closed over by the scoring task: one float for each bucket, whatever the input's size.

Defined results: null and empty texts, and texts without letters or digits, have an empty bag
and get the model's bias as log odds. Without labels of both classes the score is the share of
label 1 (0 without any). Rows whose label is null are not learned from; a row labelled twice is
learned from with its larger label. Repeated rows are scored alike; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import ensure_columns, tidy

BUCKETS = 1 << 17
DIMENSIONS = 8
NGRAMS = (3, 4, 5)
#: Labelled rows of either class that are learned from, at most.
SAMPLE_PER_CLASS = 2_500
#: Bytes of a text whose n-grams are hashed at once.
CHUNK = 1 << 21

_KEEP = np.zeros(256, np.uint8)
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _KEEP[_b] = _b


def _pieces(text: str) -> Iterator[bytes]:
    """The lower-cased text, cut between words into pieces of about CHUNK bytes."""
    raw = text.lower().encode("utf-8", "replace")
    at = 0
    while len(raw) - at > CHUNK:
        end = max(raw.rfind(b" ", at, at + CHUNK), raw.rfind(b"\n", at, at + CHUNK))
        end = at + CHUNK if end <= at else end
        yield raw[at:end]
        at = end
    yield raw[at:]


def bucket_ids(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of a text's n-grams, with repetitions, piece by piece."""
    for piece in _pieces(text or ""):
        codes = np.empty(len(piece) + 2, np.uint32)
        codes[0] = codes[-1] = 0
        codes[1:-1] = _KEEP[np.frombuffer(piece, np.uint8)]
        word = codes != 0
        for n in NGRAMS:
            m = len(codes) - n + 1
            if m <= 0:
                continue
            inside = word[1 : 1 + m].copy()
            for k in range(2, n - 1):
                inside &= word[k : k + m]
            at = np.flatnonzero(inside)
            h = np.full(len(at), 2166136261 + n, np.uint32)
            for k in range(n):
                h = (h ^ codes[at + k]) * np.uint32(16777619)
            h ^= h >> np.uint32(15)
            yield (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def bag(text: str | None, seen: np.ndarray | None = None) -> np.ndarray:
    """A text's distinct buckets, sorted. ``seen``: BUCKETS booleans, all false, to use again."""
    seen = np.zeros(BUCKETS, bool) if seen is None else seen
    for ids in bucket_ids(text):
        seen[ids] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found.astype(np.int32)


@dataclass(frozen=True)
class Model:
    """``odds``: what one n-gram of each bucket adds to the log odds, before averaging."""

    odds: np.ndarray
    bias: float

    def score(self, text: str | None, seen: np.ndarray | None = None) -> float:
        ids = bag(text, seen)
        logit = self.bias + (float(self.odds[ids].mean(dtype=np.float64)) if len(ids) else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500))))


def gradients(
    emb: np.ndarray, out: np.ndarray, bias: np.ndarray, ids: np.ndarray, sizes: np.ndarray, target: np.ndarray, weight: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the batch's mean weighted cross-entropy, by each text's average embedding (divided by its
    size: what each of its n-grams gets), by the softmax weights and by the bias. ``ids`` has the
    texts' n-grams end to end."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mean = np.add.reduceat(emb[ids], starts, axis=0) / sizes[:, None].astype(emb.dtype)
    logits = mean @ out + bias
    logits -= logits.max(1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(1, keepdims=True)
    err = (p - target) * weight[:, None] / len(sizes)
    return err @ out.T / sizes[:, None], mean.T @ err, err.sum(0)


def train(
    bags: list[np.ndarray],
    labels: np.ndarray,
    epochs: int = 12,
    rate: float = 0.3,
    batch: int = 64,
    decay: float = 1e-5,
    seed: int = 5,
) -> Model:
    """Joint Adagrad steps on embeddings, softmax weights and bias; classes weigh alike."""
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(BUCKETS, np.float32), 500.0 if share else -500.0)
    rng = np.random.default_rng(seed)
    emb = ((rng.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS).astype(np.float32)
    out = ((rng.random((DIMENSIONS, 2)) - 0.5) / DIMENSIONS).astype(np.float32)
    bias = np.zeros(2, np.float32)
    sums = [np.full_like(emb, 1e-8), np.full_like(out, 1e-8), np.full_like(bias, 1e-8)]
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    target = np.stack([1 - labels, labels], 1).astype(np.float32)
    filled = np.array([i for i, ids in enumerate(bags) if len(ids)])
    for epoch in range(epochs):
        order, step = rng.permutation(filled), rate * (1 - epoch / epochs) + 1e-3
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            ids = np.concatenate([bags[i] for i in rows])
            sizes = np.array([len(bags[i]) for i in rows])
            g_mean, g_out, g_bias = gradients(emb, out, bias, ids, sizes, target[rows], weight[rows])
            grads = (None, g_out + decay * out, g_bias)
            for param, acc, g in ((out, sums[1], grads[1]), (bias, sums[2], grads[2])):
                acc += g * g
                param -= step * g / np.sqrt(acc)
            used, place = np.unique(ids, return_inverse=True)
            owner = np.repeat(np.arange(len(rows)), sizes)
            g_emb = np.empty((len(used), DIMENSIONS), np.float32)
            for d in range(DIMENSIONS):
                g_emb[:, d] = np.bincount(place, g_mean[owner, d], len(used))
            g_emb += decay * emb[used]
            sums[0][used] += g_emb * g_emb
            emb[used] -= step * g_emb / np.sqrt(sums[0][used])
    odds = emb @ (out[:, 1] - out[:, 0])
    return Model(odds.astype(np.float32), float(bias[1] - bias[0]))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = pa.array([bag(batch.column(2)[i].as_py()).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), ids], names=["id", "label", "ids"]
            )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_per_class: int = SAMPLE_PER_CLASS,
) -> Model:
    """``labels``: the rows that may be learned from. Every text of a labelled identifier is
    learned once (copies of one text under one identifier count once); an identifier with both
    labels is toxic. The sample is bounded in identifiers, see ``sample_per_class``."""
    ensure_columns(docs, id_col, text_col)
    ensure_columns(labels, id_col, label_col)
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    drawn = [known.where(f"label = {y}").orderBy(F.xxhash64("id"), "id").limit(sample_per_class) for y in (0, 1)]
    sample = drawn[0].unionAll(drawn[1])  # bounded: two times sample_per_class rows
    rows = texts.join(F.broadcast(sample), "id").select("id", "label", "text")
    got = rows.mapInArrow(tidy(_bags), "id long, label int, ids binary").toPandas()
    got = got.drop_duplicates().sort_values(["id", "ids"])
    bags = [np.frombuffer(ids, np.int32) for ids in got["ids"]]
    return train(bags, got["label"].to_numpy(np.int64))


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            scores = [model.score(t.as_py(), seen) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: id, score (probability of label 1)."""
    ensure_columns(docs, id_col, text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(tidy(_scores(model)), "id long, score double")


def _passing(model: Model, threshold: float, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, bool)
        for batch in batches:
            yield batch.filter(pa.array([model.score(t.as_py(), seen) < threshold for t in batch.column(at)], pa.bool_()))

    return run


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    ensure_columns(docs, text_col)
    return docs.mapInArrow(tidy(_passing(model, threshold, docs.columns.index(text_col))), docs.schema)
