from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
import sentencepiece

from textloom.llm import pieces

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def odd_texts(n, seed=1):
    r = random.Random(seed)
    bits = [" ", "  ", "\n", "a", "e", "th", "the", "ing", "é", "ü", "😀", "\x00", "<0x41>", "▁", "中", "   ", "in", "1", ".", "aaaa", "<s>", "\t", "ⴰ"]
    return ["".join(r.choices(bits, k=r.randint(0, 40))) for _ in range(n)]


def test_same_pieces_as_the_library(vocabulary):
    encoder, decode = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    texts = odd_texts(600) + ["The quick brown fox.", " leading and trailing ", "a" * 300, "ab" * 200, ""]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == LIBRARY.encode(text)
        assert decode(ids) == LIBRARY.decode(ids.tolist())


def test_round_trip(docs, awkward, spark, vocabulary):
    rows = awkward + [(100 + i, t) for i, t in enumerate(odd_texts(80, 2))]
    encoded = pieces.encode(docs(rows), vocabulary)
    got = encoded.collect()
    assert len(got) == len(rows)
    by_id = {r.id: r for r in got}
    for i, text, *_ in rows:
        text = text or ""
        assert by_id[i].n_pieces == len(by_id[i].ids) == len(LIBRARY.encode(text))
        assert by_id[i].round_trip == ("▁" not in text)
    decoded = {r.id: r.text for r in pieces.decode(encoded, vocabulary).collect()}
    assert all(decoded[i] == (t or "").replace("▁", " ") for i, t, *_ in rows if "▁" not in (t or ""))


def test_prefixes_are_shared(vocabulary):
    encoder = pieces.Encoder(vocabulary)
    steps = 0
    walk = encoder._walk_bpe

    def counted(word, shared, states):
        nonlocal steps
        steps += len(word) - shared
        return walk(word, shared, states)

    encoder._walk_bpe = counted
    words = {"▁inter", "▁internal", "▁international", "▁internationally"}
    encoder.learn(words)
    assert steps == len("▁internationally") + 1  # and the last letter of "▁internal"


def best_split(word, scores, floor):
    best = None
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[start:i])
                start = i
        parts.append(word[start:])
        if all(p in scores or len(p) == 1 for p in parts):
            total = sum(scores.get(p, floor) for p in parts)
            best = total if best is None else max(best, total)
    return best


def test_unigram_viterbi_matches_all_segmentations():
    r = random.Random(3)
    names = ["<unk>", "▁", *"abc", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab", "aa", "▁c"]
    scores = [0.0] + [-r.uniform(1, 9) for _ in names[1:]]
    v = pieces.Vocabulary(names, scores, [2] + [1] * (len(names) - 1), pieces.UNIGRAM)
    encoder = pieces.Encoder(v)
    words = {"▁" + "".join(r.choices("abcz", k=r.randint(0, 9))) for _ in range(200)}
    encoder.learn(words)
    known = {n: s for n, s in zip(names, scores, strict=True) if n != "<unk>"}
    for w in words:
        ids = np.frombuffer(encoder.words[w], np.int32).tolist()
        total = sum(encoder.floor if i == 0 else scores[i] for i in ids)
        assert total == pytest.approx(best_split(w, known, encoder.floor))


def test_blocks_change_nothing(docs, vocabulary, monkeypatch):
    rows = list(enumerate(odd_texts(50, 4)))
    whole = {r.id: r.ids for r in pieces.encode(docs(rows), vocabulary).collect()}
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 7)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], names=["id", "text"])
    out = pa.Table.from_batches(pieces._encode(vocabulary)(iter([batch]))).to_pylist()
    assert {r["id"]: r["ids"] for r in out} == whole


def test_empty_table(docs, vocabulary):
    assert pieces.encode(docs([]), vocabulary).count() == 0


def test_models_that_change_texts_are_refused(tmp_path):
    raw = LIBRARY.serialized_model_proto().replace(b"\x18\x01 \x00", b"\x18\x01 \x01")
    path = tmp_path / "m.model"
    path.write_bytes(raw)
    if raw != LIBRARY.serialized_model_proto():
        with pytest.raises(ValueError, match="normaliser"):
            pieces.Vocabulary.load(str(path))


def test_a_text_without_spaces_is_not_kept(docs):
    encoder = pieces.Encoder(pieces.Vocabulary.load())
    long = "".join(f"x{i % 97}é" for i in range(400_000))
    first, second = encoder.encode([long, "a short text"])
    assert pieces.Decoder(encoder.v)(first) == long and len(second)
    assert not encoder.long and max(map(len, encoder.words)) <= encoder.LONG
