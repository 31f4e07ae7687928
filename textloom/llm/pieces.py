"""SentencePiece encoding and decoding by a forward pass over a trie of words.

Texts are cut into marked words (spaces as U+2581, each run of marks opening a word). The distinct
words of a block of texts are sorted, which is a depth-first walk of their trie: each word keeps
the forward states of the prefix that it shares with the word before it and computes only the rest.

What a state holds follows the model's type. In a unigram model it is the best score of any
segmentation of the prefix (Viterbi). In a byte-pair model scores are merge ranks, and their best
sum is not what merging gives; there a state is the last piece of the prefix's encoding, and a
piece may follow another if merging the two pieces' text alone gives the same two pieces. Every
prefix has exactly one encoding that is made of such steps, so the pass gives what the merges
give, and states can be shared between prefixes just as well. Characters that are no piece are
encoded as bytes if the model has byte pieces, as the unknown piece otherwise.

The vocabulary is read on the driver from a path that is a parameter, and travels with the task:
its size is the model's, whatever the input's.

Defined results: null and empty texts have no pieces and decode to an empty text; a text with a
literal U+2581 is encoded like one with a space there, so it doesn't come back as it was
(``round_trip`` is false); repeated rows are encoded alike; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import ensure_columns, tidy

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
UNIGRAM, BPE = 1, 2
#: Characters of texts whose words are sorted and encoded together.
BLOCK_CHARS = 1_000_000
#: What UNK adds to a unigram score: below every piece by this much.
UNKNOWN_PENALTY = 10.0


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else 4 if kind == 5 else 8
        yield key >> 3, raw[at : at + size]
        at += size


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
    model_type: int = BPE
    dummy_prefix: bool = True
    ids: dict[str, int] = field(init=False)
    byte_ids: list[int] = field(init=False)
    unknown: int = field(init=False)

    def __post_init__(self):
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k in (1, 4)}
        by_value = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds, strict=True)) if k == 6}
        self.byte_ids = [by_value[f"<0x{b:02X}>"] for b in range(256)] if len(by_value) == 256 else []
        self.unknown = self.kinds.index(2) if 2 in self.kinds else 0

    def key(self) -> str:
        return hashlib.sha256(repr((self.pieces, self.scores, self.kinds, self.model_type, self.dummy_prefix)).encode()).hexdigest()

    @classmethod
    def load(cls, path: str = MODEL_PATH) -> Vocabulary:
        with open(path, "rb") as f:
            raw = f.read()
        pieces, scores, kinds, model_type, dummy, normaliser = [], [], [], UNIGRAM, True, "identity"
        for number, value in _fields(raw):
            if number == 1:
                got = dict(_fields(value))
                pieces.append(got.get(1, b"").decode())
                scores.append(struct.unpack("<f", got[2])[0] if 2 in got else 0.0)
                kinds.append(got.get(3, 1))
            elif number == 2:
                model_type = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                got = dict(_fields(value))
                dummy, normaliser = bool(got.get(3, 1)), got.get(1, b"").decode()
                if got.get(2) or got.get(4, 1):
                    raise ValueError(f"normaliser {normaliser!r}: only models that leave texts as they are can be used")
        if model_type not in (UNIGRAM, BPE):
            raise ValueError(f"model type {model_type} is neither unigram nor byte-pair")
        if any(MARK in p.lstrip(MARK) for p, k in zip(pieces, kinds, strict=True) if k == 1):
            raise ValueError("a piece goes on beyond its word")
        return cls(pieces, scores, kinds, model_type, dummy)


class Encoder:
    """Encodes marked words; keeps what it has learned about pairs of pieces and about words."""

    #: Known pairs and words, at most; of words so many are kept beyond that, and beyond a task.
    #: Words of more characters than LONG are encoded alike but never kept: a text without spaces
    #: is one word, so what is kept has at most WORDS times LONG characters.
    LIMIT, WORDS, KEPT, LONG = 300_000, 400_000, 50_000, 256

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.words: dict[str, bytes] = {}  # 32-bit identifiers, end to end
        self.long: dict[str, bytes] = {}
        self.follows: dict[tuple[str, str], bool] = {}
        self.floor = min(vocabulary.scores, default=0.0) - UNKNOWN_PENALTY
        whole = (p for p in vocabulary.ids if vocabulary.model_type != BPE or self.merged(p) == [p])
        #: Every end of a piece, and the piece itself if it is one that can stand, else nothing:
        #: longer ends are only looked at while shorter ones are known. Known pairs hold these
        #: strings, not slices of their own.
        self.ends: dict[str, str] = {}
        for piece in whole:
            for at in range(1, len(piece)):
                self.ends.setdefault(piece[at:], "")
            self.ends[piece] = piece

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: the best-scored neighbours first, from the left."""
        ids, scores, symbols = self.v.ids, self.v.scores, list(text)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                found = ids.get(symbols[i] + symbols[i + 1])
                if found is not None and (best is None or scores[found] > best):
                    best, at = scores[found], i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _starts(self, word: str, end: int) -> list[int]:
        """Where the pieces, or the single character, that may end ``word[:end]`` start; the first
        is the character's, the last the longest piece's."""
        ends, found, start = self.ends, [end - 1], end - 1
        known = ends.get(word[start])
        while known is not None and start:
            start -= 1
            known = ends.get(word[start:end])
            if known:
                found.append(start)
        return found

    def _walk_bpe(self, word: str, shared: int, states: list) -> None:
        """Appends the last piece of each longer prefix of ``word``."""
        ends, follows, limit = self.ends, self.follows, self.LIMIT
        for end in range(shared + 1, len(word) + 1):
            start = end - 1
            piece = word[start]
            known, longer = ends.get(piece), None
            while known is not None and start:
                start -= 1
                known = ends.get(word[start:end])
                if known:
                    if longer is None:
                        longer = [piece]
                    else:
                        longer.append(piece)
                    piece = known
            # the longest piece first; then those within it
            while True:
                at = end - len(piece)
                if not at:
                    break
                pair = (states[at], piece)
                ok = follows.get(pair)
                if ok is None:
                    if len(follows) > limit:
                        follows.clear()
                    ok = follows[pair] = self.merged(pair[0] + piece) == [pair[0], piece]
                if ok:
                    break
                if not longer:
                    raise AssertionError(f"no encoding of {word[:end]!r}")
                piece = longer.pop()
            states.append(piece)

    def _walk_unigram(self, word: str, shared: int, states: list) -> None:
        """Appends the last piece and the score of the best segmentation of each longer prefix."""
        ids, scores = self.v.ids, self.v.scores
        for end in range(shared + 1, len(word) + 1):
            best = None
            for start in self._starts(word, end):
                piece = word[start:end]
                found = ids.get(piece)
                total = (states[start][1] if start else 0.0) + (self.floor if found is None else scores[found])
                if best is None or total >= best[1]:
                    best = (piece, total)
            states.append(best)

    def _ids(self, word: str, states: list) -> bytes:
        out: list[int] = []
        end, ids, plain = len(word), self.v.ids, self.v.model_type == BPE
        while end:
            piece = states[end] if plain else states[end][0]
            found = ids.get(piece)
            if found is not None:
                out.append(found)
            elif self.v.byte_ids:
                out.extend(self.v.byte_ids[b] for b in reversed(piece.encode("utf-8", "surrogatepass")))
            else:
                out.append(self.v.unknown)
            end -= len(piece)
        out.reverse()
        return array("i", out).tobytes()

    def forget(self) -> None:
        """Keeps the words that came first: frequent ones come early."""
        self.words = dict(islice(self.words.items(), self.KEPT))

    def learn(self, words: set[str]) -> None:
        """Encodes the words that are not known yet, in one walk of their trie. Long ones are in
        ``self.long`` until the next call."""
        if len(self.words) > self.WORDS:
            self.forget()
        walk = self._walk_bpe if self.v.model_type == BPE else self._walk_unigram
        known, ids_of, longest = self.words, self._ids, self.LONG
        self.long = {}
        states: list = [None]
        last = ""
        for word in sorted(words.difference(known)):
            shared = 0
            for x, y in zip(last, word, strict=False):
                if x != y:
                    break
                shared += 1
            del states[shared + 1 :]
            walk(word, shared, states)
            if len(word) > longest:
                self.long[word] = ids_of(word, states)
            else:
                known[word] = ids_of(word, states)
            last = word

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        marked = text.replace(" ", MARK)
        return _WORD.findall(MARK + marked if self.v.dummy_prefix else marked)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        split = [self.split(t or "") for t in texts]
        self.learn(set(chain.from_iterable(split)))
        known, long = self.words, self.long
        of = (lambda w: known[w] if w in known else long[w]) if long else known.__getitem__
        for words in split:
            yield np.frombuffer(b"".join(map(of, words)), np.int32)
        self.long = {}


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.is_byte = np.array([k == 6 for k in vocabulary.kinds])
        self.text = [
            "" if k == 3 else " ⁇ " if k == 2 else p
            for p, k in zip(vocabulary.pieces, vocabulary.kinds, strict=True)
        ]
        self.value = {i: b for b, i in enumerate(vocabulary.byte_ids)}

    def __call__(self, ids: np.ndarray) -> str:
        """The text of the pieces; runs of byte pieces are read as UTF-8, what isn't as U+FFFD."""
        if not len(ids):
            return ""
        if not self.is_byte[ids].any():
            joined = "".join(map(self.text.__getitem__, ids.tolist()))
        else:
            parts, run = [], bytearray()
            for i in ids.tolist():
                if i in self.value:
                    run.append(self.value[i])
                    continue
                if run:
                    parts.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                parts.append(self.text[i])
            parts.append(run.decode("utf-8", "replace"))
            joined = "".join(parts)
        plain = joined.replace(MARK, " ")
        return plain[1:] if self.v.dummy_prefix and plain.startswith(" ") else plain


_ENCODERS: dict[str, tuple[Encoder, Decoder]] = {}


def _coders(vocabulary: Vocabulary) -> tuple[Encoder, Decoder]:
    """A worker's coders for a vocabulary: what one task has learned serves the next."""
    key = vocabulary.key()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = (Encoder(vocabulary), Decoder(vocabulary))
    return _ENCODERS[key]


ENCODED = "id long, ids array<int>, n_pieces long, round_trip boolean"


def _blocks_of(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    block, held, start = [], 0, 0
    for at, text in enumerate(texts):
        block.append(text.as_py())
        held += len(block[-1] or "")
        if held >= BLOCK_CHARS:
            yield start, block
            block, held, start = [], 0, at + 1
    if block:
        yield start, block


def _encode(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decode = _coders(vocabulary)
        for batch in batches:
            for start, texts in _blocks_of(batch.column(1)):
                ids = list(encoder.encode(texts))
                sizes = np.array([len(x) for x in ids], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                same = [decode(x) == (t or "") for x, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.ListArray.from_arrays(pa.array(offsets), values),
                        pa.array(sizes),
                        pa.array(same),
                    ],
                    names=["id", "ids", "n_pieces", "round_trip"],
                )
        encoder.forget()

    return run


def _decode(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(vocabulary)
        for batch in batches:
            texts = [decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: id, ids, n_pieces, round_trip (whether decoding gives the text)."""
    ensure_columns(docs, id_col, text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(tidy(_encode(vocabulary or Vocabulary.load())), ENCODED)


def decode(encoded: DataFrame, vocabulary: Vocabulary | None = None, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """A row per input row: id, text."""
    ensure_columns(encoded, id_col, ids_col)
    pieces = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return pieces.mapInArrow(_decode(vocabulary or Vocabulary.load()), "id long, text string")
