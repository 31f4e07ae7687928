"""Language-model scores: interpolated modified Kneser-Ney over n-grams of words.

Counting runs in Spark. Workers hash words to 64 bits, count the n-grams of a chunk of texts in
sorted arrays, and send each shard (a range of context hashes) one compact block. A shard is
merged in one task: it has all n-grams of its contexts, so context totals are local; it writes
its arrays as one file in the shared folder and passes the distinct n-grams down as continuation
counts of the order below. The driver only ever holds counts of counts and sums, a few numbers a
shard.

A shard's file has sorted 64-bit hashes and their counts. Workers that score texts map the files
into memory (files in a store without a local path are fetched into an unlinked temporary file
first, FETCHED bytes of them at most are held at once) and look up a chunk's distinct n-grams in
sorted order, so pages are read in sequence. The model knows which files it has: a shard without
n-grams has none, and any other file that is not found is an error, never an empty shard.
The number of shards follows the corpus, so a merge stays as large as it is. A very frequent word
reaches a shard as one entry of each chunk, never as its occurrences.

Probabilities: order k gives max(c - D(c), 0) / total(context) plus the context's left-over mass
times order k - 1, with D by the counts of counts of that order (0.5, 1, 1.5 where these are
too few to tell); below order 1 all V known words and the unknown word weigh alike.

Defined results: null and empty texts are their end mark alone; a null identifier is learned from;
repeated rows count as often as they stand; without training rows N and V are 0 and every
probability is 1; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import Workspace, ensure_columns, scratch, tidy, worker_uri

#: Characters of training text for each shard, about; a power of two of shards is made.
SHARD_CHARS = 12_000_000
COUNT_TOKENS, SCORE_TOKENS = 3_000_000, 1_500_000
BOS, EOS = np.uint64(0x5B5BEA11D0C57A27), np.uint64(0x5EED0FD0C0E4D000)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    x = (x ^ (x >> np.uint64(29))) * _M1
    return x ^ (x >> np.uint64(32))


def context_hash(columns: list[np.ndarray]) -> np.ndarray:
    h = _mix(columns[0] + _M1)
    for c in columns[1:]:
        h = _mix(h * _M1 + c)
    return h


#: The upper bits of an n-gram's key are its context's, so that a shard is a range of keys.
_HIGH = np.uint64(0xFFFF << 48)


def gram_keys(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (contexts & _HIGH) | (_mix(contexts * _M2 + words) & ~_HIGH)


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


class Words:
    """Word hashes of a text, ASCII letters in lower case, with the end mark."""

    LIMIT = 300_000

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        known = self.cache
        if len(known) > self.LIMIT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        out = np.empty(len(words) + 1, np.uint64)
        out[:-1] = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        out[-1] = EOS
        return out


def _grams(texts: list[np.ndarray], order: int) -> list[np.ndarray]:
    """Columns of the n-grams that end at each token, padded on the left with BOS."""
    pad = np.full(order - 1, BOS, np.uint64)
    flat = np.concatenate([x for t in texts for x in (pad, t)])
    keep = np.concatenate([np.arange(len(t)) + at for t, at in zip(texts, _offsets(texts, order), strict=True)])
    return [flat[keep + k] for k in range(order)]


def _offsets(texts: list[np.ndarray], order: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(t) + order - 1 for t in texts])[:-1]]).astype(np.int64)


def _summed(columns: list[np.ndarray], *counts: np.ndarray) -> tuple[list[np.ndarray], ...]:
    """Equal rows of ``columns`` as one, sorted; ``counts`` summed."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(new)
    sums = [np.add.reduceat(c[order].astype(np.int64), at) if len(at) else c[:0].astype(np.int64) for c in counts]
    return [c[at] for c in columns], sums


def _blocks(columns: list[np.ndarray], counts: list[np.ndarray], bits: int) -> Iterator[tuple[int, bytes]]:
    """One block for each shard: contexts once, then words, then each of ``counts``."""
    *ctx, word = columns
    shard = shard_of(context_hash(ctx) if ctx else word, bits)
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        own = [c[rows] for c in ctx]
        new = np.ones(len(rows), bool)
        if own:
            new[1:] = np.any([c[1:] != c[:-1] for c in own], axis=0)
        at = np.flatnonzero(new) if own else np.zeros(0, np.int64)
        runs = np.diff(np.append(at, len(rows))).astype(np.uint32) if own else np.zeros(0, np.uint32)
        head = np.array([len(rows), len(at), len(own), len(counts)], np.uint64)
        parts = [head, *(c[at] for c in own), runs, word[rows], *(c[rows].astype(np.int64) for c in counts)]
        yield int(shard[rows[0]]), b"".join(p.tobytes() for p in parts)


def _unblock(raw: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    n, groups, width, n_counts = (int(x) for x in np.frombuffer(raw, np.uint64, 4))
    at = 32

    def take(kind, m):
        nonlocal at
        out = np.frombuffer(raw, kind, m, at)
        at += out.nbytes
        return out

    heads = [take(np.uint64, groups) for _ in range(width)]
    runs = take(np.uint32, groups)
    columns = [np.repeat(h, runs) for h in heads] + [take(np.uint64, n)]
    return columns, [take(np.int64, n) for _ in range(n_counts)]


BLOCKS = "shard int, body binary"


def _count(order: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, texts, held = Words(), [], 0

        def flush():
            grams = _grams(texts, order)
            columns, counts = _summed(grams, np.ones(len(grams[0]), np.int64))
            got = list(_blocks(columns, counts, bits))
            return pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in got], pa.int32()), pa.array([b for _, b in got], pa.binary())],
                names=["shard", "body"],
            )

        for batch in batches:
            for text in batch.column(0):
                texts.append(words(text.as_py()))
                held += len(texts[-1])
                if held >= COUNT_TOKENS:
                    yield flush()
                    texts, held = [], 0
        if texts:
            yield flush()

    return run


def _save(root: str, name: str, arrays: list[np.ndarray]) -> None:
    """One file: how many arrays and how long each is, then the arrays. A second attempt of a
    task puts the same bytes in the same place."""
    fs, path = pafs.FileSystem.from_uri(root)
    fs.create_dir(path, recursive=True)
    own = f"{path}/.{name}.{os.getpid()}.{np.random.default_rng().integers(2**40)}"
    with fs.open_output_stream(own) as out:
        out.write(np.array([len(arrays), *(len(a) for a in arrays)], np.uint64).tobytes())
        for a in arrays:
            out.write(a.astype(np.uint64, copy=False).tobytes() if a.dtype != np.uint32 else _padded(a))
    fs.move(own, f"{path}/{name}")


def _padded(a: np.ndarray) -> bytes:
    return a.tobytes() + b"\0" * (a.nbytes % 8)


#: Files that are mapped at once, and bytes of fetched copies; beyond either, all are let go.
MAPPED, FETCHED = 4096, 2 << 30
_MAPPED: dict[str, list[np.ndarray]] = {}
_FETCHED = 0


def _mapped(root: str, name: str, kinds: tuple) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory. A file that is not there is an error."""
    global _FETCHED
    key = f"{root}/{name}"
    if key in _MAPPED:
        return _MAPPED[key]
    fs, path = pafs.FileSystem.from_uri(root)
    info = fs.get_file_info(f"{path}/{name}")
    if info.type != pafs.FileType.File:
        raise FileNotFoundError(f"{key} is lost, or this worker does not see the shared folder")
    local_file = isinstance(fs, pafs.LocalFileSystem)
    if len(_MAPPED) >= MAPPED or (not local_file and _FETCHED + info.size > FETCHED):
        _MAPPED.clear()
        _FETCHED = 0
    if local_file:
        raw = np.memmap(f"{path}/{name}", np.uint8, "r")
    else:  # the mapping outlives the name, so nothing stays behind
        with tempfile.NamedTemporaryFile() as local:
            with fs.open_input_stream(f"{path}/{name}") as src:
                while chunk := src.read(1 << 22):
                    local.write(chunk)
            local.flush()
            raw = np.memmap(local.name, np.uint8, "r")
        _FETCHED += info.size
    n = int(raw[:8].view(np.uint64)[0])
    sizes = raw[8 : 8 + 8 * n].view(np.uint64).astype(np.int64)
    at, arrays = 8 + 8 * n, []
    for k, m in zip(kinds, sizes, strict=True):
        size = int(m) * np.dtype(k).itemsize
        arrays.append(raw[at : at + size].view(k))
        at += size + (size % 8)
    if at != len(raw):
        raise OSError(f"{key} has {len(raw)} bytes, not {at}")
    _MAPPED[key] = arrays
    return arrays


U32, U64 = np.uint32, np.uint64
GRAM_FILE, WORD_FILE = (U64, U32, U64, U64, U32, U32, U32), (U64, U64, U32)
MERGED = "shard int, body binary, stats array<long>"


def _of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def _merge(level: int, root: str, bits: int, top: bool):
    """Merges a shard at ``level`` words; its rows: the blocks of the level below, and one with
    its statistics: n1..n4, entries, sum of counts, sum of raw counts."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = [_unblock(b.as_py()) for b in table.column("body")]
        columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts), strict=True)]
        counts = [np.concatenate(c) for c in zip(*(p[1] for p in parts), strict=True)]
        del parts, table
        columns, sums = _summed(columns, *counts)
        # raw: occurrences; used: what this order's probabilities are made of
        raw, used = (sums[0], sums[0]) if top else (sums[0], sums[1])
        stats = [*_of_counts(used), len(used), int(used.sum()), int(raw.sum())]
        out = [(shard, None, stats)]
        if level == 1:
            order = np.argsort(columns[0])
            _save(root, f"words-{shard}", [columns[0][order], raw[order].astype(U64), used[order].astype(U32)])
        else:
            ctx = context_hash(columns[:-1])
            keys = gram_keys(ctx, columns[-1])
            order = np.argsort(keys)
            by = np.argsort(ctx, kind="stable")
            at = np.flatnonzero(np.append(True, np.diff(ctx[by]) != 0)) if len(by) else by
            per = lambda x: np.add.reduceat(x[by].astype(np.int64), at)
            _save(
                root,
                f"grams{level}-{shard}",
                [keys[order], used[order].astype(U32), ctx[by][at], per(used).astype(U64)]
                + [per(m).astype(U32) for m in (used == 1, used == 2, used > 2)],
            )
            below, more = _summed(columns[1:], raw, np.ones(len(raw), np.int64))
            out += [(s, b, None) for s, b in _blocks(below, more, bits)]
        return pa.Table.from_arrays(
            [
                pa.array([r[0] for r in out], pa.int32()),
                pa.array([r[1] for r in out], pa.binary()),
                pa.array([r[2] for r in out], pa.list_(pa.int64())),
            ],
            names=["shard", "body", "stats"],
        )

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), k) for d, k in zip(raw, (1.0, 2.0, 3.0), strict=True))


@dataclass(frozen=True)
class Model:
    """Where the files are, and the sums that all workers need."""

    root: str
    order: int
    bits: int
    discount: tuple[tuple[float, float, float], ...]  # of orders 1, 2, ...
    tokens: int
    known: int
    continuations: int  # sum of the order-1 counts
    ones: tuple[int, int, int]  # words of order-1 count 1, 2, 3 and more
    shards: tuple[bytes, ...]  # of orders 1, 2, ...: a bit for each shard that has a file

    def _file(self, level: int, shard: int) -> list[np.ndarray] | None:
        """The file of a shard at a level; none if the corpus put nothing there."""
        if not self.shards[level - 1][shard >> 3] >> (shard & 7) & 1:
            return None
        name, kinds = (f"words-{shard}", WORD_FILE) if level == 1 else (f"grams{level}-{shard}", GRAM_FILE)
        return _mapped(self.root, name, kinds)

    def _less(self, level: int, c: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.discount[level - 1]])[np.minimum(c, 3)]

    def _each_shard(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """The shards that sorted ``keys`` fall into, and where."""
        shards = shard_of(keys, self.bits)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(shards)) + 1, [len(keys)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                yield int(shards[a]), slice(a, b)

    @staticmethod
    def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
        return at, sorted_keys[at] == wanted

    def words(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted word hashes: raw counts and order-1 probabilities."""
        raw, used = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        for shard, part in self._each_shard(wanted):
            if file := self._file(1, shard):
                keys, n, c = file
                at, hit = self._find(keys, wanted[part])
                raw[part] = np.where(hit, n[at].astype(np.int64), 0)
                used[part] = np.where(hit, c[at].astype(np.int64), 0)
        if not self.continuations:
            return raw, np.full(len(wanted), 1.0 / (self.known + 1))
        spare = sum(d * n for d, n in zip(self.discount[0], self.ones, strict=True)) / self.continuations
        direct = np.maximum(used - self._less(1, used), 0) / self.continuations
        return raw, direct + spare / (self.known + 1)

    def grams(self, level: int, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What order ``level`` adds, and the weight it leaves to the order below."""
        every = gram_keys(contexts, words)
        keys, first, back = np.unique(every, return_index=True, return_inverse=True)
        ctx, ctx_back = np.unique(contexts[first], return_inverse=True)
        count = np.zeros(len(keys), np.int64)
        total, spare = np.zeros(len(ctx)), np.ones(len(ctx))
        d = self.discount[level - 1]
        for shard, part in self._each_shard(keys):
            if file := self._file(level, shard):
                at, hit = self._find(file[0], keys[part])
                count[part] = np.where(hit, file[1][at].astype(np.int64), 0)
        for shard, part in self._each_shard(ctx):
            if file := self._file(level, shard):
                at, hit = self._find(file[2], ctx[part])
                sums = file[3][at].astype(np.float64)
                left = sum(w * n[at].astype(np.float64) for w, n in zip(d, file[4:], strict=True))
                total[part] = np.where(hit, sums, 0)
                spare[part] = np.where(hit, left / np.maximum(sums, 1), 1)
        t = total[ctx_back]
        direct = np.where(t > 0, np.maximum(count - self._less(level, count), 0) / np.maximum(t, 1), 0)
        return direct[back], spare[ctx_back][back]

    def score(self, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """For each text: tokens, known tokens, base score, score."""
        columns = _grams(texts, self.order)
        wanted, back = np.unique(columns[-1], return_inverse=True)
        raw, p1 = self.words(wanted)
        base = np.log10((raw + 1) / (self.tokens + 1 * (self.known + 1)))
        p = p1[back]
        for level in range(2, self.order + 1):
            direct, spare = self.grams(level, context_hash(columns[-level:-1]), columns[-1])
            p = direct + spare * p
        starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]])
        sums = [np.add.reduceat(x, starts) for x in ((raw > 0)[back].astype(np.int64), base[back], np.log10(p))]
        return (np.array([len(t) for t in texts]), *sums)


def fit(texts: DataFrame, text_col: str = "text", order: int = 2, shard_chars: int = SHARD_CHARS) -> Model:
    """Counts the n-grams of all rows of ``texts`` and writes the model's files."""
    ensure_columns(texts, text_col)
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = texts.sparkSession
    column = texts.select(F.col(text_col).cast("string").alias("text"))
    chars = column.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(16, max(0, (chars // shard_chars).bit_length()))
    root = worker_uri(spark, scratch(spark, f"kneser-ney-{order}"))
    space = Workspace(spark, "kneser-ney-counts")
    blocks = column.mapInArrow(tidy(_count(order, bits)), BLOCKS)
    found, shards = [], []
    for level in range(order, 0, -1):
        merge = _merge(level, root, bits, top=level == order)
        merged = space.written(blocks.groupBy("shard").applyInArrow(merge, MERGED), f"merged{level}")
        sums = merged.where("stats is not null").select(F.posexplode("stats").alias("k", "v")).groupBy("k").agg(F.sum("v"))
        got = dict(sums.collect())  # seven numbers
        found.insert(0, [got.get(k) or 0 for k in range(7)])
        bits_of = bytearray(((1 << bits) + 7) // 8)
        for row in merged.where("stats is not null").select("shard").distinct().collect():  # 65,536 numbers at most
            bits_of[row.shard >> 3] |= 1 << (row.shard & 7)
        shards.insert(0, bytes(bits_of))
        blocks = merged.where("body is not null").select("shard", "body")
    space.close()
    n1, n2, _, _, known, continuations, tokens = found[0]
    return Model(
        root=root,
        order=order,
        bits=bits,
        discount=tuple(discounts(*s[:4]) for s in found),
        tokens=tokens,
        known=known,
        continuations=continuations,
        ones=(n1, n2, known - n1 - n2),
        shards=tuple(shards),
    )


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()

        def flush(ids, texts):
            cols = model.score(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True))],
                names=["id", "n_tokens", "n_known", "base_score", "score"],
            )

        ids, texts, held = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(i.as_py())
                texts.append(words(text.as_py()))
                held += len(texts[-1])
                if held >= SCORE_TOKENS:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield flush(ids, texts)

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: id, n_tokens, n_known, base_score, score, perplexity."""
    ensure_columns(docs, id_col, text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = texts.mapInArrow(tidy(_scores(model)), "id long, n_tokens long, n_known long, base_score double, score double")
    perplexity: Column = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return scored.withColumn("perplexity", perplexity)
