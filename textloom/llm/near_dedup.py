"""Near-duplicate groups by min-max hashing.

Each document's set of word shingles is hashed once under every permutation, and both the
minimum and the maximum are kept. Either equals another document's with probability J (the
Jaccard similarity), so P permutations give 2P signature values for P hash evaluations; the two
extremes of one permutation are negatively correlated, so an estimate over all of them is
unbiased and of lower variance than 2P separate minima. The values are banded; documents that
share a band are candidates, and every link is confirmed on the full sets.

No bucket is expanded into all pairs. Documents with equal sets become one class first. Then, in
rounds, every member of a bucket is compared with one centre of that bucket, links are joined
into components, and buckets that lie inside one component are done. What is left, members of
one bucket in different components, is compared only where an exact bound on what two sets can
share allows a link (see ``_leftover_pairs``): no pair is set aside by an estimate. A centre's
set is dealt out in salted copies.

Defined results: null and empty texts, and texts without words, have empty sets: they stand
alone and stay. Texts with fewer words than a shingle are one shingle. Repeated identifiers are
one node of the graph, with their rows' sets as separate classes. A null identifier stands alone
if it is the only one; several null identifiers form one node. An empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm.components import components
from textloom.llm.shared import Workspace, ensure_columns, small, tidy, without, written

PERMUTATIONS, BAND_ROWS = 80, 5
#: A centre's set is copied once for each so many members that are compared with it.
CENTRE_FAN = 256
_MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Shingler:
    """64-bit shingle hashes of a text's words, ASCII letters in lower case."""

    LIMIT = 150_000

    def __init__(self, words: int):
        self.words, self.cache = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.cache
        if len(known) > self.LIMIT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.words, len(words))
        n = len(words) - width + 1
        out = np.full(n, np.uint64(width), np.uint64)
        for k in range(width):
            out = scramble((out ^ hashes[k : k + n]) * _MIX1 + np.uint64(k + 1))
        return np.unique(out)


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX2
    return x ^ (x >> np.uint64(29))


def min_max(flat: np.ndarray, starts: np.ndarray, permutations: int, seed: int = 1) -> np.ndarray:
    """Signatures of the sets ``flat[starts[i]:starts[i+1]]``; columns min, max of each permutation."""
    rng = np.random.default_rng(seed)
    xor = rng.integers(0, 2**63, permutations, dtype=np.uint64)
    mul = rng.integers(0, 2**62, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(starts), 2 * permutations), np.uint64)
    for p in range(permutations):
        v = (flat ^ xor[p]) * mul[p]
        out[:, 2 * p] = np.minimum.reduceat(v, starts)
        out[:, 2 * p + 1] = np.maximum.reduceat(v, starts)
    return out


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    n_bands = signatures.shape[1] // rows
    out = np.empty((len(signatures), n_bands), np.uint64)
    for b in range(n_bands):
        h = np.full(len(signatures), np.uint64(b + 1), np.uint64)
        for r in range(rows):
            h = scramble((h ^ signatures[:, b * rows + r]) * _MIX1)
        out[:, b] = h
    return out


SIGNED = "id long, n_shingles long, set_key binary, bands array<long>"
#: Shingles that are hashed at once; a longer text is a batch of its own.
CHUNK = 1 << 20


def _sign(words: int, permutations: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)

        def flush(ids, sets):
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            keys: list = [None] * len(sets)
            lists: list = [[]] * len(sets)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                sig = min_max(flat, starts, permutations)
                bands = band_keys(sig, rows).view(np.int64)
                for at, i in enumerate(full):
                    keys[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                    lists[i] = bands[at]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(lists, pa.list_(pa.int64())),
                ],
                names=["id", "n_shingles", "set_key", "bands"],
            )

        for batch in batches:
            ids, sets, held = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(i)
                sets.append(shingle(text.as_py()))
                held += len(sets[-1])
                if held >= CHUNK:
                    yield flush(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield flush(ids, sets)

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                sets, start = [], at
                while at < batch.num_rows and sum(map(len, sets)) < CHUNK:
                    sets.append(shingle(batch.column(1)[at].as_py()).view(np.int64))
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, at - start), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "items"]
                )

    return run


def signed(docs: DataFrame, id_col: str, text_col: str, words: int, permutations: int, rows: int) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(tidy(_sign(words, permutations, rows)), SIGNED)


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b and further columns; a written table, each pair once) with a_items and
    b_items. Where one a has many b, its set is dealt out in salted copies."""
    n_pairs = pairs.count()
    fans = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(CENTRE_FAN)).cast("int").alias("fan"))
    fans = small(fans, n_pairs, 24)
    centres = sets.withColumnsRenamed({"rep": "a", "items": "a_items"}).join(fans, "a")
    centres = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("fan") - 1))).drop("fan")
    salted = pairs.join(fans, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("fan")).cast("int")).drop("fan")
    members = sets.withColumnsRenamed({"rep": "b", "items": "b_items"}).join(small(salted, n_pairs, 48), "b")
    return members.join(centres, ["a", "salt"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b; each once) whose full sets reach the threshold."""
    shared = F.size(F.array_intersect("a_items", "b_items")).cast("long")
    union = F.size("a_items").cast("long") + F.size("b_items") - shared
    return _with_sets(pairs, sets).where(shared * 100 >= union * percent).select("a", "b")


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    permutations: int = PERMUTATIONS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """A row per input row: id, n_shingles, component_id (the smallest identifier reachable)."""
    ensure_columns(docs, id_col, text_col)
    space = Workspace(docs.sparkSession, "near-groups")
    marked = space.written(signed(docs, id_col, text_col, words, permutations, rows), "signed")
    filled = marked.where("n_shingles > 0")

    # equal sets are one class, named by its smallest identifier
    classes = space.written(filled.groupBy("set_key").agg(F.min("id").alias("rep")).where("rep is not null"), "classes")
    key_of = classes.select(F.col("set_key").alias("key_of"), "rep")
    firsts = filled.join(key_of, (F.col("set_key") == F.col("key_of")) & (F.col("id") == F.col("rep")))
    nodes = firsts.groupBy("set_key").agg(F.min("rep").alias("node"), F.min("bands").alias("bands"))
    nodes = space.written(nodes.drop("set_key"), "nodes")

    keyed = nodes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").drop("hi")
    buckets = space.written(keyed.join(shared, "key"), "members")

    links = _links(docs, buckets, id_col, text_col, words, percent, space)
    joined = components(links, space)
    rep_comp = joined.select(F.col("node").alias("rep"), "comp")
    class_comp = classes.join(rep_comp, "rep", "left").select("set_key", F.coalesce("comp", "rep").alias("comp"))
    found = marked.select("id", "n_shingles", "set_key").join(class_comp, "set_key", "left")
    found = written(found.select("id", "n_shingles", F.coalesce("comp", "id").alias("component_id")), "groups")
    space.close()
    return found


def _degrees(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def _links(
    docs: DataFrame, buckets: DataFrame, id_col: str, text_col: str, words: int, percent: int, space: Workspace
) -> DataFrame:
    """Confirmed links between classes, enough to join all that any link joins. ``buckets``: node,
    key, lo (the bucket's smallest node)."""
    members = buckets.select("node").distinct()
    n_members = members.count()
    source = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    wanted = source.join(small(members.withColumnRenamed("node", "rep"), n_members, 32), "rep", "left_semi")
    sets = space.written(wanted.mapInArrow(tidy(_sets(words)), "rep long, items array<long>"), "sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        """``pairs``: a, b."""
        return space.written(_confirmed(space.written(pairs.distinct(), f"{name}-pairs"), sets, percent), name)

    # 1. every member with its bucket's smallest
    links = confirmed(buckets.where("node <> lo").select(F.col("lo").alias("a"), F.col("node").alias("b")), "star")

    # 2. in buckets that are still several components: every member with the most linked one
    comp = components(links, space)
    state = _degrees(links).join(comp, "node", "full")
    known = buckets.join(state, "node", "left").withColumn("comp", F.coalesce("comp", "node")).fillna(0, ["degree"])
    known = space.written(known, "known")
    best = F.max_by(F.struct("node", "comp"), F.struct("degree", "node"))
    open_keys = known.groupBy("key").agg(
        F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("size"), best.alias("best")
    )
    open_keys = open_keys.where("c0 < c1 and size > 2")
    hubs = space.written(open_keys.select("key", F.col("best.node").alias("hub"), F.col("best.comp").alias("hub_comp")), "hubs")
    n_hubs = hubs.count()
    if not n_hubs:
        return links
    apart = known.join(small(hubs, n_hubs, 48), "key").where("node <> hub and comp <> hub_comp and lo <> node and lo <> hub")
    links = links.unionAll(confirmed(apart.select(F.col("hub").alias("a"), F.col("node").alias("b")), "hub"))

    # 3. what no centre has joined, member by member, seen from the most linked node of the hub's
    # component, which need not be in the bucket; that is looked up per bucket, not per member
    comp = space.written(components(links, space).withColumnRenamed("comp", "now"), "now")
    tops = comp.join(_degrees(links), "node").groupBy("now").agg(F.max_by("node", F.struct("degree", "node")).alias("top"))
    tops = space.written(tops.withColumnRenamed("now", "main"), "tops")
    seen_from = hubs.join(comp.withColumnsRenamed({"node": "hub", "now": "main"}), "hub", "left")
    seen_from = space.written(seen_from.select("key", "hub", F.coalesce("main", "hub").alias("main")), "seen-from")
    seen_from = seen_from.join(small(tops, tops.count(), 32), "main", "left")
    seen_from = space.written(seen_from.select("key", "hub", "main", F.coalesce("top", "hub").alias("top")), "tops-of-keys")
    rest = known.select("key", "node", "lo").join(small(seen_from, n_hubs, 64), "key").where("node <> lo and node <> hub")
    rest = space.written(rest.select("node", "main", F.col("top").alias("centre")).distinct(), "rest")
    if not rest.limit(1).count():
        return links
    rest = rest.join(comp, "node", "left").withColumn("now", F.coalesce("now", "node"))
    direct, pairs = _leftover_pairs(rest.where("node <> centre"), sets, percent, space)
    return links.unionAll(direct).unionAll(confirmed(pairs, "rest"))


def _leftover_pairs(rest: DataFrame, sets: DataFrame, percent: int, space: Workspace) -> tuple[DataFrame, DataFrame]:
    """``rest``: centre, node, now, main; nodes of a bucket whose other members are seen from
    ``centre``, with their component and the centre's. Links with centres (a, b), and pairs (a, b)
    of nodes of one centre that may be linked and lie in different components.

    Seen from the centre O a set x is its difference d(x): what it has beyond O, and what of O it
    lacks. Two sets share as many shingles as their differences have in common, plus what they
    both have of O if nothing was missing twice:
        |x & y| = |d(x) & d(y)| + |x & O| + |y & O| - |O|.
    So a link needs ``o`` common items of the two differences, where ``o`` follows from the sizes,
    and ``o`` is at least 1 if one of the two is not linked with O. In a common order, rarest
    first, the first common item then has ``o - 1`` others behind it in both, which bounds its rank
    on either side; pairs meet on such items only. Copies of one original that were changed each
    in its own way lack common rare items: they are not compared, however many they are."""
    rest = space.written(rest.withColumnsRenamed({"centre": "a", "node": "b"}), "seen")
    both = _with_sets(rest, sets)
    base = both.select(
        F.xxhash64("a", "a_items").alias("view"), F.xxhash64("b", "b_items").alias("variant"),
        "a", "b", "now", "main", F.size("a_items").cast("long").alias("whole"), F.size("b_items").cast("long").alias("n"),
        F.array_except("b_items", "a_items").alias("own"), F.array_sort(F.array_except("a_items", "b_items")).alias("lacked"),
    )
    base = base.withColumn("part", F.col("n") - F.size("own"))
    linked = F.col("part") * 100 >= (F.col("n") + F.col("whole") - F.col("part")) * percent
    base = space.written(base.withColumn("linked", linked), "differences")
    direct = base.where("linked and now <> main").select("a", "b")
    full = 100 + percent
    base = base.withColumns(
        {
            "free": ~F.col("linked") & (F.col("now") != F.col("main")),
            "now": F.when(F.col("linked"), F.col("main")).otherwise(F.col("now")),
            "slack": F.col("n") * percent - F.col("part") * full,  # what a set adds to ``o``, times ``full``
            "d": (F.size("own") + F.size("lacked")).cast("long"),
        }
    )
    floors = base.groupBy("view").agg(F.min("slack").alias("least_all"), F.min(F.when(F.col("free"), F.col("slack"))).alias("least_free"))
    floors = space.written(floors.where("least_free is not null"), "floors")
    base = base.join(small(floors, floors.count(), 32), "view")
    other = F.when(F.col("free"), F.col("least_all")).otherwise(F.col("least_free"))
    least = F.greatest(F.lit(1), F.ceil((F.col("slack") + other + F.col("whole") * full) / full)).cast("long")
    base = base.withColumn("reach", F.col("d") - least + 1).where("reach > 0").drop("least_all", "least_free", "slack", "linked", "main")

    facts = ["view", "variant", "b", "now", "free", "n", "part", "whole", "d", "reach"]
    items = base.select(*facts, F.size("own").alias("n_own"), F.explode("own").alias("item"))
    often = items.groupBy("view", "item").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    of_node = W.partitionBy("view", "b", "variant")
    ranked = items.join(often, ["view", "item"]).withColumn("often", F.count(F.lit(1)).over(of_node))
    ranked = ranked.withColumn("rank", F.col("n_own") - F.col("often") + F.row_number().over(of_node.orderBy("df", "item")))
    beyond = F.slice("lacked", F.lit(1), F.greatest(F.lit(0), F.col("reach") - F.size("own")).cast("int"))
    lacks = base.select(*facts, F.size("own").alias("n_own"), F.posexplode(beyond).alias("at", "item"))
    lacks = lacks.withColumn("rank", F.col("n_own") + F.col("at") + 1)
    prefix = ranked.select(*facts, "item", "rank").unionAll(lacks.select(*facts, "item", "rank")).where("rank <= reach")
    prefix = space.written(prefix.drop("reach", "variant"), "prefix")

    x = prefix.where("free").select("view", "item", *[F.col(c).alias(f"x_{c}") for c in ("b", "now", "n", "part", "d", "rank")])
    need = F.ceil((F.col("x_n") + F.col("n")) * percent / full).cast("long")
    common = need - F.col("x_part") - F.col("part") + F.col("whole")
    once = (F.col("x_now") != F.col("now")) & (~F.col("free") | (F.col("x_b") < F.col("b")))
    behind = F.least(F.col("x_d") - F.col("x_rank"), F.col("d") - F.col("rank")) + 1
    pairs = x.join(prefix, ["view", "item"]).where(once & (common <= behind))
    return direct, pairs.select(F.col("x_b").alias("a"), "b")


def near_deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group, those with its smallest identifier. Rows
    without an identifier stay too."""
    groups = near_groups(docs, id_col, text_col, **options)
    gone = groups.where("id <> component_id").select(F.col("id").alias(id_col))
    return without(docs, written(gone, "gone"), id_col)
