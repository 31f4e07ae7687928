"""Exact deduplication over a log-structured merge index of text digests.

The input's rows are dealt to memtables. A memtable holds one entry for each of its digests (the
identifier that stays, how many rows) and is flushed as a run: files sorted by digest, and a
filter, a table of 64-bit cells in which every digest has set four bits. Before a memtable is
flushed, its digests probe the runs that are live: first their filters, and what passes these the
runs themselves. Found digests, and those that a memtable has more than once, are hits. Whenever a
level has ``FAN`` runs they are compacted into one run of the next level, which keeps one
identifier of each digest. At the end, only hits are looked up in the index, and a hit counts only
after its bytes have been compared with those of the row that stays. Digests whose bytes differ are
regrouped by text. Rows that are no hit stay without any join.

Everything is a DataFrame plan: no Python runs on the executors. A text that a third of all rows
share is pre-aggregated inside its memtables and is one entry of each, and its bytes meet through
a sort-merge join whose large partitions adaptive execution splits.

Defined results: a null text counts as empty; a null identifier never stays unless its whole
group has none; repeated rows are rows like any other (all those with the identifier that stays
are marked kept; ``deduplicate`` keeps the one whose columns come first as JSON text); an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.shared import Workspace, ensure_columns, fresh, small, without, written

#: Rows of a memtable, about; there are between these numbers of memtables, whatever the input.
MEMTABLE_ROWS, LEAST_TABLES, MOST_TABLES = 50_000_000, 4, 64
#: Runs of a level that are compacted into one run of the next.
FAN = 2
#: Digests for each 64-bit cell of a filter, about, and the bits that each of them sets.
CELL_DIGESTS, CELL_BITS = 4, 4


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _cell(digest: Column, cells: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(cells)).cast("long")


def _bits(digest: Column) -> Column:
    other = F.xxhash64(digest, F.lit(1))
    bits = F.lit(0).cast("long")
    for k in range(CELL_BITS):
        place = F.shiftrightunsigned(other, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return bits


@dataclass(frozen=True)
class Run:
    """A run's entries (digest, keep_id, n), its filter (cell, bits) and their sizes."""

    table: DataFrame
    filter: DataFrame
    rows: int
    cells: int


class DigestIndex:
    """Runs by level; ``keep`` is "min" or "max". Its tables lie in ``space``, whose owner deletes
    them. ``probed`` has (asked, passed a filter, found) for each run that was probed."""

    def __init__(self, spark: SparkSession, keep: str = "min", space: Workspace | None = None):
        if keep not in ("min", "max"):
            raise ValueError("keep must be 'min' or 'max'")
        self.keep, self.space = F.min if keep == "min" else F.max, space or Workspace(spark, "digests")
        self.levels: list[list[Run]] = []
        self.probed: list[tuple[int, int, int]] = []
        self.flushed = 0

    def live(self) -> list[Run]:
        return [run for level in self.levels for run in level]

    def _run(self, entries: DataFrame) -> Run:
        table = self.space.written(entries.sortWithinPartitions("digest"), "run")
        rows = table.count()
        cells = max(1, -(-rows // CELL_DIGESTS))
        marked = table.select(_cell(F.col("digest"), cells).alias("cell"), _bits(F.col("digest")).alias("bits"))
        return Run(table, self.space.written(marked.groupBy("cell").agg(F.bit_or("bits").alias("bits")), "filter"), rows, cells)

    def probe(self, run: Run, digests: DataFrame, asked: int) -> DataFrame:
        """Those of ``digests`` (digest; ``asked`` distinct rows) that ``run`` has: digest."""
        keyed = digests.select("digest", _cell(F.col("digest"), run.cells).alias("cell"), _bits(F.col("digest")).alias("wanted"))
        through = keyed.join(small(run.filter, run.cells, 16), "cell").where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
        passed = self.space.written(through.select("digest"), "passed")
        n_passed = passed.count()
        # sorted files and a few digests: their values are looked for, the rest is read past
        found = self.space.written(run.table.select("digest").join(small(passed, n_passed, 64), "digest", "left_semi"), "found")
        self.probed.append((asked, n_passed, found.count()))
        return found

    def flush(self, entries: DataFrame) -> DataFrame:
        """Adds a memtable's ``entries`` (digest, id) as a run; its hits: digest."""
        memtable = entries.groupBy("digest").agg(self.keep("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        run = self._run(memtable)
        hits = run.table.where("n > 1").select("digest")
        for older in self.live():
            hits = hits.unionAll(self.probe(older, run.table.select("digest"), run.rows))
        self.flushed += 1
        self._add(run, 0)
        return hits

    def _add(self, run: Run, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= FAN:
            merged, self.levels[level] = self._merged(self.levels[level]), []
            self._add(merged, level + 1)

    def _merged(self, runs: list[Run]) -> Run:
        every = reduce(DataFrame.unionAll, [r.table for r in runs])
        return self._run(every.groupBy("digest").agg(self.keep("keep_id").alias("keep_id"), F.sum("n").alias("n")))

    def compact(self) -> DataFrame:
        """All live runs as one, at the highest level; digest, keep_id, n."""
        runs = self.live()
        if not runs:
            raise ValueError("nothing has been flushed")
        if len(runs) > 1:
            self.levels = [[] for _ in self.levels] + [[self._merged(runs)]]
        return self.live()[0].table

    def lookup(self, digests: DataFrame) -> DataFrame:
        """keep_id and n of ``digests`` (digest, distinct), nulls where the index has none; runs are
        read only for what passes their filters."""
        asked = digests.count()
        rows = [run.table.join(self.probe(run, digests, asked), "digest", "left_semi") for run in self.live()]
        if not rows:
            return digests.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(None).cast("long").alias("n"))
        every = reduce(DataFrame.unionAll, rows).groupBy("digest").agg(self.keep("keep_id").alias("keep_id"), F.sum("n").alias("n"))
        return digests.join(every, "digest", "left")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    normalise: Callable[[Column], Column] | None = None,
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """One row per input row: id, digest, keep_id, n, collided (its digest had other bytes)."""
    ensure_columns(docs, id_col, text_col)
    space = Workspace(docs.sparkSession, "exact-groups")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = normalise(text) if normalise else text
    rows = docs.select(F.col(id_col).alias("id"), text.alias("body"))
    marked = rows.select(digest(F.col("body")).alias("digest"), "id", "body")
    n_tables = min(MOST_TABLES, max(LEAST_TABLES, -(-docs.count() // MEMTABLE_ROWS)))
    dealt = marked.select("digest", "id", F.pmod(F.xxhash64("id"), F.lit(n_tables)).alias("memtable"))
    entries = space.written(dealt, "entries", ("memtable",))

    index = DigestIndex(docs.sparkSession, keep, space)
    found = [index.flush(entries.where(F.col("memtable") == k).select("digest", "id")) for k in range(n_tables)]
    hits = space.written(reduce(DataFrame.unionAll, found).distinct(), "hits")
    n_hits = hits.count()
    compacted = index.compact().join(small(hits, n_hits, 48), "digest", "left_semi")
    compacted = space.written(compacted.select("digest", "keep_id", "n"), "compacted")
    groups = entries.drop("memtable").join(small(compacted.withColumn("hit", F.lit(True)), n_hits, 96), "digest", "left")
    members = groups.select(
        "id", "digest", F.when(F.col("hit"), F.col("keep_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("n"), F.lit(False).alias("collided"),
    )

    hit_rows = marked.join(small(compacted.drop("n"), n_hits, 80), "digest")
    pick = F.min if keep == "min" else F.max
    kept_bytes = hit_rows.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("digest").agg(pick("body").alias("kept_body"))
    kept_bytes = space.written(kept_bytes, "kept_bytes")  # so that the join's sides are plain shuffles, which can be split
    unequal = hit_rows.join(kept_bytes, "digest").where("body <> kept_body").select("digest")
    collided = space.written(unequal, "collided")
    n_collided = collided.distinct().count()
    if n_collided:
        again = marked.join(small(collided, n_collided, 48), "digest", "left_semi")
        by_text = again.groupBy("digest", "body").agg(pick("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        regrouped = again.join(by_text, ["digest", "body"]).select("id", "digest", "keep_id", "n", F.lit(True).alias("collided"))
        members = without(members, collided, "digest").unionByName(regrouped)
    members = written(members, "exact-groups")
    space.close()
    return members


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns."""
    groups = exact_groups(docs, id_col, text_col, keep)
    stays = F.col("id").eqNullSafe(F.col("keep_id"))
    again = groups.where(stays & (F.col("n") > 1)).groupBy("id", "digest").agg(F.count(F.lit(1)).alias("same")).where("same > 1")
    again = written(again.drop("same"), "again")  # rows that repeat with their identifier
    gone = written(groups.where(~stays).select("id", "digest").distinct(), "gone")
    digest = sha256_digest(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    the_id, of = fresh(docs, "__id"), fresh(docs, "__of")

    def named(side: DataFrame, rows: int) -> DataFrame:
        return small(side.withColumnsRenamed({"id": the_id, "digest": of}), rows, 96)

    # by text as well: an identifier may stand for several texts
    same = docs[id_col].eqNullSafe(F.col(the_id)) & (digest == F.col(of))
    kept = docs.join(named(gone, gone.count()), same, "left_anti")
    n_again = again.count()
    if not n_again:
        return kept
    first = F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*docs.columns))).alias("row")
    once = kept.join(named(again, n_again), same).groupBy(the_id, of).agg(first).select("row.*")
    return kept.join(named(again, n_again), same, "left_anti").unionAll(once)
