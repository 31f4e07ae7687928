"""Mixing sources to target weights by capped water-filling.

Each source is to give its weight's share of the mix. A source whose share is more than
``max_epochs`` times its size is clamped there, and what it cannot give is dealt to the others by
weight, round after round, until no source is above. A source's target is then so many whole
repetitions of all its documents and a fraction of one more: the fraction is filled with whole
documents in the order of a seeded hash, and the gap that the next document would overshoot is
filled twice more from later documents that fit in it.

Only DataFrame operations. A source that holds a third of all rows is cut into hash buckets, so
running sums are taken inside a bucket and over the buckets' totals; never over a whole source
in one task. Only the table of sources (one row each) is ordered as a whole.

Defined results: null text has size 0; null is a source of its own, ordered last; documents
without words take nothing; repeated rows are documents like any other (in the mix, rows of one
identifier, source and text share their copies, any odd one by the order of their columns); an
empty table gives an empty result; further columns are ignored. Reruns agree, whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm.shared import WORD, Workspace, ensure_columns, fresh, small, written

WEIGHTS = (3, 1, 2)
BUCKET_HEX = 3  # 4,096 buckets of a source
FILLS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = 150, max_epochs: int = 2
) -> DataFrame:
    """``sizes``: source, size. A row per source: source, rank, weight, source_size, target."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    totals = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = totals.withColumn("rank", F.row_number().over(order)).withColumn(
        "weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    )
    # in hundredths of a word, so that all sums are of integers
    ranked = written(ranked.withColumn("cap", F.col("source_size") * F.lit(100 * max_epochs)), "sources")
    goal = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share_percent
    level_parts, clamped = None, F.lit(False)
    while True:
        free, weight = ranked.agg(
            F.sum(F.when(clamped, F.col("cap")).otherwise(F.lit(0))).cast("long"),
            F.sum(F.when(clamped, F.lit(0)).otherwise(F.col("weight"))).cast("long"),
        ).first()
        if not weight:
            break
        parts = (goal - (free or 0), weight)
        if parts == level_parts:
            break
        level_parts = parts
        wide = lambda c: c.cast("decimal(19,0)")
        clamped = wide(F.col("cap")) * wide(F.lit(parts[1])) <= wide(F.col("weight")) * wide(F.lit(parts[0]))
    share = F.lit(0.0) if level_parts is None else F.lit(float(level_parts[0])) / F.lit(level_parts[1]) * F.col("weight")
    target = F.when(clamped, F.col("cap").cast("double")).otherwise(share) / F.lit(100.0)
    return ranked.select("source", "rank", "weight", "source_size", target.alias("target"))


def _fill(rows: DataFrame, room: DataFrame, turn: int) -> DataFrame:
    """Of ``rows`` (rank, bucket, h, size, free), in hash order, those that end inside their
    source's ``room`` (rank, gap) are picked: adds ``pick``."""
    fits = F.col("free") & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))
    rows = rows.join(room, "rank", "left").withColumn("add", F.when(fits, F.col("size")).otherwise(F.lit(0)))
    heads = rows.groupBy("rank", "bucket").agg(F.sum("add").alias("bucket_sum"))
    before = W.partitionBy("rank").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    heads = heads.select("rank", "bucket", F.coalesce(F.sum("bucket_sum").over(before), F.lit(0)).alias("head"))
    inside = W.partitionBy("rank", "bucket").orderBy("h", "size", "body").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("run", F.sum("add").over(inside)).join(heads, ["rank", "bucket"])
    pick = fits & (F.col("head") + F.col("run") <= F.col("gap"))
    rows = rows.withColumn("pick", F.coalesce(pick, F.lit(False)))
    return written(
        rows.withColumn("picked", F.col("picked") | F.col("pick"))
        .withColumn("free", F.col("free") & ~F.col("pick"))
        .drop("add", "head", "run", "pick", "gap"),
        f"fill{turn}",
    )


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    share_percent: int = 150,
    max_epochs: int = 2,
    seed: int = 17,
) -> DataFrame:
    """A row per document: id, source, body (a hash of its text), size, source_size, target, copies, taken."""
    ensure_columns(docs, id_col, source_col, text_col)
    tag = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("h")
    sizes = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col).cast("string")).alias("size"),
        F.xxhash64(F.col(text_col).cast("string")).alias("body"),
        tag,
    )
    sizes = written(sizes, "sizes")
    targets = written(source_targets(sizes, weights, share_percent, max_epochs), "targets")
    n_sources = targets.count()
    whole = F.floor(F.col("target") / F.col("source_size")).cast("long")
    plan = targets.withColumn("whole", F.when(F.col("source_size") > 0, whole).otherwise(F.lit(0).cast("long")))
    side = plan.select(F.col("source").alias("__source"), "rank", "source_size", "target", "whole")
    rows = sizes.join(small(side, n_sources, 512), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = (
        rows.withColumn("bucket", F.substring("h", 1, BUCKET_HEX))
        .withColumn("free", F.lit(True))
        .withColumn("picked", F.lit(False))
    )
    budget = plan.select(
        "rank", (F.floor(F.col("target")).cast("long") - F.col("whole") * F.col("source_size")).alias("budget")
    )
    for turn in range(FILLS):
        if turn:
            spent = rows.where("picked").groupBy("rank").agg(F.sum("size").alias("spent"))
            room = budget.join(spent, "rank", "left").select("rank", (F.col("budget") - F.coalesce("spent", F.lit(0))).alias("gap"))
        else:
            room = budget.select("rank", F.col("budget").alias("gap"))
        rows = _fill(rows, small(room, n_sources, 64), turn)
    copies = F.col("whole") + F.col("picked").cast("long")
    return rows.select(
        "id", "source", "body", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its plan says."""
    id_col, source_col, text_col = (options.get(f"{c}_col", d) for c, d in (("id", "doc_id"), ("source", "source"), ("text", "text")))
    plan = mix_plan(docs, **options)
    # rows that nothing tells apart in the plan are one entry: their copies in all, and how many they are
    every = plan.groupBy("id", "source", "body").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("twins"))
    other = written(every.where("copies <> twins"), "copies")
    names = {c: fresh(docs, f"__{c}") for c in ("id", "source", "body", "copies", "twins", "turn")}
    side = other.withColumnsRenamed({c: names[c] for c in other.columns})
    col = {c: F.col(name) for c, name in names.items()}
    body = F.xxhash64(docs[text_col].cast("string"))
    same = (
        docs[id_col].eqNullSafe(col["id"])
        & docs[source_col].cast("string").eqNullSafe(col["source"])
        & (body == col["body"])
    )
    joined = docs.join(small(side, other.count(), 96), same, "left")
    each = F.coalesce(F.floor(col["copies"] / col["twins"]), F.lit(1)).cast("int")
    odd = F.coalesce(col["copies"] % col["twins"], F.lit(0)) > 0
    uneven = joined.where(odd)
    if other.where("copies % twins > 0").limit(1).count():
        order = W.partitionBy(*[names[c] for c in ("id", "source", "body")]).orderBy(F.to_json(F.struct(*[docs[c] for c in docs.columns])))
        more = (F.row_number().over(order) <= col["copies"] % col["twins"]).cast("int")
        times = joined.where(~odd).withColumn(names["turn"], each).unionAll(uneven.withColumn(names["turn"], each + more))
    else:
        times = joined.withColumn(names["turn"], each)
    return times.withColumn(names["turn"], F.explode(F.array_repeat(F.lit(1), col["turn"]))).select(*docs.columns)
