"""The review queue: what is open, in which order, and what decisions change. Every function takes
tables and gives new ones; ``sources.store`` publishes them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TYPES = ("person_review", "place_review", "person_dup", "place_dup", "entity")


def queue_index(items: dict[str, DataFrame]) -> DataFrame:
    """``items``: by type, tables of item_id, name, score, volume, decision and more. The undecided
    ones as one view: item_type, item_id, name, score, volume, search_text."""
    parts = []
    for kind in TYPES:
        if kind in items:
            rows = items[kind].where(F.coalesce("decision", F.lit("")) == "")
            text = F.lower(F.concat_ws(" ", F.coalesce("name", F.lit("")), F.lit(kind)))
            parts.append(rows.select(F.lit(kind).alias("item_type"), "item_id", "name", "score", "volume", text.alias("search_text")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def filter_queue(index: DataFrame, search: str = "", volumes: list[int] | None = None, types: list[str] | None = None) -> DataFrame:
    rows = index.where(F.contains("search_text", F.lit(search.lower()))) if search else index
    rows = rows.where(F.col("volume").isin(volumes)) if volumes else rows
    return rows.where(F.col("item_type").isin(types)) if types else rows


def queue_order(sort: str = "type") -> list:
    """Columns to order a queue by; every order ends with the item's identity."""
    kind = F.array_position(F.array(*[F.lit(x) for x in TYPES]), F.col("item_type"))
    first = {"score_desc": [F.desc_nulls_last("score")], "score_asc": [F.asc_nulls_last("score")], "name": [F.asc("name")], "type": []}[sort]
    return [*first, kind, F.asc("item_id")]


def page(index: DataFrame, sort: str, start: int, size: int) -> DataFrame:
    return index.orderBy(*queue_order(sort)).offset(start).limit(size)


def review_flags(documents: DataFrame, persons: DataFrame, places: DataFrame) -> DataFrame:
    """Whether any of a document's links is pending: doc, has_review_persons, has_review_places."""
    flag = lambda rows, name: rows.groupBy("doc").agg(F.max((F.col("resolution_state") == "pending_review").cast("int")).alias(name))
    out = documents.join(flag(persons, "has_review_persons"), "doc", "left").join(flag(places, "has_review_places"), "doc", "left")
    return out.fillna(0, ["has_review_persons", "has_review_places"])


def status_badge(*flags: str):
    """Active flags joined by " + ", or OK."""
    parts = F.concat_ws(" + ", *[F.when(F.col(f) == 1, F.lit(f)) for f in flags])
    return F.when(parts == "", "OK").otherwise(parts)


def record_decisions(items: DataFrame, decisions: DataFrame) -> DataFrame:
    """``decisions``: item_id, decision. Open items take theirs; nothing else changes."""
    new = decisions.groupBy("item_id").agg(F.max("decision").alias("__new"))
    rows = items.join(new, "item_id", "left")
    take = (F.col("status") == "open") & F.col("__new").isNotNull()
    return rows.withColumn("decision", F.when(take, F.col("__new")).otherwise(F.col("decision"))).drop("__new")


def apply_decisions(items: DataFrame, links: DataFrame, next_pk: int, volumes: list[int] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``items``: item_id, link_id, volume, name, match_pk, decision, status; ``links``: link_id, pk,
    resolution_state. Accepted items link to their match, rejected ones to a new provisional entity
    (numbered by item_id from ``next_pk``). Items, links and the new entities."""
    mine = (F.col("status") == "open") & F.col("decision").isin("accept", "reject")
    mine = mine & F.col("volume").isin(volumes) if volumes else mine
    done = items.where(mine)
    # new numbers: the order inside a volume, after the volumes before it
    rejected = done.where("decision = 'reject'")
    sizes = rejected.groupBy("volume").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("volume").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("volume", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rn = F.row_number().over(W.partitionBy("volume").orderBy("item_id"))
    rejected = rejected.withColumn("rn", rn).join(sizes, "volume")
    minted = rejected.select(
        "item_id", "link_id", "volume", "name", (F.col("before") + F.col("rn") - 1 + next_pk).alias("pk"),
        F.concat(F.lit("REJECTED-"), F.col("item_id").cast("string")).alias("legacy_id"), F.lit("provisional").alias("status"),
    )
    outcome = done.where("decision = 'accept'").select("item_id", "link_id", F.col("match_pk").alias("outcome_pk")).unionAll(
        minted.select("item_id", "link_id", "pk")
    )
    closed = items.join(outcome.select("item_id", "outcome_pk"), "item_id", "left")
    closed = closed.withColumn("status", F.when(F.col("outcome_pk").isNotNull(), "resolved").otherwise(F.col("status")))
    moved = links.join(outcome.select("link_id", F.col("outcome_pk").alias("__pk")), "link_id", "left")
    moved = moved.withColumn("resolution_state", F.when(F.col("__pk").isNotNull(), "resolved").otherwise(F.col("resolution_state")))
    return closed, moved.withColumn("pk", F.coalesce("__pk", "pk")).drop("__pk"), minted


def decide_place_pairs(candidates: DataFrame, places: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``decisions``: candidate_pk, decision. The candidates with their decisions; places take a
    candidate's external_id where theirs is blank and the decision is "same"."""
    new = decisions.groupBy("candidate_pk").agg(F.max("decision").alias("__new"))
    rows = candidates.join(new, "candidate_pk", "left").withColumn("decision", F.coalesce("__new", "decision")).drop("__new")
    same = rows.where("decision = 'same'").groupBy("pk").agg(F.min_by("external_id", "candidate_pk").alias("__id"))
    filled = places.join(same, "pk", "left").withColumn("external_id", F.coalesce(F.nullif("external_id", F.lit("")), "__id", F.lit("")))
    return rows, filled.drop("__id")


def send_to_final_review(entities: DataFrame, pairs: DataFrame) -> DataFrame:
    """Provisional entities of pairs decided as different are marked to be added."""
    ends = pairs.where("decision = 'different'").select(F.explode(F.array("a", "b")).alias("pk")).distinct().withColumn("__add", F.lit(True))
    rows = entities.join(ends, "pk", "left")
    add = F.col("__add").isNotNull() & (F.col("status") == "provisional")
    return rows.withColumn("review_status", F.when(add, "add").otherwise(F.col("review_status"))).drop("__add")


def apply_actions(entities: DataFrame, commands: DataFrame) -> DataFrame:
    """``commands``: pk, action (ok, add, skip or no_match; the last by ``at``) set review_status."""
    last = commands.where(F.col("action").isin("ok", "add", "skip", "no_match")).groupBy("pk").agg(F.max_by("action", "at").alias("__act"))
    return entities.join(last, "pk", "left").withColumn("review_status", F.coalesce("__act", "review_status")).drop("__act")


#: What a reviewer may do with an item of each kind. "next" is offered for all and changes nothing.
STATUSES = {"new_person": ("ok", "add", "skip"), "new_place": ("ok", "add", "skip", "no_match")}
ACTIONS = {
    **{kind: (*statuses, "merge") for kind, statuses in STATUSES.items()},
    "person_dup": ("same", "different", "merge"),
    "place_dup": ("same", "different"),
    "review_item": ("accept", "reject"),
}


def dispatch(
    commands: DataFrame, persons: DataFrame, places: DataFrame, person_pairs: DataFrame, place_pairs: DataFrame, items: DataFrame
) -> dict[str, DataFrame]:
    """``commands``: at, item_type, item_id, match_pk, action; the last one for an item counts.
    Persons and places (pk, review_status), pairs (candidate_pk, a, b, decision) and review items
    (item_id, decision, status) as the commands leave them; ``person_merges`` and ``place_merges``,
    mappings (pk, survivor) for ``merge.merge_rows`` and ``merge.relink`` (a pair merges into its
    smaller end, and is decided as same); ``refused``: commands that no item of their kind takes."""
    last = commands.groupBy("item_type", "item_id").agg(F.max_by(F.struct("at", "match_pk", "action"), "at").alias("c")).select("item_type", "item_id", "c.*")
    allowed = reduce(lambda x, y: x | y, [(F.col("item_type") == k) & F.col("action").isin("next", *v) for k, v in ACTIONS.items()])
    valid = last.where(allowed)
    refused = commands.join(last.where(~F.coalesce(allowed, F.lit(False))).select("item_type", "item_id", "at"), ["item_type", "item_id", "at"], "left_semi")

    def of(kind: str, *actions: str) -> DataFrame:
        return valid.where((F.col("item_type") == kind) & F.col("action").isin(*actions))

    def with_status(rows: DataFrame, kind: str) -> DataFrame:
        return apply_actions(rows, of(kind, *STATUSES[kind]).select(F.col("item_id").alias("pk"), "action", "at"))

    def decided(pairs: DataFrame, kind: str) -> DataFrame:
        act = F.when(F.col("action") == "merge", "same").otherwise(F.col("action")).alias("__new")
        new = of(kind, "same", "different", "merge").select(F.col("item_id").alias("candidate_pk"), act)
        return pairs.join(new, "candidate_pk", "left").withColumn("decision", F.coalesce("__new", "decision")).drop("__new")

    into = lambda kind: of(kind, "merge").where("match_pk is not null").select(F.col("item_id").alias("pk"), F.col("match_pk").alias("survivor"))
    ends = person_pairs.join(of("person_dup", "merge").select(F.col("item_id").alias("candidate_pk")), "candidate_pk", "left_semi")
    return {
        "persons": with_status(persons, "new_person"),
        "places": with_status(places, "new_place"),
        "person_pairs": decided(person_pairs, "person_dup"),
        "place_pairs": decided(place_pairs, "place_dup"),
        "items": record_decisions(items, of("review_item", "accept", "reject").select("item_id", F.col("action").alias("decision"))),
        "person_merges": into("new_person").unionAll(ends.select(F.greatest("a", "b").alias("pk"), F.least("a", "b").alias("survivor"))).distinct(),
        "place_merges": into("new_place"),
        "refused": refused,
    }


def purge(volume: int, documents: DataFrame, children: dict[str, DataFrame], entities: DataFrame, pairs: DataFrame) -> dict[str, DataFrame]:
    """The tables without a volume: its documents, what hangs on them, its provisional entities and
    the pairs that name one of those. Children have ``doc``."""
    gone = documents.where(F.col("volume") == volume).select("doc")
    out = {"documents": documents.where(F.col("volume") != volume)}
    out |= {name: rows.join(gone, "doc", "left_anti") for name, rows in children.items()}
    dropped = entities.where((F.col("status") == "provisional") & (F.col("source_volume") == volume)).select("pk")
    out["entities"] = entities.join(dropped, "pk", "left_anti")
    ends = pairs.select("candidate_pk", F.explode(F.array("a", "b")).alias("pk")).join(dropped, "pk", "left_semi").select("candidate_pk")
    out["pairs"] = pairs.join(ends.distinct(), "candidate_pk", "left_anti")
    return out


def changed_rows(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows that differ from a snapshot: key, changes (column to new value)."""
    old = before.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    both = after.join(old, F.col(key) == F.col("__key"))
    changes = [F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))) for c in columns]
    found = both.select(key, F.map_from_entries(F.filter(F.array(*changes), lambda x: x.isNotNull())).alias("changes"))
    return found.where(F.size("changes") > 0)


def integrity(entities: DataFrame, links: DataFrame, pairs: DataFrame) -> DataFrame:
    """check, n: broken references, repeated identifiers, pairs out of order or repeated. All 0 if sound."""
    broken = links.where("pk is not null").join(entities.select("pk"), "pk", "left_anti")
    repeated = entities.groupBy("display_id").count().where("count > 1")
    wrong = pairs.where("a >= b")
    twice = pairs.groupBy("a", "b").count().where("count > 1")
    checks = {"broken_links": broken, "repeated_ids": repeated, "pairs_out_of_order": wrong, "repeated_pairs": twice}
    return reduce(DataFrame.unionAll, [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("check"), "n") for k, rows in checks.items()])


def split_counts(entities: DataFrame, splits: DataFrame) -> DataFrame:
    """``splits``: old_id, new_display_id. For each split identifier the entities that have it, how
    many there should be (itself and one for each new one), and whether they are as many."""
    wanted = splits.groupBy("old_id").agg((F.count(F.lit(1)) + 1).alias("n_wanted"))
    there = entities.groupBy(F.col("legacy_id").alias("old_id")).agg(F.count(F.lit(1)).alias("n_there"))
    rows = wanted.join(there, "old_id", "left").fillna(0, ["n_there"])
    return rows.withColumn("agree", F.col("n_there") == F.col("n_wanted"))


def spot_check(rows: DataFrame, key: str, n: int = 10, seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash of their key: the same ones whatever the partitioning."""
    tag = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return rows.withColumn("tag", tag).orderBy("tag", key).limit(n).drop("tag")
