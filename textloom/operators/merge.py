"""Merging entities: every group's rows become its survivor, and whatever pointed at a dropped row
points at the survivor. A mapping (dropped pk, survivor pk) drives all of it at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.strings import split_plain, strip


def survivors(groups: DataFrame) -> DataFrame:
    """``groups``: grp, pk. pk, survivor: the smallest of the group."""
    smallest = groups.groupBy("grp").agg(F.min("pk").alias("survivor"))
    return groups.join(smallest, "grp").select("pk", "survivor")


def united_lists(rows: DataFrame, key: str, lists: list[tuple[str, int, Column]], *order: str) -> DataFrame:
    """A row per ``key`` that has items: for each name in ``lists`` (name, turn, ``;``-list), an
    array of the distinct items, whatever their case, in the spelling and place of the first. Lists
    come by turn, then by the columns ``order``. Items are rows until they are distinct."""
    every = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(k).alias("k"), v.cast("string").alias("v")) for c, k, v in lists])
    cut = rows.select(key, *order, F.explode(every).alias("l"))
    items = cut.select(key, *order, "l.c", "l.k", F.posexplode(split_plain(F.col("l.v"))).alias("i", "item"))
    first = F.min(F.struct("k", *order, "i", "item")).alias("first")
    distinct = items.groupBy(key, "c", F.lower("item").alias("lowered")).agg(first)
    names = list(dict.fromkeys(c for c, _, _ in lists))
    ordered = [F.array_sort(F.collect_list(F.when(F.col("c") == c, F.col("first")))) for c in names]
    return distinct.groupBy(key).agg(*[F.transform(o, lambda x: x["item"]).alias(c) for o, c in zip(ordered, names, strict=True)])


def first_nonblank(value: Column, order: Column) -> Column:
    """An aggregate: the first value that isn't blank, as it is; empty if all are."""
    return F.coalesce(F.min_by(value, F.when(strip(F.coalesce(value, F.lit(""))) != "", order)), F.lit(""))


def merge_rows(
    rows: DataFrame,
    mapping: DataFrame,
    name: str = "canonical_name",
    variants: str = "variant_names",
    unions: tuple[str, ...] = ("notes", "sources", "associated_places"),
    firsts: tuple[str, ...] = ("patronymic", "occupation", "title", "gender", "wikidata_id"),
    least: tuple[str, ...] = ("floruit_start",),
    most: tuple[str, ...] = ("floruit_end",),
    first_known: tuple[str, ...] = (),
) -> DataFrame:
    """``rows``: pk, source_volume, merged_volumes and the columns named. One row per survivor and
    per row that the mapping doesn't name. The survivor comes first, the others by pk."""
    tied = rows.join(mapping, "pk", "left").withColumn("survivor", F.coalesce("survivor", "pk"))
    is_other = (F.col("pk") != F.col("survivor")).cast("int")
    order = F.struct(is_other, F.col("pk"))
    out = tied.groupBy("survivor").agg(
        F.min_by(name, order).alias(name),
        F.min_by(F.struct("source_volume"), order).alias("own"),
        *[first_nonblank(F.col(c), order).alias(c) for c in firsts],
        *[F.min(c).alias(c) for c in least],
        *[F.max(c).alias(c) for c in most],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in first_known],
    )
    other = F.col("x") == 1
    lists = [(c, 0, F.col(c)) for c in (*unions, variants, "merged_volumes")]
    lists += [(variants, 1, F.when(other, F.col(name))), ("merged_volumes", 1, F.when(other, F.col("source_volume")))]
    united = united_lists(tied.withColumn("x", is_other), "survivor", lists, "x", "pk")
    none = F.array().cast("array<string>")
    items = lambda c: F.coalesce(united[c], none)
    out = out.join(united, "survivor", "left")
    own_name = F.lower(strip(F.col(name)))
    own_volume = F.coalesce(F.col("own.source_volume").cast("string"), F.lit(""))
    return out.select(
        F.col("survivor").alias("pk"),
        name,
        F.array_join(F.filter(items(variants), lambda x: F.lower(x) != own_name), ";").alias(variants),
        *[F.array_join(items(c), ";").alias(c) for c in unions], *firsts, *least, *most, *first_known,
        F.col("own.source_volume").alias("source_volume"),
        F.array_join(F.filter(items("merged_volumes"), lambda x: x != own_volume), ";").alias("merged_volumes"),
    )


def relink(rows: DataFrame, mapping: DataFrame, *columns: str) -> DataFrame:
    """Foreign keys in ``columns`` that name a dropped row name its survivor."""
    for c in columns:
        to = mapping.select(F.col("pk").alias("__pk"), F.col("survivor").alias("__survivor"))
        rows = rows.join(to, F.col(c) == F.col("__pk"), "left").withColumn(c, F.coalesce("__survivor", c)).drop("__pk", "__survivor")
    return rows


def relink_pairs(pairs: DataFrame, mapping: DataFrame) -> DataFrame:
    """Candidate pairs after a merge: smaller end first, none with itself, each once (a decided row
    before an undecided one, then the smaller candidate_pk)."""
    moved = relink(pairs, mapping, "a", "b").withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")}).where("a < b")
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    best = F.min_by(F.struct(*rest), F.struct((F.col("decision") == "").cast("int"), F.col("candidate_pk")))
    return moved.groupBy("a", "b").agg(best.alias("r")).select("a", "b", *[F.col(f"r.{c}").alias(c) for c in rest])


def rewrite_tokens(texts: DataFrame, mapping: DataFrame, col: str, key: str) -> DataFrame:
    """``[old]`` in a text column becomes ``[survivor]``. Texts are cut at brackets, looked up and
    joined again, so any number of tokens is rewritten in one pass. ``key`` is unique in ``texts``."""
    parts = texts.select(F.col(key).alias("__row"), F.posexplode(F.split(col, r"(?=\[)|(?<=\])")).alias("n", "part"))
    to = mapping.select(F.concat(F.lit("["), F.col("pk").cast("string"), F.lit("]")).alias("part"), F.concat(F.lit("["), F.col("survivor").cast("string"), F.lit("]")).alias("new"))
    new = parts.join(to, "part", "left").select("__row", "n", F.coalesce("new", "part").alias("part"))
    joined = new.groupBy("__row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "part"))), lambda x: x["part"]), "").alias("__text"))
    return texts.join(joined, texts[key] == F.col("__row"), "left").withColumn(col, F.col("__text")).drop("__row", "__text")
