"""Filtered reads, keys for new rows, and the small joins that lists and details are made of."""

from __future__ import annotations

import difflib
import html
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.strings import blank_to_null, or_empty, strip
from textloom.operators.reconcile import prefer
from textloom.operators.resolve import scored_pairs

# Fixed value: from this score on, merging with the match is what a reviewer is offered first.
SUGGEST = 90


def where_equal(df: DataFrame, **values) -> DataFrame:
    """Rows that have all the values given; arguments that are None don't filter."""
    for name, value in values.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def scan_entities(entities: DataFrame, status: str | None = None, source_volume: int | None = None, review_status: str | None = None) -> DataFrame:
    return where_equal(entities, status=status, source_volume=source_volume, review_status=review_status).orderBy("pk")


def scan_documents(documents: DataFrame, has_review: bool | None = None) -> DataFrame:
    """All documents, those with any flag, or those with none; by volume and sequence."""
    flagged = (F.col("has_review_persons") == 1) | (F.col("has_review_places") == 1) | (F.col("has_parse_error") == 1)
    rows = documents if has_review is None else documents.where(flagged if has_review else ~flagged)
    return rows.orderBy("volume", "sequence")


def children_of(links: DataFrame, key: str = "doc") -> DataFrame:
    """Each document's links as one array, by ordinal."""
    others = [c for c in links.columns if c not in (key, "ordinal")]
    return links.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ordinal", *others))).alias("links"))


def with_new_keys(rows: DataFrame, used: DataFrame, order: list[str], key: str = "pk", part: str = "volume") -> DataFrame:
    """``rows`` numbered after the largest key in ``used``: inside a part by ``order``, parts in turn."""
    start = used.agg(F.coalesce(F.max(key), F.lit(0)).alias("__start"))
    inside = F.row_number().over(W.partitionBy(part).orderBy(*order))
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col(part).alias("__part"), before.alias("__before")).join(F.broadcast(start), F.lit(True))  # one row
    numbered = rows.withColumn("__rn", inside).join(sizes, F.col(part).eqNullSafe(F.col("__part")))
    return numbered.withColumn(key, (F.col("__start") + F.col("__before") + F.col("__rn")).cast("long")).drop("__rn", "__part", "__before", "__start")


def source_label(volume: Column) -> Column:
    return F.when(volume.isNull(), "authority").otherwise(F.format_string("vol%02d", volume.cast("int")))


def renamed(df: DataFrame, names: dict[str, str | tuple[str, ...]]) -> DataFrame:
    """New name to old name, or to several of which the first that isn't blank is taken."""
    columns = []
    for new, old in names.items():
        choices = [F.col(old)] if isinstance(old, str) else [*(blank_to_null(F.col(o)) for o in old), F.lit("")]
        columns.append(F.coalesce(*choices).alias(new))
    return df.select(*columns)


def may_export(review_status: Column) -> Column:
    return F.lower(strip(or_empty(review_status))).isin("", "ok", "add")


def pair_rows(pairs: DataFrame, persons: DataFrame) -> DataFrame:
    """Candidate pairs with both persons' names and sources; the best scores first."""
    side = lambda k: persons.select(F.col("pk").alias(k), F.col("canonical_name").alias(f"{k}_name"), source_label(F.col("source_volume")).alias(f"{k}_source"))
    return pairs.join(side("a"), "a").join(side("b"), "b").orderBy(F.desc("name_score"), "candidate_pk")


def top_names(mentions: DataFrame, forms: DataFrame, k: int, least: int = 1) -> DataFrame:
    """``mentions``: name; ``forms``: form, pk. The k best forms for each distinct name: name, form,
    pk, common, total, rank; of equal scores the smaller pk first."""
    pairs = scored_pairs(mentions.select("name").where("name <> ''").distinct(), forms, least)
    order = [F.desc(F.col("common") * 200.0 / F.col("total")), F.asc("pk"), F.asc("form")]
    return pairs.withColumn("rank", F.row_number().over(W.partitionBy("name").orderBy(*order))).where(F.col("rank") <= k)


def suggest(items: DataFrame, forms: DataFrame) -> DataFrame:
    """``items``: item_id, name. Adds the best match, and what a reviewer is offered first."""
    best = top_names(items, forms, 1).select("name", "form", "pk", (F.col("common") * 200.0 / F.col("total")).alias("score"))
    rows = items.join(best, "name", "left")
    return rows.withColumn("suggestion", F.when(F.col("score") >= SUGGEST, "merge").otherwise("add"))


def classify_reference(ref: Column) -> Column:
    """A stored reference: ``REVIEW:n`` is pending, a number resolved, blank new."""
    text = strip(or_empty(ref))
    pending = F.regexp_extract(text, r"^REVIEW:(.+)$", 1)
    state = F.when(pending != "", "pending_review").when(text != "", "resolved").otherwise("new")
    return F.struct(state.alias("state"), F.nullif(F.when(pending != "", pending).otherwise(text), F.lit("")).alias("legacy_id"))


def split_identifiers(rows: DataFrame, splits: DataFrame, id_col: str = "place_id", by: str = "canonical_name") -> DataFrame:
    """``splits``: old_id, disambiguator, new_display_id. Rows of an identifier that stands for several
    things get the new one that their disambiguator names."""
    s = splits.select(F.col("old_id").alias("__old"), F.lower(strip(F.col("disambiguator"))).alias("__by"), "new_display_id")
    joined = rows.join(s, (F.col(id_col) == F.col("__old")) & (F.lower(strip(F.col(by))) == F.col("__by")), "left")
    return joined.withColumn(id_col, F.coalesce("new_display_id", id_col)).drop("__old", "__by", "new_display_id")


def fill_from_match(rows: DataFrame, matches: DataFrame, column: str) -> DataFrame:
    """``matches``: id, pk and the column. Blank values are taken from what the row was matched with;
    adds ``status``: kept, filled or unmatched."""
    m = matches.select(F.col("id"), F.col(column).alias("__value"))
    joined = rows.join(m, "id", "left")
    state = F.when(blank_to_null(F.col(column)).isNotNull(), "kept").when(blank_to_null(F.col("__value")).isNotNull(), "filled").otherwise("unmatched")
    return joined.withColumns({"status": state, column: prefer(F.col(column), F.col("__value"))}).drop("__value")


def corrections(rows: DataFrame, matches: DataFrame, columns: list[str], apply: bool = False) -> DataFrame:
    """``rows``: id, review_status and columns; ``matches``: id, pk, strategy and the columns as the
    authority has them. Annotates each row with pk, ``strategy``, ``changes`` (columns that differ)
    and ``correction``: unmatched, unchanged, held (its review bars it) or, unless ``apply`` is
    false, corrected; a dry run says would_correct and leaves the values."""
    m = matches.select("id", "pk", "strategy", *[F.col(c).alias(f"__{c}") for c in columns])
    both = rows.join(m, "id", "left")
    differs = {c: blank_to_null(F.col(f"__{c}")).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns}
    changes = F.concat_ws(",", *[F.when(F.coalesce(d, F.lit(False)), F.lit(c)) for c, d in differs.items()])
    both = both.withColumn("changes", changes)
    state = (
        F.when(F.col("pk").isNull(), "unmatched")
        .when(F.col("changes") == "", "unchanged")
        .when(~may_export(F.col("review_status")), "held")
        .otherwise("corrected" if apply else "would_correct")
    )
    both = both.withColumn("correction", state)
    if apply:
        both = both.withColumns({c: F.when((F.col("correction") == "corrected") & blank_to_null(F.col(f"__{c}")).isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns})
    return both.drop(*[f"__{c}" for c in columns])


def extract(segments: DataFrame, extractor: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], done: DataFrame | None = None) -> DataFrame:
    """``segments``: filename, text. Each segment that isn't done without an error, given to a hook that
    maps frames of both columns to frames of filename and reply."""
    if done is not None:
        segments = segments.join(done.where("error is null").select("filename"), "filename", "left_anti")
    return segments.select("filename", "text").mapInPandas(extractor, "filename string, reply string")


def mark_changes(a: str | None, b: str | None) -> tuple[str, str]:
    """Both texts as HTML, with what is different marked."""
    a, b = a or "", b or ""
    left, right = [], []
    for kind, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        for out, part in ((left, a[i:j]), (right, b[k:m])):
            text = html.escape(part)
            out.append(text if kind == "equal" or not part else f"<mark>{text}</mark>")
    return "".join(left), "".join(right)


@F.pandas_udf(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))
def marked(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([mark_changes(x, y) for x, y in zip(a, b, strict=True)], columns=["a", "b"])
