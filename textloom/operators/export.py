"""Denormalised rows for export, and small aggregations that they and the reports use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.strings import blank_to_null, or_empty, split_plain, strip


def first_where(value: Column, order: Column, condition: Column) -> Column:
    """An aggregate: the value of the first row that fits."""
    return F.min_by(value, F.when(condition, order))


def by_role(role: Column, name: Column, ordinal: Column) -> Column:
    """An aggregate: ``role: a, b; role2: c``, roles and names in order; a blank role is unknown."""
    label = F.coalesce(blank_to_null(role), F.lit("unknown"))
    rows = F.array_sort(F.collect_list(F.struct(ordinal.alias("o"), label.alias("r"), or_empty(name).alias("n"))))
    roles = F.array_distinct(F.transform(rows, lambda x: x["r"]))
    names = lambda r: F.array_join(F.transform(F.filter(rows, lambda x: x["r"] == r), lambda x: x["n"]), ", ")
    return F.array_join(F.transform(roles, lambda r: F.concat(r, F.lit(": "), names(r))), "; ")


def document_rows(documents: DataFrame, persons: DataFrame, places: DataFrame, person_ids: DataFrame, place_ids: DataFrame) -> DataFrame:
    """``documents``: doc and more (only those to export); ``persons``: doc, ordinal, role, name, pk;
    ``places``: doc, ordinal, role, pk; ``*_ids``: pk, display_id. Adds grantor_id, recipient_id,
    persons_by_role, location_written_id, locations_mentioned_ids."""
    role, o = F.lower(or_empty(F.col("role"))), F.struct("ordinal", "name")
    with_id = persons.join(person_ids.select("pk", "display_id"), "pk", "left").withColumn("id", or_empty(F.col("display_id")))
    shown = F.when(F.col("pk").isNotNull(), F.concat("name", F.lit(" ["), "id", F.lit("]"))).otherwise(F.col("name"))
    p = with_id.groupBy("doc").agg(
        first_where(F.col("id"), o, F.contains(role, F.lit("issuer"))).alias("grantor_id"),
        first_where(F.col("id"), o, role == "recipient").alias("recipient_id"),
        by_role(F.col("role"), shown, F.col("ordinal")).alias("persons_by_role"),
    )
    where = places.join(place_ids.select("pk", "display_id"), "pk", "left").withColumn("id", or_empty(F.col("display_id")))
    o = F.struct("ordinal", "id")
    known = F.array_sort(F.collect_list(F.when(F.col("display_id").isNotNull(), F.struct(F.col("ordinal").alias("o"), F.col("id").alias("i")))))
    q = where.groupBy("doc").agg(
        first_where(F.col("id"), o, F.col("role") == "loc.writing").alias("writing"),
        first_where(F.col("id"), o, F.col("role") == "loc.hearing").alias("hearing"),
        F.array_join(F.array_distinct(F.transform(known, lambda x: x["i"])), "; ").alias("locations_mentioned_ids"),
    )
    q = q.withColumn("location_written_id", F.coalesce(F.nullif("writing", F.lit("")), "hearing", F.lit(""))).drop("writing", "hearing")
    text = ["grantor_id", "recipient_id", "persons_by_role", "location_written_id", "locations_mentioned_ids"]
    return documents.join(p, "doc", "left").join(q, "doc", "left").fillna("", text)


def exportable(documents: DataFrame, flags: DataFrame) -> DataFrame:
    """Documents with nothing to review and no error."""
    clear = flags.where("has_review_persons = 0 and has_review_places = 0").select("doc")
    return documents.where("has_parse_error = 0").join(clear, "doc", "left_semi")


def authority_rows(entities: DataFrame, columns: list[str]) -> DataFrame:
    link = F.when(strip(or_empty(F.col("wikidata_id"))) != "", F.concat(F.lit("https://www.wikidata.org/wiki/"), strip(F.col("wikidata_id"))))
    return entities.where("status = 'canonical'").select(*columns, F.coalesce(link, F.lit("")).alias("link"))


def seed_rows(rows: DataFrame, id_col: str, name_col: str, variants_col: str) -> DataFrame:
    """Rows with an identifier and a name; variants once each, without the name itself."""
    name = F.lower(strip(F.col(name_col)))
    kept = F.filter(F.array_distinct(split_plain(F.col(variants_col))), lambda x: F.lower(x) != name)
    rows = rows.where(blank_to_null(F.col(id_col)).isNotNull() & blank_to_null(F.col(name_col)).isNotNull())
    return rows.withColumn(variants_col, F.array_join(kept, "; "))


def frequency(rows: DataFrame, key: str, example: str, order: str) -> DataFrame:
    """key, n, first_example, first_pos; the commonest first, of equal ones the first seen."""
    out = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min_by(example, order).alias("first_example"), F.min(order).alias("first_pos")
    )
    return out.orderBy(F.desc("n"), "first_pos")


def repeated(tables: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Keys that occur more than once over all tables."""
    every = tables[0][1].select(key)
    for _, t in tables[1:]:
        every = every.unionAll(t.select(key))
    return every.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def volumes_of(*columns: tuple[DataFrame, str]) -> DataFrame:
    """Distinct volumes over several tables' columns."""
    every = columns[0][0].select(F.col(columns[0][1]).cast("long").alias("volume"))
    for t, c in columns[1:]:
        every = every.union(t.select(F.col(c).cast("long")))
    return every.where("volume is not null").distinct()


# The columns of the flat export, in its order.
NAME_COLUMNS = [
    "charter_id", "shelfmark", "di_reference", "date", "date_uncertain", "doc_type", "subject", "outcome", "persons_by_role", "scribe",
    "scribe_source", "location_written", "location_hearing", "locations_mentioned_ids", "seal_info", "language", "grantor_id", "recipient_id",
]


def name_rows(documents: DataFrame, persons: DataFrame, places: DataFrame, person_ids: DataFrame, place_ids: DataFrame) -> DataFrame:
    """As ``document_rows``, for a flat export with names as they were written: ``places`` have a
    name too. Adds grantor_id, recipient_id, persons_by_role (names only), location_written and
    location_hearing (names), locations_mentioned_ids."""
    role, o = F.lower(or_empty(F.col("role"))), F.struct("ordinal", "name")
    with_id = persons.join(person_ids.select("pk", "display_id"), "pk", "left").withColumn("id", or_empty(F.col("display_id")))
    p = with_id.groupBy("doc").agg(
        first_where(F.col("id"), o, F.contains(role, F.lit("issuer"))).alias("grantor_id"),
        first_where(F.col("id"), o, role == "recipient").alias("recipient_id"),
        by_role(F.col("role"), F.col("name"), F.col("ordinal")).alias("persons_by_role"),
    )
    where = places.join(place_ids.select("pk", "display_id"), "pk", "left")
    known = F.array_sort(F.collect_list(F.when(F.col("display_id").isNotNull(), F.struct(F.col("ordinal").alias("o"), F.col("display_id").alias("i")))))
    q = where.groupBy("doc").agg(
        first_where(or_empty(F.col("name")), o, F.col("role") == "loc.writing").alias("location_written"),
        first_where(or_empty(F.col("name")), o, F.col("role") == "loc.hearing").alias("location_hearing"),
        F.array_join(F.array_distinct(F.transform(known, lambda x: x["i"])), "; ").alias("locations_mentioned_ids"),
    )
    text = ["grantor_id", "recipient_id", "persons_by_role", "location_written", "location_hearing", "locations_mentioned_ids"]
    return documents.join(p, "doc", "left").join(q, "doc", "left").fillna("", text)


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by class, the commonest first; null is a class."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *keys)
