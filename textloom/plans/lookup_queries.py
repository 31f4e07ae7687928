"""Queries over filtered reads, keys and details."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import lookups, resolve
from textloom.plans import adapters as A
from textloom.plans.registry import query


@query(f"""WITH {A.CUSTOMERS} SELECT pk, canonical_name, source_volume FROM customers WHERE status = 'provisional' AND source_volume = 2""")
def q_scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional entities of one volume."""
    return lookups.scan_entities(A.customers(spark, sf_dir), status="provisional", source_volume=2).select("pk", "canonical_name", "source_volume")


@query(f"""WITH {A.PAIRS}, {A.CUSTOMERS}, label AS (SELECT pk, canonical_name, printf('vol%02d', source_volume) AS s FROM customers)
SELECT candidate_pk, a, b, x.canonical_name AS a_name, x.s AS a_source, y.canonical_name AS b_name, y.s AS b_source
FROM pairs JOIN label x ON x.pk = a JOIN label y ON y.pk = b""")
def q_pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs with both sides' names."""
    pairs = A.pairs(spark, sf_dir).drop("decision").withColumn("name_score", F.lit(0))
    return lookups.pair_rows(pairs, A.customers(spark, sf_dir)).drop("name_score")


@query(f"""WITH {A.AUTHORITY}, names AS (SELECT DISTINCT reverse(split_part(p_name, ' ', 1)) || ' ' || split_part(p_name, ' ', 2) AS name FROM part),
s AS (SELECT name, canonical_name AS form, pk, {A.sorted_words_sql('name')} AS x, {A.sorted_words_sql('canonical_name')} AS y FROM names, authority),
l AS (SELECT *, length(x) + length(y) AS total, {A.lcs_sql('x', 'y')} AS common FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY common * 200.0 / total DESC, pk) AS rank FROM l WHERE common * 200 >= total * 50)
SELECT name, form, pk, common::INTEGER AS common, total::INTEGER AS total, rank::INTEGER AS rank FROM r WHERE rank <= 3""")
def q_top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best entries for each name."""
    word = lambda k: F.split_part("p_name", F.lit(" "), F.lit(k))
    names = A.table(spark, sf_dir, "part").select(F.concat(F.reverse(word(1)), F.lit(" "), word(2)).alias("name"))
    forms = A.authority(spark, sf_dir).select("pk", F.col("canonical_name").alias("form"))
    return lookups.top_names(names, forms, 3, 50).select("name", "form", "pk", "common", "total", "rank")


@query("""
WITH n AS (SELECT o_orderkey, o_orderkey % 8 AS volume FROM orders)
SELECT o_orderkey, volume, (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY volume, o_orderkey) AS pk FROM n""")
def q_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered after the keys in use."""
    rows = A.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 8).alias("volume"))
    return lookups.with_new_keys(rows, A.customers(spark, sf_dir), ["o_orderkey"])


@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'pending_review' WHEN 1 THEN 'resolved' ELSE 'new' END AS state,
  CASE event_id % 3 WHEN 2 THEN NULL ELSE 'p' || user_id END AS legacy_id,
  event_type IN ('', 'ok', 'add') AS exportable FROM events""")
def q_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored references by state."""
    e, k = A.table(spark, sf_dir, "events"), F.col("event_id") % 3
    user = F.concat(F.lit("p"), F.col("user_id").cast("string"))
    ref = F.when(k == 0, F.concat(F.lit("REVIEW:"), user)).when(k == 1, user).otherwise(" ")
    found = lookups.classify_reference(ref)
    return e.select("event_id", found["state"].alias("state"), found["legacy_id"].alias("legacy_id"), lookups.may_export(F.col("event_type")).alias("exportable"))


@query(f"""WITH {A.MENTIONS}, t AS (SELECT doc, list(struct_pack(o := ordinal, n := name) ORDER BY ordinal, name) AS l FROM (SELECT DISTINCT doc, ordinal, name FROM mentions) GROUP BY doc)
SELECT doc, array_to_string(list_transform(l, lambda x: x.o || '=' || x.n), '; ') AS links FROM t""")
def q_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's mentions in order."""
    m = A.mentions(spark, sf_dir).select("doc", "ordinal", "name").distinct()
    text = F.transform("links", lambda x: F.concat(x["ordinal"].cast("string"), F.lit("="), x["name"]))
    return lookups.children_of(m).select("doc", F.array_join(text, "; ").alias("links"))


@query(f"""WITH {A.AUTHORITY}, q AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'own' ELSE ' ' END AS wikidata_id, c_custkey % 90 AS k FROM customer)
SELECT id, CASE WHEN q.wikidata_id = 'own' THEN 'own' WHEN a.pk % 2 = 0 THEN 'Q' || a.pk WHEN a.pk IS NOT NULL THEN '' END AS wikidata_id,
  CASE WHEN q.wikidata_id = 'own' THEN 'kept' WHEN a.pk % 2 = 0 THEN 'filled' ELSE 'unmatched' END AS status FROM q LEFT JOIN authority a ON a.pk = k""")
def q_fill_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank identifiers taken from the entries that rows were matched with."""
    k = F.col("c_custkey")
    rows = A.table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 4 == 0, "own").otherwise(" ").alias("wikidata_id"))
    entries = A.authority(spark, sf_dir).select("pk", "wikidata_id")
    matches = A.table(spark, sf_dir, "customer").select(k.alias("id"), (k % 90).alias("pk")).join(entries, "pk")
    return lookups.fill_from_match(rows, matches, "wikidata_id")


@query()
def q_marked_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings against the entries they were matched with, differences marked."""
    entries = A.authority(spark, sf_dir).withColumn("variant_names", F.lit(""))
    m = A.mentions(spark, sf_dir).select("name").distinct().withColumns({"doc": F.lit(1), "ordinal": F.lit(1)})
    found = resolve.fuzzy_best(m, resolve.forms_last_wins(entries)).where("matched_form is not null")
    both = lookups.marked(F.col("name"), F.col("matched_form"))
    return found.select("name", "matched_form", both["a"].alias("name_html"), both["b"].alias("match_html"))
