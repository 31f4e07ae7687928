"""Queries over the steps between extraction and export: minting, review actions, corrections, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import strings as S
from textloom.operators import duplicates, export, geomatch, lookups, merge, reconcile, resolve, review
from textloom.plans import adapters as A
from textloom.plans.registry import query


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, ordinal, role, name, pk: lines of orders as links to suppliers."""
    k, p = F.col("l_linenumber"), F.col("l_partkey")
    role = F.when(k % 3 == 0, "Issuer").when(k % 3 == 1, "recipient").otherwise("")
    return A.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc"), k.alias("ordinal"), role.alias("role"), F.concat(F.lit("n"), p.cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("name"),
        F.when(p % 4 != 0, F.col("l_suppkey")).alias("pk"),
    )


LINKS = """links AS (SELECT l_orderkey AS doc, l_linenumber AS ordinal,
  CASE WHEN l_linenumber % 3 = 0 THEN 'Issuer' WHEN l_linenumber % 3 = 1 THEN 'recipient' ELSE '' END AS role,
  'n' || l_partkey || '-' || l_suppkey AS name, CASE WHEN l_partkey % 4 <> 0 THEN l_suppkey END AS pk FROM lineitem)"""


def _spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, ordinal, role, name, pk: lines of orders as links to places; some places have no entry."""
    p = F.col("l_partkey")
    role = F.when(F.col("l_returnflag") == "R", "loc.writing").when(F.col("l_returnflag") == "A", "loc.hearing").otherwise("loc.mentioned")
    return A.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("ordinal"), role.alias("role"),
        F.concat(F.lit("q"), p.cast("string"), F.lit("-"), F.col("l_suppkey").cast("string")).alias("name"), (p % 30).alias("pk"),
    )


SPOTS = """spots AS (SELECT l_orderkey AS doc, l_linenumber AS ordinal, CASE l_returnflag WHEN 'R' THEN 'loc.writing' WHEN 'A' THEN 'loc.hearing'
  ELSE 'loc.mentioned' END AS role, 'q' || l_partkey || '-' || l_suppkey AS name, l_partkey % 30 AS pk FROM lineitem)"""


@query(f"""WITH {LINKS}, {SPOTS},
named AS (SELECT l.*, CASE WHEN s_suppkey IS NULL THEN '' ELSE printf('s%05d', s_suppkey) END AS id, coalesce(nullif(role, ''), 'unknown') AS label
  FROM links l LEFT JOIN supplier ON s_suppkey = pk),
g AS (SELECT doc, arg_min(id, [ordinal::VARCHAR, name]) FILTER (WHERE contains(lower(role), 'issuer')) AS grantor_id,
  arg_min(id, [ordinal::VARCHAR, name]) FILTER (WHERE lower(role) = 'recipient') AS recipient_id FROM named GROUP BY doc),
r AS (SELECT doc, label, min(ordinal) AS first, string_agg(name, ', ' ORDER BY ordinal, name) AS names FROM named GROUP BY doc, label),
b AS (SELECT doc, string_agg(label || ': ' || names, '; ' ORDER BY first) AS persons_by_role FROM r GROUP BY doc),
w AS (SELECT doc, arg_min(name, [ordinal::VARCHAR, name]) FILTER (WHERE role = 'loc.writing') AS location_written,
  arg_min(name, [ordinal::VARCHAR, name]) FILTER (WHERE role = 'loc.hearing') AS location_hearing FROM spots GROUP BY doc),
f AS (SELECT doc, pk, min(ordinal) AS first FROM spots WHERE pk BETWEEN 1 AND 20 GROUP BY doc, pk),
i AS (SELECT doc, string_agg(printf('t%03d', pk), '; ' ORDER BY first, pk) AS ids FROM f GROUP BY doc)
SELECT o_orderkey AS doc, coalesce(grantor_id, '') AS grantor_id, coalesce(recipient_id, '') AS recipient_id, coalesce(persons_by_role, '') AS persons_by_role,
  coalesce(location_written, '') AS location_written, coalesce(location_hearing, '') AS location_hearing, coalesce(ids, '') AS locations_mentioned_ids
FROM orders LEFT JOIN g ON g.doc = o_orderkey LEFT JOIN b ON b.doc = o_orderkey LEFT JOIN w ON w.doc = o_orderkey LEFT JOIN i ON i.doc = o_orderkey""")
def q_names_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the names of persons and places as they were written."""
    docs = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"))
    k = F.col("s_suppkey")
    persons = A.table(spark, sf_dir, "supplier").select(k.alias("pk"), F.format_string("s%05d", k).alias("display_id"))
    n = F.col("n_nationkey")
    places = A.table(spark, sf_dir, "nation").where("n_nationkey between 1 and 20").select(n.alias("pk"), F.format_string("t%03d", n).alias("display_id"))
    return export.name_rows(docs, _links(spark, sf_dir), _spots(spark, sf_dir), persons, places)


@query("""
SELECT s_suppkey AS mention, s_name AS name, CASE WHEN s_suppkey % 3 <> 0 THEN 'd' || s_nationkey WHEN s_suppkey % 2 = 0 THEN 'r' || s_nationkey ELSE '' END AS district,
  CASE WHEN s_suppkey % 2 = 0 THEN 'r' || s_nationkey WHEN s_suppkey % 5 = 0 THEN 'now' ELSE '' END AS region, '' AS place_type,
  NULL::DOUBLE AS lat, NULL::DOUBLE AS lng, false AS geocoded FROM supplier WHERE s_suppkey % 4 <> 0""")
def q_places_to_geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places without coordinates, with the districts and regions to look for them in."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    places = A.table(spark, sf_dir, "supplier").select(
        k.alias("pk"), F.col("s_name").alias("canonical_name"), F.lit(None).cast("string").alias("place_type"),
        F.when(k % 3 != 0, F.concat(F.lit("d"), n)).otherwise("").alias("district"), F.when(k % 2 == 0, F.concat(F.lit("r"), n)).alias("region"),
        F.when(k % 5 == 0, "now").otherwise("").alias("modern_equivalent"),
        F.when(k % 4 == 0, F.concat(F.lit(" "), k.cast("string"), F.lit(".5 "))).when(k % 4 == 1, "north").alias("lat"), F.lit(None).cast("string").alias("lng"),
    )
    return geomatch.to_geocode(places, ungeocoded_only=True)


@query(f"""WITH {A.PAIRS},
c AS (SELECT c_custkey AS pk, c_custkey % 7 AS a FROM customer),
own AS (SELECT 'person' AS t, pk, CASE a WHEN 0 THEN 'ok' WHEN 1 THEN 'add' WHEN 2 THEN 'skip' ELSE '' END AS v FROM c
  UNION ALL SELECT 'place', pk, CASE WHEN a = 3 THEN 'no_match' WHEN a = 4 THEN 'ok' ELSE '' END FROM c
  UNION ALL SELECT 'pair', candidate_pk, CASE candidate_pk % 7 WHEN 0 THEN 'different' WHEN 1 THEN 'same' ELSE decision END FROM pairs
  UNION ALL SELECT 'item', pk, CASE WHEN a = 5 THEN 'reject' ELSE '' END FROM c
  UNION ALL SELECT 'merge', pk, (pk + 1)::VARCHAR FROM c WHERE a = 6
  UNION ALL SELECT 'merge', greatest(a, b), least(a, b)::VARCHAR FROM pairs WHERE candidate_pk % 7 = 1
  UNION ALL SELECT 'refused', pk, 'no_match' FROM c WHERE a = 5)
SELECT DISTINCT t AS rows_of, pk, v AS value FROM own""")
def q_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all kinds of commands of a reviewer leave behind."""
    k = F.col("c_custkey")
    c = A.table(spark, sf_dir, "customer")
    act = lambda kind, **by: F.array(*[F.struct(F.lit(kind).alias("item_type"), F.lit(int(n[1:])).alias("when"), F.lit(x).alias("action")) for n, x in by.items()])
    every = F.concat(
        act("new_person", _0="ok", _1="add", _2="skip", _5="no_match", _6="merge"), act("new_place", _3="no_match", _4="ok"),
        act("person_dup", _0="different", _1="merge", _2="next"), act("review_item", _5="reject"),
    )
    said = c.select(k.alias("item_id"), (k + 1).alias("match_pk"), F.explode(every).alias("x")).where(F.col("item_id") % 7 == F.col("x.when"))
    now = said.select(F.lit(2).alias("at"), "x.item_type", "item_id", "match_pk", "x.action")
    before = now.where("item_type <> 'person_dup'").withColumns({"at": F.lit(1), "action": F.when(F.col("item_type") == "review_item", "accept").otherwise("skip")})
    entities = c.select(k.alias("pk"), F.lit("").alias("review_status"))
    items = c.select(k.alias("item_id"), F.lit("").alias("decision"), F.lit("open").alias("status"))
    pairs = A.pairs(spark, sf_dir)
    out = review.dispatch(before.unionAll(now), entities, entities, pairs, pairs, items)
    row = lambda t, name, key, value: out[t].select(F.lit(name).alias("rows_of"), F.col(key).cast("long").alias("pk"), F.col(value).cast("string").alias("value"))
    rows = row("persons", "person", "pk", "review_status").unionAll(row("places", "place", "pk", "review_status"))
    rows = rows.unionAll(row("person_pairs", "pair", "candidate_pk", "decision")).unionAll(row("items", "item", "item_id", "decision"))
    return rows.unionAll(row("person_merges", "merge", "pk", "survivor")).unionAll(row("refused", "refused", "item_id", "action")).distinct()


@query("""
WITH n AS (SELECT o_orderkey % 8 + 1 AS volume, l_orderkey AS doc, l_linenumber AS ordinal, year(o_orderdate) AS y, l_linestatus AS role, l_returnflag AS qualifier,
  CASE WHEN l_linenumber % 2 = 0 THEN upper(p_brand) ELSE p_brand END AS name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
f AS (SELECT volume, doc, min(struct_pack(o := ordinal, n := name, r := role, q := qualifier, y := y)) AS m FROM n GROUP BY volume, doc, lower(name)),
r AS (SELECT volume, doc, m, row_number() OVER (ORDER BY volume, doc, m.o, m.n) AS number FROM f)
SELECT volume, doc, m.o AS ordinal, m.n AS canonical_name, printf('p%03d', number) AS legacy_id, printf('v%02d-p%03d', volume, number) AS display_id,
  m.r AS occupation, m.q AS title, m.y::INTEGER AS floruit_start, m.y::INTEGER AS floruit_end,
  'DI vol.' || volume || ' seq.' || doc % 100 || ' | ' || m.r AS sources, 'provisional' AS status FROM r""")
def q_mint_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional persons of every document, with what is known from it."""
    item, part = A.table(spark, sf_dir, "lineitem"), A.table(spark, sf_dir, "part")
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rows = item.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    name = F.when(F.col("l_linenumber") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand"))
    new = rows.select(
        (F.col("o_orderkey") % 8 + 1).alias("volume"), (F.col("l_orderkey") % 100).alias("sequence"), F.col("l_orderkey").alias("doc"),
        F.col("l_linenumber").alias("ordinal"), name.alias("name"), F.col("l_linestatus").alias("role"), F.col("l_returnflag").alias("qualifier"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("l_linestatus").alias("reference"),
    )
    return resolve.mint_persons(new)


@query(f"""WITH {LINKS}
SELECT 'person' AS entity_type, doc, ordinal, name AS extracted_name, role, pk AS match_pk, (ordinal * 10)::DOUBLE AS score, coalesce(s_name, '') AS closest_match,
  '' AS decision, 'open' AS status FROM links LEFT JOIN supplier ON s_suppkey = pk WHERE ordinal % 2 = 0""")
def q_review_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item for every link that is to be reviewed."""
    k = F.col("ordinal")
    resolved = _links(spark, sf_dir).withColumns({"band": F.when(k % 2 == 0, "review").otherwise("accept"), "score": (k * 10).cast("double")})
    names = A.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pk"), F.col("s_name").alias("canonical_name"))
    return resolve.review_items(resolved, names, "person")


@query(f"""WITH {LINKS} SELECT doc, ordinal, CASE WHEN ordinal % 2 = 0 THEN 'pending_review' ELSE 'resolved' END AS resolution_state FROM links""")
def q_junction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state in which links are loaded."""
    band = F.when(F.col("ordinal") % 2 == 0, "review").when(F.col("ordinal") % 3 == 0, "new").otherwise("accept")
    return resolve.junction(_links(spark, sf_dir).withColumn("band", band)).select("doc", "ordinal", "resolution_state")


@query("""
SELECT key, CASE WHEN a AND b THEN 'both' WHEN a THEN 'a' ELSE 'b' END AS found_in FROM (
  SELECT key, bool_or(s = 'a') AS a, bool_or(s = 'b') AS b FROM (
    SELECT o_custkey AS key, 'a' AS s FROM orders UNION ALL SELECT c_custkey + 7, 'b' FROM customer) GROUP BY key)""")
def q_key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which keys are in one table, which in the other, and which in both."""
    a = A.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    b = A.table(spark, sf_dir, "customer").select((F.col("c_custkey") + 7).alias("key"))
    return reconcile.key_report(a, b, "key")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_count_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.count_by(A.table(spark, sf_dir, "events"), "event_type")


_DATED = "CASE doc_id % 4 WHEN 0 THEN '15. Mai 834.' WHEN 1 THEN ' 1341. júní 14. ' WHEN 2 THEN 'am 1341.' ELSE '1341.' END"


@query(f"""WITH d AS (SELECT doc_id, coalesce(text, '') || chr(10) || {_DATED} || chr(10) || 'end' AS t FROM documents)
SELECT doc_id, regexp_matches(t, '(?m)^\\s*([0-9]{{1,2}}\\.\\s+[\\pL\\pN_]+\\s+[0-9]{{3,4}}|[0-9]{{3,4}}\\.\\s+[\\pL\\pN_]+\\s+[0-9]{{1,2}}|[0-9]{{3,4}})\\.\\s*$') AS header FROM d""")
def q_simple_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a line that is only a date."""
    k = F.col("doc_id") % 4
    date = F.when(k == 0, "15. Mai 834.").when(k == 1, " 1341. júní 14. ").when(k == 2, "am 1341.").otherwise("1341.")
    text = F.concat(S.or_empty(F.col("text")), F.lit("\n"), date, F.lit("\nend"))
    return A.table(spark, sf_dir, "documents").select("doc_id", S.has_simple_header(text).alias("header"))


@query("""
SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS pk,
  CASE WHEN c_custkey % 5 = 0 THEN '' ELSE (CASE WHEN c_custkey % 4 <> 0 THEN 'a' ELSE '' END) END AS changes,
  CASE WHEN c_custkey % 5 = 0 THEN 'unmatched' WHEN c_custkey % 4 = 0 THEN 'unchanged' WHEN c_custkey % 3 = 0 THEN 'held' ELSE 'corrected' END AS correction,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 4 <> 0 AND c_custkey % 3 <> 0 THEN c_name ELSE CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE '' END END AS a
FROM customer""")
def q_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that a match corrects, where review does not bar it."""
    k, c = F.col("c_custkey"), A.table(spark, sf_dir, "customer")
    rows = c.select(k.alias("id"), F.when(k % 3 == 0, "skip").otherwise("ok").alias("review_status"), F.when(k % 4 == 0, F.col("c_name")).otherwise("").alias("a"))
    matches = c.where(k % 5 != 0).select(k.alias("id"), k.alias("pk"), F.lit("canonical").alias("strategy"), F.col("c_name").alias("a"))
    return lookups.corrections(rows, matches, ["a"], apply=True).select("id", "pk", "changes", "correction", "a")


@query("""
SELECT c_custkey AS item_id, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'reject' WHEN c_custkey % 5 = 0 THEN 'accept' ELSE '' END AS decision FROM customer""")
def q_record_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions on open items; closed ones keep theirs."""
    k, c = F.col("c_custkey"), A.table(spark, sf_dir, "customer")
    status = F.when(k % 2 == 0, "open").otherwise("resolved")
    items = c.select(k.alias("item_id"), F.when(k % 5 == 0, "accept").otherwise("").alias("decision"), status.alias("status"))
    decisions = c.where(k % 3 == 0).select(k.alias("item_id"), F.lit("reject").alias("decision"))
    return review.record_decisions(items, decisions).select("item_id", "decision")


@query("""
WITH c AS (SELECT c_custkey AS candidate_pk, c_nationkey AS pk, 'x' || c_custkey AS e, CASE WHEN c_custkey % 3 = 0 THEN 'same' ELSE 'different' END AS decision FROM customer),
s AS (SELECT pk, arg_min(e, candidate_pk) AS e FROM c WHERE decision = 'same' GROUP BY pk)
SELECT n_nationkey AS pk, CASE WHEN n_nationkey % 2 = 0 THEN 'own' ELSE coalesce(e, '') END AS external_id FROM nation LEFT JOIN s ON pk = n_nationkey""")
def q_place_pair_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places that take the identifier of a candidate decided to be the same."""
    k, c = F.col("c_custkey"), A.table(spark, sf_dir, "customer")
    candidates = c.select(k.alias("candidate_pk"), F.col("c_nationkey").alias("pk"), F.concat(F.lit("x"), k.cast("string")).alias("external_id"), F.lit("").alias("decision"))
    decisions = c.select(k.alias("candidate_pk"), F.when(k % 3 == 0, "same").otherwise("different").alias("decision"))
    n = F.col("n_nationkey")
    places = A.table(spark, sf_dir, "nation").select(n.alias("pk"), F.when(n % 2 == 0, "own").otherwise("").alias("external_id"))
    return review.decide_place_pairs(candidates, places, decisions)[1].select("pk", "external_id")


@query(f"""WITH {A.PAIRS}, {A.CUSTOMERS}, e AS (SELECT a AS pk FROM pairs WHERE decision = 'different' UNION SELECT b FROM pairs WHERE decision = 'different')
SELECT c.pk, CASE WHEN e.pk IS NOT NULL AND status = 'provisional' THEN 'add' ELSE review_status END AS review_status FROM customers c LEFT JOIN e USING (pk)""")
def q_send_to_final_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.send_to_final_review(A.customers(spark, sf_dir), A.pairs(spark, sf_dir)).select("pk", "review_status")


@query("""
SELECT c_custkey AS pk, list_filter([CASE WHEN c_custkey % 3 = 0 THEN 'name=' || lower(c_name) END, CASE WHEN c_custkey % 4 = 0 THEN 'note=' END], lambda x: x IS NOT NULL) AS changes
FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0""")
def q_row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that differ from a snapshot, and in what."""
    k, c = F.col("c_custkey"), A.table(spark, sf_dir, "customer")
    before = c.select(k.alias("pk"), F.col("c_name").alias("name"), F.when(k % 4 == 0, "n").alias("note"))
    after = c.select(k.alias("pk"), F.when(k % 3 == 0, F.lower("c_name")).otherwise(F.col("c_name")).alias("name"), F.when(k % 4 == 0, "").alias("note"))
    found = review.changed_rows(before, after, "pk", ["name", "note"])
    return found.select("pk", F.transform(F.map_entries("changes"), lambda e: F.concat(e["key"], F.lit("="), e["value"])).alias("changes"))


@query("""
WITH best AS (SELECT p_brand AS name, arg_max(p_type, p_partkey) AS t FROM part GROUP BY p_brand)
SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'own' ELSE t END AS kind FROM part JOIN best ON name = p_brand""")
def q_fill_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank values from the best-scored row of the same name."""
    k, part = F.col("p_partkey"), A.table(spark, sf_dir, "part")
    rows = part.select(k.alias("id"), F.col("p_brand").alias("name"), F.when(k % 3 == 0, "own").otherwise(" ").alias("kind"))
    found = part.select(F.col("p_brand").alias("name"), k.alias("score"), F.col("p_type").alias("kind"))
    return reconcile.fill_by_name(rows, found, ["kind"]).select("id", "kind")


@query(f"""WITH {A.CUSTOMERS} SELECT pk, canonical_name, CASE WHEN pk % 2 = 0 THEN 'https://www.wikidata.org/wiki/Q' || pk ELSE '' END AS link
FROM customers WHERE status = 'canonical'""")
def q_authority_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of the authority as they are exported."""
    k = F.col("pk")
    rows = A.customers(spark, sf_dir).withColumn("wikidata_id", F.when(k % 2 == 0, F.concat(F.lit(" Q"), k.cast("string"))))
    return export.authority_rows(rows, ["pk", "canonical_name"])


@query("""
SELECT p_partkey AS id, p_name AS name, p_brand || CASE WHEN p_partkey % 2 = 0 THEN '; ' || p_type ELSE '' END AS variants FROM part WHERE p_partkey % 5 <> 0""")
def q_seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds with an identifier and a name; variants once each, without the name."""
    k, part = F.col("p_partkey"), A.table(spark, sf_dir, "part")
    variants = F.concat_ws(";", "p_brand", F.upper("p_name"), "p_brand", F.when(k % 2 == 0, F.col("p_type")), F.lit(" "))
    rows = part.select(F.when(k % 5 != 0, k.cast("string")).otherwise(" ").alias("id"), F.col("p_name").alias("name"), variants.alias("variants"))
    return export.seed_rows(rows, "id", "name", "variants").withColumn("id", F.col("id").cast("long"))


@query("""
SELECT c_custkey AS id, 'see [' || CASE WHEN c_nationkey % 2 = 0 THEN 'e' || c_nationkey // 10 ELSE 'n' || c_nationkey END || '] and [x], [' ||
  CASE WHEN c_nationkey % 2 = 0 THEN 'e' || c_nationkey // 10 ELSE 'n' || c_nationkey END || ']' || c_name AS text FROM customer""")
def q_rewrite_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers in texts that name their survivors after a merge."""
    n = F.col("c_nationkey").cast("string")
    texts = A.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("see [n"), n, F.lit("] and [x], [n"), n, F.lit("]"), F.col("c_name")).alias("text")
    )
    k = F.col("n_nationkey")
    mapping = A.table(spark, sf_dir, "nation").where(k % 2 == 0)
    mapping = mapping.select(F.concat(F.lit("n"), k.cast("string")).alias("pk"), F.concat(F.lit("e"), F.floor(k / 10).cast("string")).alias("survivor"))
    return merge.rewrite_tokens(texts, mapping, "text", "id").select("id", "text")


@query("""
WITH r AS (SELECT c_custkey, 'i' || (c_custkey // 5) AS id, row_number() OVER (PARTITION BY c_custkey // 5 ORDER BY c_custkey) AS n FROM customer)
SELECT c_custkey AS pk, id || CASE WHEN n = 1 THEN '' ELSE '-' || chr((96 + n)::INT) END AS unique_id FROM r""")
def q_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers that repeat, told apart by letters."""
    k = F.col("c_custkey")
    rows = A.table(spark, sf_dir, "customer").select(k.alias("pk"), F.concat(F.lit("i"), F.floor(k / 5).cast("string")).alias("id"))
    return resolve.suffix_repeats(rows, "id", "pk").select("pk", "unique_id")


@query("""
WITH s AS (SELECT o_orderkey AS key, o_orderkey % 8 AS n FROM orders), l AS (SELECT l_orderkey AS key, count(*) FILTER (WHERE l_returnflag <> 'R') AS n_loaded,
  count(*) FILTER (WHERE l_returnflag = 'R') AS n_skipped FROM lineitem GROUP BY l_orderkey)
SELECT key, n AS n_source, coalesce(n_loaded, 0) AS n_loaded, coalesce(n_skipped, 0) AS n_skipped, coalesce(n_loaded + n_skipped, 0) = n AS agree
FROM (SELECT coalesce(s.key, l.key) AS key, CASE WHEN s.n > 0 THEN s.n ELSE 0 END AS n, n_loaded, n_skipped FROM s FULL JOIN l ON s.key = l.key) WHERE n > 0 OR n_loaded IS NOT NULL""")
def q_counts_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each document's rows were all loaded or skipped."""
    k = F.col("o_orderkey")
    sources = A.table(spark, sf_dir, "orders").where(k % 8 > 0).select(k.alias("key"), F.explode(F.sequence(F.lit(1).cast("long"), k % 8)).alias("n"))
    loaded = A.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), (F.col("l_returnflag") == "R").alias("skipped"))
    return reconcile.counts_agree(sources, loaded, "key")


@query(f"""WITH {A.PAIRS} SELECT 'broken_links' AS "check", count(*) FILTER (WHERE o_custkey % 9 = 0) AS n FROM orders
UNION ALL SELECT 'repeated_ids', count(*) FROM (SELECT c_custkey // 2 FROM customer WHERE c_custkey % 9 <> 0 GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'pairs_out_of_order', 0 UNION ALL SELECT 'repeated_pairs', 0""")
def q_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken references and repeated identifiers."""
    k = F.col("c_custkey")
    entities = A.table(spark, sf_dir, "customer").where(k % 9 != 0).select(k.alias("pk"), F.floor(k / 2).alias("display_id"))
    links = A.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pk"))
    return review.integrity(entities, links, A.pairs(spark, sf_dir))


@query("""
WITH e AS (SELECT 'x' || c_custkey // 4 AS i, count(*) AS n FROM customer GROUP BY 1)
SELECT 'x' || s_suppkey AS old_id, 3::BIGINT AS n_wanted, coalesce(n, 0) AS n_there, coalesce(n, 0) = 3 AS agree FROM supplier LEFT JOIN e ON i = 'x' || s_suppkey""")
def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether split identifiers have as many entities as they should."""
    old = lambda k: F.concat(F.lit("x"), k.cast("string"))
    entities = A.table(spark, sf_dir, "customer").select(old(F.floor(F.col("c_custkey") / 4)).alias("legacy_id"))
    splits = A.table(spark, sf_dir, "supplier").select(old(F.col("s_suppkey")).alias("old_id"), F.explode(F.array(F.lit("b"), F.lit("c"))).alias("new_display_id"))
    return review.split_counts(entities, splits)


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5('42:' || c_custkey), c_custkey LIMIT 10")
def q_spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rows to look at, the same ones every time (the limit is what it is for)."""
    return review.spot_check(A.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey")


@query("""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_id + 0.5 WHEN 1 THEN -event_id * 1000.0 WHEN 2 THEN event_id / 10.0 END::DOUBLE AS number,
  '{"a": ' || event_id || '}' AS reply, CASE event_id % 2 WHEN 0 THEN 'oxnadal' ELSE 'eyjafjord' END AS stem FROM events""")
def q_tolerant_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in texts that may be none, replies in fences, and stems of valleys."""
    k = F.col("event_id")
    n = k.cast("string")
    number = (
        F.when(k % 5 == 0, F.concat(F.lit(" "), n, F.lit(".5 "))).when(k % 5 == 1, F.concat(F.lit("-"), n, F.lit("e3")))
        .when(k % 5 == 2, F.concat(F.expr("cast(event_id div 10 as string)"), F.lit("."), (k % 10).cast("string"))).when(k % 5 == 3, "nan").otherwise("12a")
    )
    fenced = F.concat(F.lit("```json\n"), F.lit('{"a": '), n, F.lit("}"), F.lit("\n```"))
    valley = F.when(k % 2 == 0, " Öxnadals").otherwise("EYJAFJÖRDUR")
    return A.table(spark, sf_dir, "events").select(
        "event_id", S.float_or_null(number).alias("number"), S.without_fence(fenced).alias("reply"), S.valley_stem(valley).alias("stem")
    )


@query("""SELECT o_orderkey, o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 AS has_review FROM orders""")
def q_document_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with any flag, and those with none."""
    k = F.col("o_orderkey")
    flag = lambda n: (k % n == 0).cast("int")
    docs = A.table(spark, sf_dir, "orders").select(
        k, (k % 4).alias("volume"), k.alias("sequence"), flag(3).alias("has_review_persons"), flag(5).alias("has_review_places"), flag(7).alias("has_parse_error")
    )
    parts = [lookups.scan_documents(docs, has).select("o_orderkey", F.lit(has).alias("has_review")) for has in (True, False)]
    return parts[0].unionAll(parts[1])


@query("""
WITH q AS (SELECT 'person_dup' AS item_type, c_custkey AS item_id, c_name AS name, (c_custkey % 10)::DOUBLE AS score FROM customer
  UNION ALL SELECT 'place_dup', s_suppkey, s_name, NULL FROM supplier)
SELECT item_type, item_id, name, score FROM q ORDER BY score DESC NULLS LAST, item_type, item_id LIMIT 7 OFFSET 5""")
def q_queue_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the queue (the limit is what a page is)."""
    none = F.lit(None).cast("string").alias("decision")
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    index = review.queue_index({
        "person_dup": A.table(spark, sf_dir, "customer").select(k.alias("item_id"), F.col("c_name").alias("name"), (k % 10).cast("double").alias("score"), F.lit(1).alias("volume"), none),
        "place_dup": A.table(spark, sf_dir, "supplier").select(s.alias("item_id"), F.col("s_name").alias("name"), F.lit(None).cast("double").alias("score"), F.lit(1).alias("volume"), none),
    })
    return review.page(index, "score_desc", 5, 7).select("item_type", "item_id", "name", "score")


@query("""
WITH h AS (SELECT *, c_mktsegment = 'BUILDING' AS hit, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') OVER (PARTITION BY c_nationkey) AS hits FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN hit AND hits = 1 THEN 0 ELSE 1 END, c_custkey) AS r FROM h)
SELECT c_nationkey AS key, c_custkey AS pk FROM r WHERE r = 1""")
def q_pick_ambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of several candidates the one that alone fits a hint, else the first."""
    keyed = A.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_custkey").alias("pk"), "c_mktsegment")
    return reconcile.pick_ambiguous(keyed, F.col("c_mktsegment") == "BUILDING", "pk").select("key", "pk")


@query("""
SELECT c_custkey AS key, c_name AS name, NULL::VARCHAR AS note FROM customer
UNION ALL SELECT s_suppkey + 40, s_name, 'new' FROM supplier WHERE s_suppkey + 40 NOT IN (SELECT c_custkey FROM customer)""")
def q_append_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key is not there yet are added."""
    from textloom.sources.writers import append_absent

    old = A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    new = A.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 40).alias("key"), F.col("s_name").alias("name"), F.lit("new").alias("note"))
    return append_absent(old, new, "key")


@query("""SELECT max(c_custkey % 900)::BIGINT AS largest FROM customer""")
def q_max_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest number in identifiers of one prefix."""
    k = F.col("c_custkey")
    same = F.concat(F.lit("p"), (k % 900).cast("string"))
    other = F.concat(F.lit("px"), k.cast("string"))
    ids = A.table(spark, sf_dir, "customer").select(F.explode(F.array(same, other)).alias("legacy_id"))
    return spark.createDataFrame([(resolve.max_suffix(ids, "p"),)], "largest long")


@query(f"""WITH {A.PAIRS}, {A.CUSTOMERS}, same AS (SELECT a AS pk FROM pairs WHERE decision = 'same' UNION SELECT b FROM pairs WHERE decision = 'same')
SELECT c.pk, CASE WHEN status = 'provisional' AND review_status = 'add' AND c.pk NOT IN (SELECT pk FROM same) THEN 'canonical' ELSE status END AS status FROM customers c""")
def q_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Added entities that no duplicate blocks, in the authority."""
    people = A.customers(spark, sf_dir)
    return duplicates.promote(people, duplicates.duplicate_status(people, A.pairs(spark, sf_dir))).select("pk", "status")


@query("""
WITH m AS (SELECT o_orderkey AS doc, unnest([0, 1, 2]) AS ordinal, unnest(['A' || o_orderkey % 5, 'b' || o_orderkey % 5, 'extra']) AS name,
  unnest(['loc.writing', 'loc.hearing', 'loc.mentioned']) AS role FROM orders) SELECT doc, ordinal::INTEGER AS ordinal, name, role FROM m""")
def q_place_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations of documents, and the other places they name."""
    n = (F.col("o_orderkey") % 5).cast("string")
    a, b = F.concat(F.lit("A"), n), F.concat(F.lit("b"), n)
    loc = lambda name, role: F.struct(name.alias("name"), F.lit(role).alias("role"), F.lit("").alias("region"))
    docs = A.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc"), F.array(loc(a, "loc.writing"), loc(b, "loc.hearing")).alias("locations"),
        F.array(F.lower(a), F.upper(b), F.lit("extra"), F.lit(" "), F.lit("extra")).alias("all_places"),
    )
    return resolve.place_mentions(docs).select("doc", "ordinal", "name", "role")
