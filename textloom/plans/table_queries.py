"""Queries over whole tables: merging, review, reconciliation, export, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import duplicates, export, merge, reconcile, review
from textloom.plans import adapters as A
from textloom.plans.registry import query


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = lambda c: c.cast("string")
    return A.table(spark, sf_dir, "customer").select(
        k.alias("pk"), F.col("c_name").alias("canonical_name"),
        F.concat("c_mktsegment", F.lit("; "), F.lower("c_mktsegment"), F.lit(";X"), text(k % 3)).alias("variant_names"),
        F.concat(F.lit("n"), text(k % 4), F.lit(";N"), text(k % 2)).alias("notes"),
        F.concat(F.lit("s"), text(F.col("c_nationkey"))).alias("sources"), F.lit("").alias("associated_places"),
        F.when(k % 4 == 0, F.concat(F.lit(" p"), text(k))).otherwise(" ").alias("patronymic"),
        F.when(k % 3 == 0, (F.lit(1200) + k % 50).cast("int")).alias("floruit_start"),
        F.when(k % 5 == 0, (F.lit(1300) + k % 50).cast("int")).alias("floruit_end"),
        (k % 4).alias("source_volume"), F.when(k % 6 == 0, "9;2").otherwise("").alias("merged_volumes"),
        (F.col("c_nationkey") * 100 + k % 7).alias("grp"),
    )


@query("""
WITH e AS (SELECT c_custkey AS pk, c_name, c_mktsegment AS seg, c_nationkey AS nk, min(c_custkey) OVER (PARTITION BY c_nationkey * 100 + c_custkey % 7) AS s FROM customer),
o AS (SELECT *, (pk <> s)::INT AS x FROM e),
lists AS (
  SELECT s, 'variant_names' AS f, [0, x, pk, 0] AS k, unnest([seg, lower(seg), 'X' || pk % 3]) AS item, unnest([1, 2, 3]) AS i FROM o
  UNION ALL SELECT s, 'variant_names', [1, x, pk, 0], c_name, 1 FROM o WHERE x = 1
  UNION ALL SELECT s, 'notes', [0, x, pk, 0], unnest(['n' || pk % 4, 'N' || pk % 2]), unnest([1, 2]) FROM o
  UNION ALL SELECT s, 'sources', [0, x, pk, 0], 's' || nk, 1 FROM o
  UNION ALL SELECT s, 'merged_volumes', [0, x, pk, 0], unnest(['9', '2']), unnest([1, 2]) FROM o WHERE pk % 6 = 0
  UNION ALL SELECT s, 'merged_volumes', [1, x, pk, 0], (pk % 4)::VARCHAR, 1 FROM o WHERE x = 1),
firsts AS (SELECT s, f, item, k, i FROM lists QUALIFY row_number() OVER (PARTITION BY s, f, lower(item) ORDER BY k, i) = 1),
kept AS (SELECT t.* FROM firsts t JOIN customer c ON c.c_custkey = t.s WHERE NOT (f = 'variant_names' AND lower(item) = lower(c_name))
  AND NOT (f = 'merged_volumes' AND item = (t.s % 4)::VARCHAR)),
joined AS (SELECT s, f, string_agg(item, ';' ORDER BY k, i) AS v FROM kept GROUP BY s, f),
facts AS (SELECT s, min(CASE WHEN pk % 3 = 0 THEN 1200 + pk % 50 END) AS f0, max(CASE WHEN pk % 5 = 0 THEN 1300 + pk % 50 END) AS f1,
  coalesce(arg_min(' p' || pk, [x, pk]) FILTER (WHERE pk % 4 = 0), '') AS patronymic FROM o GROUP BY s)
SELECT c.c_custkey AS pk, c_name AS canonical_name, coalesce(a.v, '') AS variant_names, coalesce(b.v, '') AS notes, coalesce(d.v, '') AS sources,
  '' AS associated_places, patronymic, f0::INTEGER AS floruit_start, f1::INTEGER AS floruit_end, c_custkey % 4 AS source_volume, coalesce(m.v, '') AS merged_volumes
FROM facts JOIN customer c ON c.c_custkey = facts.s LEFT JOIN joined a ON a.s = facts.s AND a.f = 'variant_names'
LEFT JOIN joined b ON b.s = facts.s AND b.f = 'notes' LEFT JOIN joined d ON d.s = facts.s AND d.f = 'sources'
LEFT JOIN joined m ON m.s = facts.s AND m.f = 'merged_volumes'""")
def q_merge_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of entities, each merged into its smallest."""
    rows = _entities(spark, sf_dir)
    mapping = merge.survivors(rows.select("grp", "pk"))
    return merge.merge_rows(rows, mapping, firsts=("patronymic",))


@query(f"""WITH {A.PAIRS}, m AS (SELECT c_custkey AS pk, min(c_custkey) OVER (PARTITION BY c_custkey // 4) AS s FROM customer),
moved AS (SELECT candidate_pk, least(coalesce(x.s, a), coalesce(y.s, b)) AS a, greatest(coalesce(x.s, a), coalesce(y.s, b)) AS b, decision
  FROM pairs LEFT JOIN m x ON x.pk = a LEFT JOIN m y ON y.pk = b)
SELECT a, b, candidate_pk, decision FROM moved WHERE a < b
QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY (decision = '')::INT, candidate_pk) = 1""")
def q_relink_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs after their entities were merged by fours."""
    groups = A.customers(spark, sf_dir).select(F.floor(F.col("pk") / 4).alias("grp"), "pk")
    return merge.relink_pairs(A.pairs(spark, sf_dir), merge.survivors(groups))


@query("""
SELECT o_orderkey AS doc, coalesce(max((l_returnflag = 'R')::INT), 0) AS has_review_persons,
  coalesce(max((l_linenumber = 1 AND l_linestatus = 'O')::INT), 0) AS has_review_places
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def q_flags_rescan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents have links to review."""
    return _flags(spark, sf_dir)


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = A.table(spark, sf_dir, "lineitem")
    state = lambda c: F.when(c, "pending_review").otherwise("resolved").alias("resolution_state")
    people = item.select(F.col("l_orderkey").alias("doc"), state(F.col("l_returnflag") == "R"))
    where = item.where("l_linenumber = 1").select(F.col("l_orderkey").alias("doc"), state(F.col("l_linestatus") == "O"))
    return review.review_flags(A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc")), people, where)


@query("""
WITH clear AS (SELECT o_orderkey AS doc FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 10 <> 0 GROUP BY o_orderkey
  HAVING coalesce(max((l_returnflag = 'R')::INT), 0) = 0 AND coalesce(max((l_linenumber = 1 AND l_linestatus = 'O')::INT), 0) = 0),
p AS (SELECT l_orderkey AS doc, l_linenumber AS o, CASE l_linenumber % 3 WHEN 0 THEN 'Issuer (main)' WHEN 1 THEN 'recipient' ELSE '' END AS role,
  s_name AS name, CASE WHEN l_suppkey % 13 <> 0 THEN l_suppkey END AS pk, s_nationkey AS nk FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
pi AS (SELECT *, CASE WHEN pk IS NULL THEN '' ELSE 'p' || pk END AS id, coalesce(nullif(role, ''), 'unknown') AS label,
  CASE WHEN pk IS NOT NULL THEN name || ' [p' || pk || ']' ELSE name END AS shown FROM p),
roles AS (SELECT doc, label, min(o) AS first, string_agg(shown, ', ' ORDER BY o, shown) AS names FROM pi GROUP BY doc, label),
by_role AS (SELECT doc, string_agg(label || ': ' || names, '; ' ORDER BY first) AS persons_by_role FROM roles GROUP BY doc),
who AS (SELECT doc, arg_min(id, struct_pack(o := o, n := name)) FILTER (WHERE contains(lower(role), 'issuer')) AS g, arg_min(id, struct_pack(o := o, n := name)) FILTER (WHERE role = 'recipient') AS r FROM pi GROUP BY doc),
l AS (SELECT doc, o, CASE WHEN o = 1 AND pk % 2 = 0 THEN 'loc.writing' WHEN o = 2 THEN 'loc.hearing' ELSE 'loc.mentioned' END AS role,
  CASE WHEN nk % 9 <> 0 THEN 'l' || nk END AS id FROM (SELECT doc, o, nk, coalesce(pk, 1) AS pk FROM pi)),
place AS (SELECT doc, arg_min(coalesce(id, ''), struct_pack(o := o, i := coalesce(id, ''))) FILTER (WHERE role = 'loc.writing') AS w, arg_min(coalesce(id, ''), struct_pack(o := o, i := coalesce(id, ''))) FILTER (WHERE role = 'loc.hearing') AS h FROM l GROUP BY doc),
named AS (SELECT doc, id, min(o) AS first FROM l WHERE id IS NOT NULL GROUP BY doc, id),
all_places AS (SELECT doc, string_agg(id, '; ' ORDER BY first, id) AS ids FROM named GROUP BY doc)
SELECT doc, coalesce(g, '') AS grantor_id, coalesce(r, '') AS recipient_id, coalesce(persons_by_role, '') AS persons_by_role,
  coalesce(nullif(w, ''), h, '') AS location_written_id, coalesce(ids, '') AS locations_mentioned_ids
FROM clear LEFT JOIN by_role USING (doc) LEFT JOIN who USING (doc) LEFT JOIN place USING (doc) LEFT JOIN all_places USING (doc)""")
def q_document_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without open questions, with who and where in one row."""
    item = A.table(spark, sf_dir, "lineitem").join(A.table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    n, pk = F.col("l_linenumber"), F.when(F.col("l_suppkey") % 13 != 0, F.col("l_suppkey"))
    role = F.when(n % 3 == 0, "Issuer (main)").when(n % 3 == 1, "recipient").otherwise("")
    people = item.select(F.col("l_orderkey").alias("doc"), n.alias("ordinal"), role.alias("role"), F.col("s_name").alias("name"), pk.alias("pk"))
    at = F.when((n == 1) & (F.coalesce(pk, F.lit(1)) % 2 == 0), "loc.writing").when(n == 2, "loc.hearing").otherwise("loc.mentioned")
    where = item.select(F.col("l_orderkey").alias("doc"), n.alias("ordinal"), at.alias("role"), F.col("s_nationkey").alias("pk"))
    ids = lambda t, k, p: A.table(spark, sf_dir, t).select(F.col(k).alias("pk"), F.concat(F.lit(p), F.col(k).cast("string")).alias("display_id"))
    documents = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), (F.col("o_orderkey") % 10 == 0).cast("int").alias("has_parse_error"))
    ready = export.exportable(documents, _flags(spark, sf_dir)).select("doc")
    places = ids("nation", "n_nationkey", "l").where("pk % 9 <> 0")
    return export.document_rows(ready, people, where, ids("supplier", "s_suppkey", "p"), places)


@query("""
WITH i AS (SELECT d.doc_id AS item_id, CAST(regexp_extract(source, 'src(\\d+)', 1) AS BIGINT) AS volume, lang, n_chars % 100 AS match_pk,
  CASE WHEN d.doc_id % 7 <> 0 THEN 'open' ELSE 'resolved' END AS status, CASE WHEN quality = 1 AND coalesce(toxic, 0) <> 1 THEN 'accept' WHEN toxic = 1 THEN 'reject' ELSE '' END AS decision
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
done AS (SELECT *, row_number() OVER (PARTITION BY decision ORDER BY volume, item_id) AS rn FROM i WHERE status = 'open' AND decision <> '')
SELECT i.item_id, CASE WHEN d.item_id IS NOT NULL THEN 'resolved' ELSE i.status END AS status,
  CASE WHEN d.decision = 'accept' THEN d.match_pk WHEN d.decision = 'reject' THEN 1000000 + d.rn - 1 END AS outcome_pk
FROM i LEFT JOIN done d USING (item_id)""".replace("\\\\", "\\"))
def q_review_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewers' decisions, applied at once."""
    docs, labels = A.table(spark, sf_dir, "documents"), A.table(spark, sf_dir, "labels")
    volume = F.regexp_extract("source", r"src(\d+)", 1).cast("long")
    items = docs.select(
        F.col("doc_id").alias("item_id"), F.col("doc_id").alias("link_id"), volume.alias("volume"), F.col("lang").alias("name"),
        (F.col("n_chars") % 100).alias("match_pk"), F.lit("").alias("decision"), F.when(F.col("doc_id") % 7 != 0, "open").otherwise("resolved").alias("status"),
    )
    verdict = F.when(F.col("toxic") == 1, "reject").when(F.col("quality") == 1, "accept").otherwise("")
    decided = review.record_decisions(items, labels.select(F.col("doc_id").alias("item_id"), verdict.alias("decision")))
    links = items.select("link_id", F.lit(None).cast("long").alias("pk"), F.lit("pending_review").alias("resolution_state"))
    closed, _, _ = review.apply_decisions(decided, links, 1_000_000)
    return closed.select("item_id", "status", "outcome_pk")


@query(f"""WITH {A.PAIRS}, {A.CUSTOMERS}, ends AS (SELECT a AS pk, b AS o, candidate_pk AS c, decision FROM pairs UNION ALL SELECT b, a, candidate_pk, decision FROM pairs),
best AS (SELECT pk, max(CASE WHEN decision = 'same' THEN struct_pack(c := c, o := o) END) AS same, min(struct_pack(c := c, o := o)) AS first FROM ends GROUP BY pk)
SELECT pk, source_volume, CASE WHEN same IS NOT NULL THEN 'blocked' WHEN first IS NOT NULL THEN 'warning' ELSE 'none' END AS duplicate_status,
  CASE WHEN same IS NOT NULL THEN 'provisional' ELSE 'canonical' END AS status_after
FROM customers LEFT JOIN best USING (pk) WHERE status = 'provisional' AND review_status = 'add' AND source_volume IN (0, 2)""")
def q_final_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is ready to be promoted, and what promoting does."""
    people = A.customers(spark, sf_dir)
    status = duplicates.duplicate_status(people, A.pairs(spark, sf_dir))
    ready = duplicates.final_review(people, status, [0, 2])
    after = duplicates.promote(people, status, [0, 2]).select("pk", F.col("status").alias("status_after"))
    return ready.join(after, "pk").select("pk", "source_volume", "duplicate_status", "status_after")


@query("""
WITH q AS (
  SELECT 'person_review' AS item_type, doc_id AS item_id, lang AS name, (n_chars % 100)::DOUBLE AS score, doc_id % 5 AS volume, (doc_id % 4 = 0) AS decided FROM documents
  UNION ALL SELECT 'person_dup', c_custkey, c_name, (c_custkey % 100)::DOUBLE, c_custkey % 5, c_custkey % 3 = 0 FROM customer
  UNION ALL SELECT 'place_dup', s_suppkey, s_name, NULL, s_suppkey % 5, false FROM supplier)
SELECT item_type, item_id, name, score, volume, lower(coalesce(name, '') || ' ' || item_type) AS search_text FROM q
WHERE NOT decided AND volume IN (1, 2) AND contains(lower(coalesce(name, '') || ' ' || item_type), 'er')""")
def q_queue_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open items of several kinds, searched and filtered."""
    def items(t: str, key: str, name: str, score, decided) -> DataFrame:
        k = F.col(key)
        return A.table(spark, sf_dir, t).select(
            k.alias("item_id"), F.col(name).alias("name"), score.alias("score"), (k % 5).alias("volume"),
            F.when(decided, "accept").otherwise("").alias("decision"),
        )

    index = review.queue_index({
        "person_review": items("documents", "doc_id", "lang", (F.col("n_chars") % 100).cast("double"), F.col("doc_id") % 4 == 0),
        "person_dup": items("customer", "c_custkey", "c_name", (F.col("c_custkey") % 100).cast("double"), F.col("c_custkey") % 3 == 0),
        "place_dup": items("supplier", "s_suppkey", "s_name", F.lit(None).cast("double"), F.lit(False)),
    })
    return review.filter_queue(index, "ER", [1, 2]).orderBy(*review.queue_order("score_desc"))


@query("""
WITH l AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS occurrence FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id, turn AS reply_turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS occurrence FROM conversations WHERE role = 'assistant')
SELECT conv_id, occurrence::INTEGER AS occurrence, turn, reply_turn FROM l LEFT JOIN r USING (conv_id, occurrence)""")
def q_positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The n-th question of a conversation with its n-th answer."""
    c = A.table(spark, sf_dir, "conversations")
    asked = c.where("role = 'user'").select("conv_id", "turn")
    told = c.where("role = 'assistant'").select("conv_id", F.col("turn").alias("reply_turn"))
    return reconcile.positional_join(asked, told, ["conv_id"], ["turn"], ["reply_turn"]).select("conv_id", "occurrence", "turn", "reply_turn")


@query("""
WITH a AS (SELECT s_suppkey AS key, s_name AS label, CASE WHEN s_suppkey % 10 = 1 THEN 'x' WHEN s_suppkey % 3 = 0 THEN '' ELSE (s_suppkey % 25)::VARCHAR END AS region, 'a' AS note FROM supplier),
b AS (SELECT c_custkey + 3 AS key, c_name AS label, ((c_custkey + 3) % 25)::VARCHAR AS region, CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE 'b' END AS note FROM customer)
SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NOT NULL AND b.key IS NOT NULL THEN 'both' WHEN a.key IS NOT NULL THEN 'a' ELSE 'b' END AS found_in,
  coalesce(nullif(a.label, ''), b.label) AS label, coalesce(nullif(trim(b.note), ''), a.note) AS note, coalesce(nullif(a.region, ''), b.region) AS region
FROM a FULL JOIN b ON a.key = b.key WHERE NOT (coalesce(a.region, '') <> '' AND coalesce(b.region, '') <> '' AND a.region <> b.region)""")
def q_reconcile_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier and every customer, whose keys start three later, as one store."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    region = F.when(s % 10 == 1, "x").when(s % 3 == 0, "").otherwise((s % 25).cast("string"))
    a = A.table(spark, sf_dir, "supplier").select(s.alias("key"), F.col("s_name").alias("label"), region.alias("region"), F.lit("a").alias("note"))
    note = F.when(c % 4 == 0, " ").otherwise("b")
    b = A.table(spark, sf_dir, "customer").select((c + 3).alias("key"), F.col("c_name").alias("label"), ((c + 3) % 25).cast("string").alias("region"), note.alias("note"))
    merged, _ = reconcile.reconcile_stores(a, b, "key", ["label"], ["note"], ["region"])
    return merged


@query("""
SELECT s_suppkey AS ref, CASE WHEN s_suppkey % 2 = 0 THEN coalesce(c.c_custkey, p.c_custkey) ELSE coalesce(p.c_custkey, c.c_custkey) END AS pk
FROM supplier LEFT JOIN customer p ON p.c_custkey = s_suppkey + 4 AND p.c_custkey % 8 = s_suppkey % 4
LEFT JOIN customer c ON c.c_custkey = s_suppkey AND c.c_custkey % 3 <> 0""")
def q_resolve_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References looked up among all customers, who are in both stores, some in another volume or without a name there."""
    c, k, s = A.table(spark, sf_dir, "customer"), F.col("c_custkey"), F.col("s_suppkey")
    provisional = c.select((k % 8).alias("volume"), (k - 4).cast("string").alias("legacy_id"), k.alias("pk"))
    canonical = c.select(F.when(k % 3 == 0, "").otherwise(k.cast("string")).alias("legacy_id"), k.alias("pk"))
    refs = A.table(spark, sf_dir, "supplier").select(s.alias("ref"), (s % 4).alias("volume"), s.cast("string").alias("legacy_id"), (s % 2 == 0).alias("review"))
    return reconcile.resolve_references(refs, provisional, canonical).select("ref", "pk")


@query(f"""WITH {A.PAIRS}, gone AS (SELECT o_orderkey FROM orders WHERE year(o_orderdate) - 1991 = 3),
dropped AS (SELECT c_custkey AS pk FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 4 = 3)
SELECT 'documents' AS rows_of, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT * FROM gone)
UNION ALL SELECT 'links', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT * FROM gone)
UNION ALL SELECT 'entities', count(*) FROM customer WHERE c_custkey NOT IN (SELECT * FROM dropped)
UNION ALL SELECT 'pairs', count(*) FROM pairs WHERE a NOT IN (SELECT * FROM dropped) AND b NOT IN (SELECT * FROM dropped)""")
def q_semi_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each table without a volume."""
    documents = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), (F.year("o_orderdate") - 1991).alias("volume"))
    links = A.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"))
    left = review.purge(3, documents, {"links": links}, A.customers(spark, sf_dir), A.pairs(spark, sf_dir))
    counts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("rows_of"), "n") for name, t in left.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out


@query("""
SELECT o_orderkey FROM orders WHERE o_orderkey >= 100 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')""")
def q_anti_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are still to be done; those that failed are done again."""
    index = A.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("sequence"))
    error = F.when(F.col("l_returnflag") == "R", "failed")
    done = A.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), error.alias("error"))
    return reconcile.pending(index, done, "o_orderkey", start=100).select("o_orderkey")


@query("""
SELECT DISTINCT volume FROM (SELECT (year(o_orderdate) - 1991)::BIGINT AS volume FROM orders UNION SELECT s_nationkey FROM supplier UNION SELECT c_custkey % 4 FROM customer)
WHERE volume IS NOT NULL""")
def q_volumes_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes that any table names."""
    orders = A.table(spark, sf_dir, "orders").select((F.year("o_orderdate") - 1991).alias("volume"))
    return export.volumes_of((orders, "volume"), (A.table(spark, sf_dir, "supplier"), "s_nationkey"), (A.customers(spark, sf_dir), "source_volume")).orderBy("volume")


@query("""
SELECT p_brand AS key, count(*) AS n FROM (SELECT p_brand FROM part UNION ALL SELECT p_brand FROM part WHERE p_size > 25) GROUP BY p_brand HAVING count(*) > 1""")
def q_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers that occur more than once over two tables."""
    part = A.table(spark, sf_dir, "part").withColumnRenamed("p_brand", "key")
    return export.repeated([("all", part), ("large", part.where("p_size > 25"))], "key")
