"""The driver's tables in the shapes that the operators take, in Spark and, as common table
expressions, in DuckDB. Both sides of a pair define the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """volume, page_no, pos, line: every line of the documents as it is, with page headers, openers, footnotes
    and blanks as further lines beside them. Headers and openers stand before a line, blanks after it."""
    docs = table(spark, sf_dir, "documents")
    raw = docs.select("doc_id", F.regexp_extract("source", r"src(\d+)", 1).cast("int").alias("volume"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
    n, line = F.col("n"), F.col("line")
    year = (F.lit(834) + (F.col("doc_id") * 7 + n) % 700).cast("string")
    header = F.when(n % 20 == 0, F.concat(F.lit("- "), F.floor(n / 20).cast("string"), F.lit(" -")))
    extra = (
        F.when(n % 27 == 9, F.concat(F.lit("XII. "), F.substring(line, 1, 40)))
        .when(n % 27 == 18, "834—1264.")
        .when(n % 9 == 0, F.concat(year, F.lit(".")))
        .when(n % 9 == 4, "1) note")
        .when(n % 9 == 6, "part ...... 7")
    )
    shaped = F.posexplode(F.array(header, extra, line, F.when(n % 9 == 8, ""))).alias("k", "line")
    rows = raw.select("doc_id", "volume", "n", shaped).where("line is not null")
    # a document's lines come after all lines of those before it
    counts = rows.groupBy("volume", "doc_id").agg(F.count(F.lit(1)).alias("n_lines"))
    before = W.partitionBy("volume").orderBy("doc_id").rowsBetween(W.unboundedPreceding, -1)
    heads = counts.select(F.col("doc_id").alias("of"), F.coalesce(F.sum("n_lines").over(before), F.lit(0)).alias("head"))
    inside = F.row_number().over(W.partitionBy("doc_id").orderBy("n", "k"))
    page = F.col("doc_id") * 10_000 + F.floor(n / 20)
    placed = rows.join(heads, F.col("doc_id") == F.col("of"))
    return placed.select("volume", page.alias("page_no"), (F.col("head") + inside).cast("long").alias("pos"), "line")


LINES = r"""raw AS (
  SELECT doc_id, CAST(regexp_extract(source, 'src(\d+)', 1) AS INTEGER) AS volume,
    unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM documents),
worked AS (
  SELECT volume, doc_id, n, 0 AS k, '- ' || n // 20 || ' -' AS line FROM raw WHERE n % 20 = 0
  UNION ALL SELECT volume, doc_id, n, 1, CASE WHEN n % 27 = 9 THEN 'XII. ' || substr(line, 1, 40) WHEN n % 27 = 18 THEN '834—1264.'
    WHEN n % 9 = 0 THEN (834 + (doc_id * 7 + n) % 700)::VARCHAR || '.' WHEN n % 9 = 4 THEN '1) note' ELSE 'part ...... 7' END FROM raw WHERE n % 9 IN (0, 4, 6)
  UNION ALL SELECT volume, doc_id, n, 2, line FROM raw
  UNION ALL SELECT volume, doc_id, n, 3, '' FROM raw WHERE n % 9 = 8),
lines AS (
  SELECT volume, doc_id * 10000 + n // 20 AS page_no, row_number() OVER (PARTITION BY volume ORDER BY doc_id, n, k) AS pos, line FROM worked)"""


def authority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pk, canonical_name, variant_names, wikidata_id: the distinct part names, by name."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    pk = F.row_number().over(W.orderBy("p_name")).cast("long")
    word = lambda k: F.split_part("p_name", F.lit(" "), F.lit(k))
    rows = names.select(pk.alias("pk"), F.col("p_name").alias("canonical_name"), F.concat(word(2), F.lit(" of "), word(1), F.lit("; the "), word(1)).alias("variant_names"))
    return rows.withColumn("wikidata_id", F.when(F.col("pk") % 2 == 0, F.concat(F.lit("Q"), F.col("pk").cast("string"))).otherwise(""))


AUTHORITY = """authority AS (
  SELECT row_number() OVER (ORDER BY p_name) AS pk, p_name AS canonical_name,
    split_part(p_name, ' ', 2) || ' of ' || split_part(p_name, ' ', 1) || '; the ' || split_part(p_name, ' ', 1) AS variant_names
  FROM (SELECT DISTINCT p_name FROM part))"""


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, ordinal, name: part names, misspelled by line number; some reversed."""
    item, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = item.select("l_orderkey", "l_linenumber", "l_partkey").join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    k, name = F.col("l_linenumber") % 5, F.col("p_name")
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    spelled = (
        F.when(F.col("p_partkey") % 17 == 0, F.reverse(name))
        .when(k == 0, name)
        .when(k == 1, F.concat(word(2), F.lit(" "), word(1)))
        .when(k == 2, F.replace(name, F.lit("i"), F.lit("y")))
        .when(k == 3, F.expr("substring(p_name, 1, length(p_name) - 1)"))
        .otherwise(word(1))
    )
    return joined.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("ordinal"), spelled.alias("name"), "p_partkey")


MENTIONS = """mentions AS (
  SELECT l_orderkey AS doc, l_linenumber AS ordinal, p_partkey, CASE WHEN p_partkey % 17 = 0 THEN reverse(p_name)
    WHEN l_linenumber % 5 = 0 THEN p_name WHEN l_linenumber % 5 = 1 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
    WHEN l_linenumber % 5 = 2 THEN replace(p_name, 'i', 'y') WHEN l_linenumber % 5 = 3 THEN substr(p_name, 1, length(p_name) - 1)
    ELSE split_part(p_name, ' ', 1) END AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pk, canonical_name, variant_names, floruit_start, floruit_end: suppliers under part names."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("s_suppkey")
    own = table(spark, sf_dir, "supplier").join(part, F.col("p_partkey") == k).select("s_suppkey", "p_name")
    other = part.select(F.col("p_partkey").alias("o"), F.col("p_name").alias("other"))
    rows = own.join(other, F.col("o") == k + 1, "left")
    return rows.select(
        k.alias("pk"),
        F.when(k % 11 == 0, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(F.col("p_name")).alias("canonical_name"),
        F.when(k % 5 == 0, F.coalesce("other", F.lit(""))).otherwise("").alias("variant_names"),
        F.when(k % 7 != 0, (F.lit(1200) + k % 200).cast("int")).alias("floruit_start"),
        F.when(k % 3 == 0, (F.lit(1210) + k % 200).cast("int")).alias("floruit_end"),
    )


PERSONS = """persons AS (
  SELECT s_suppkey AS pk, CASE WHEN s_suppkey % 11 = 0 THEN split_part(p.p_name, ' ', 1) ELSE p.p_name END AS canonical_name,
    CASE WHEN s_suppkey % 5 = 0 THEN coalesce(o.p_name, '') ELSE '' END AS variant_names,
    CASE WHEN s_suppkey % 7 <> 0 THEN 1200 + s_suppkey % 200 END AS f0, CASE WHEN s_suppkey % 3 = 0 THEN 1210 + s_suppkey % 200 END AS f1
  FROM supplier JOIN part p ON p.p_partkey = s_suppkey LEFT JOIN part o ON o.p_partkey = s_suppkey + 1)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """candidate_pk, a, b, decision: customers with one of the next three."""
    k = F.col("c_custkey")
    decision = F.when(k % 5 == 0, "same").when(k % 5 == 1, "different").otherwise("")
    return table(spark, sf_dir, "customer").select(k.alias("candidate_pk"), k.alias("a"), (k + 1 + F.col("c_nationkey") % 3).alias("b"), decision.alias("decision"))


PAIRS = """pairs AS (
  SELECT c_custkey AS candidate_pk, c_custkey AS a, c_custkey + 1 + c_nationkey % 3 AS b,
    CASE WHEN c_custkey % 5 = 0 THEN 'same' WHEN c_custkey % 5 = 1 THEN 'different' ELSE '' END AS decision FROM customer)"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as entities: pk, display_id, canonical_name, status, review_status, source_volume."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("pk"), F.format_string("c%05d", k).alias("display_id"), F.col("c_name").alias("canonical_name"),
        F.when(k % 3 == 0, "provisional").otherwise("canonical").alias("status"),
        F.when(k % 2 == 0, "add").otherwise("").alias("review_status"), (k % 4).alias("source_volume"),
    )


CUSTOMERS = """customers AS (
  SELECT c_custkey AS pk, c_name AS canonical_name, CASE WHEN c_custkey % 3 = 0 THEN 'provisional' ELSE 'canonical' END AS status,
    CASE WHEN c_custkey % 2 = 0 THEN 'add' ELSE '' END AS review_status, c_custkey % 4 AS source_volume FROM customer)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mention, lat, lng, label, name: embeddings as places, under part names."""
    e = F.col("embedding")
    part = table(spark, sf_dir, "part").select((F.col("p_partkey") - 1).alias("mention"), F.col("p_name").alias("name"))
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("mention"), (F.lit(65.0) + e[0].cast("double")).alias("lat"), (F.lit(-19.0) + e[1].cast("double") * 3).alias("lng"), "label"
    )
    return rows.join(part, "mention", "left").fillna("", ["name"])


POINTS = """points AS (
  SELECT vec_id AS mention, 65.0 + embedding[1]::DOUBLE AS lat, -19.0 + embedding[2]::DOUBLE * 3 AS lng, label, coalesce(p_name, '') AS name
  FROM embeddings LEFT JOIN part ON p_partkey = vec_id + 1)"""


def km_sql(a: str, b: str) -> str:
    inner = (
        f"(pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat))"
        f" * pow(sin(radians({b}.lng - {a}.lng) / 2), 2))"
    )
    return f"6371.0 * 2 * atan2(sqrt({inner}), sqrt(1 - {inner}))"


def sorted_words_sql(c: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({c}, ' '), lambda w: w <> '')), ' ')"


def lcs_sql(a: str, b: str) -> str:
    """Longest common subsequence: rows of the table, each the running maximum of what it may become."""
    return (
        f"coalesce(list_reduce(list_prepend(list_transform(range(length({b})), lambda z: 0::BIGINT),"
        f" list_transform(string_split({a}, ''), lambda x: list_transform(string_split({b}, ''), lambda y: CASE WHEN x = y THEN 1::BIGINT ELSE 0::BIGINT END))),"
        " lambda r, m: list_transform(range(1, len(m) + 1), lambda j: list_max(list_transform(range(1, j + 1),"
        f" lambda t: greatest(r[t], coalesce(r[t - 1], 0) + m[t])))))[length({b})], 0)"
    )
