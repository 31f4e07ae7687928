"""Queries over lines of text and over strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import strings as S
from textloom.operators import segment
from textloom.plans import adapters as A
from textloom.plans.registry import QUERIES, SQL, query
from textloom.sources import readers

__all__ = ["QUERIES", "SQL"]


def _opener_sql(c: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({c}, '{p}')" for p in segment.OPENERS) + ")"


TAGS = (
    A.LINES
    + r""",
t0 AS (SELECT *, regexp_replace(line, '^\s+|\s+$', '', 'g') AS t FROM lines),
t1 AS (SELECT *, t = '' AS blank, row_number() OVER (PARTITION BY volume, page_no, t = '' ORDER BY pos) = 1 AND t <> '' AS top,
  coalesce(lag(t = '') OVER (PARTITION BY volume, page_no ORDER BY pos), false) AS after_blank FROM t0),
t2 AS (SELECT *, NOT blank AND NOT top AND NOT regexp_matches(t, '"""
    + segment.DOT_LEADER
    + "') AND "
    + _opener_sql("t")
    + r""" AS always FROM t1),
t3 AS (SELECT *, coalesce(bool_or(always) OVER (PARTITION BY volume ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)
  AS opened FROM t2),
tagged AS (SELECT volume, page_no, pos, line, t, CASE WHEN blank THEN 'blank' WHEN top THEN 'page_header'
  WHEN regexp_matches(t, '"""
    + segment.DOT_LEADER
    + r"""') THEN 'toc_entry'
  WHEN always OR (opened AND regexp_matches(t, '"""
    + segment.YEAR_RANGE
    + r"""')) THEN 'strict_open'
  WHEN regexp_matches(line, '"""
    + segment.FOOTNOTE
    + r"""') THEN 'footnote'
  WHEN after_blank AND length(t) <= 90 AND ("""
    + " OR ".join(f"regexp_matches(t, '{p}')" for p in segment.CANDIDATES)
    + r""") THEN 'candidate' ELSE 'body' END AS tag FROM t3)"""
)

SEGMENTS = (
    TAGS
    + r""",
kept AS (SELECT *, (tag = 'strict_open')::INT AS o, CASE WHEN tag = 'blank' THEN chr(10) WHEN tag = 'body' THEN line || chr(10)
  ELSE t || chr(10) END AS piece FROM tagged WHERE tag IN ('blank', 'body', 'strict_open', 'candidate')),
numbered AS (SELECT *, sum(o) OVER (PARTITION BY volume ORDER BY pos) AS seq FROM kept),
segments AS (SELECT volume, seq, arg_min(page_no, pos) AS page_start, arg_min(t, pos) AS date_header,
  string_agg(piece, '' ORDER BY pos) AS text, count(*) AS n_lines FROM numbered WHERE seq > 0 GROUP BY volume, seq)"""
)


@query(f"WITH {TAGS} SELECT volume, pos, tag FROM tagged")
def q_line_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kind of every line."""
    return segment.tag_lines(A.lines(spark, sf_dir)).select("volume", "pos", "tag")


@query(f"WITH {SEGMENTS} SELECT volume, seq::BIGINT AS seq, page_start, date_header, n_lines, md5(text) AS text_md5 FROM segments")
def q_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents assembled from lines; candidates stay text."""
    found = segment.assemble(segment.tag_lines(A.lines(spark, sf_dir)))
    return found.select("volume", "seq", "page_start", "date_header", "n_lines", F.md5("text").alias("text_md5"))


@query(
    f"WITH {TAGS}, "
    r"""near AS (SELECT volume, pos, line, tag,
  list(CASE WHEN tag IN ('body', 'strict_open') THEN t END) OVER (PARTITION BY volume ORDER BY pos ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS b,
  list(CASE WHEN tag IN ('body', 'strict_open') THEN t END) OVER (PARTITION BY volume ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS a,
  last_value(CASE WHEN tag = 'strict_open' THEN t END IGNORE NULLS) OVER (PARTITION BY volume ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS h
  FROM tagged)
SELECT volume, pos, line, coalesce(array_to_string(list_filter(b, lambda x: x IS NOT NULL)[-3:], ' / '), '') AS context_before,
  coalesce(array_to_string(list_filter(a, lambda x: x IS NOT NULL)[-3:], ' / '), '') AS context_after, coalesce(h, '') AS container_header
FROM near WHERE tag = 'candidate'"""
)
def q_candidate_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands around each line that may open a document."""
    return segment.candidate_context(segment.tag_lines(A.lines(spark, sf_dir)))


@query(
    f"WITH {SEGMENTS}, "
    """m AS (SELECT volume, list_sort(list(n_lines))[len(list(n_lines)) // 2 + 1] AS median FROM segments GROUP BY volume HAVING count(*) >= 3)
SELECT s.volume, s.seq::BIGINT AS seq, s.n_lines, m.median FROM segments s JOIN m USING (volume) WHERE s.n_lines > 2 * m.median"""
)
def q_length_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents more than twice as long as their volume's median."""
    found = segment.assemble(segment.tag_lines(A.lines(spark, sf_dir)))
    return segment.length_outliers(found, factor=2).select("volume", "seq", "n_lines", "median")


@query(r"""
WITH raw AS (SELECT p_partkey, p_brand || '; ' || p_type || ' (a; ' || p_size || ')' AS r FROM part),
items AS (SELECT p_partkey, list_transform(regexp_extract_all(r, '(?:\([^)]*\)|[^;])+'), lambda x: trim(x)) AS xs FROM raw)
SELECT p_partkey, n::INT AS n, xs[n + 1] AS item, regexp_replace(lower(xs[n + 1]), '\s*\([^)]*\)\s*$', '') AS bare
FROM (SELECT p_partkey, xs, unnest(range(len(xs))) AS n FROM items)""")
def q_split_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of variants, split outside parentheses."""
    part = A.table(spark, sf_dir, "part")
    raw = F.concat("p_brand", F.lit("; "), "p_type", F.lit(" (a; "), F.col("p_size").cast("string"), F.lit(")"))
    items = part.select("p_partkey", F.posexplode(S.split_variants(raw)).alias("n", "item"))
    return items.withColumn("bare", S.without_paren_tail(F.lower("item")))


@query(r"""
WITH n AS (SELECT doc_id, translate(regexp_replace(lower(regexp_replace(regexp_replace(coalesce(text, ''), '\s*\([^)]*\)\s*$', ''),
  '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g'), '.,;:', '') AS name FROM documents)
SELECT doc_id, md5(name) AS name_md5, md5(strip_accents(name)) AS folded_md5 FROM n""")
def q_normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts normalised as names are, with and without accents."""
    docs = A.table(spark, sf_dir, "documents")
    name = S.normalise_name(F.col("text"))
    return docs.select("doc_id", F.md5(name).alias("name_md5"), F.md5(S.fold_accents(name)).alias("folded_md5"))


@query(r"""
WITH d AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN ' ' || year(o_orderdate) || '/1449'
  WHEN 2 THEN 'um ' || year(o_orderdate) ELSE '0' || substr(year(o_orderdate)::VARCHAR, 1, 2) || ' x' END AS date FROM orders)
SELECT o_orderkey, TRY_CAST(nullif(regexp_extract(trim(date), '^(\d{3,4})', 1), '') AS INTEGER) AS year,
  TRY_CAST(trim(substr(date, 1, 5)) AS BIGINT) AS number FROM d""")
def q_document_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years at the start of dates in several shapes."""
    o, k = A.table(spark, sf_dir, "orders"), F.col("o_orderkey") % 4
    year = F.year("o_orderdate").cast("string")
    date = (
        F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(k == 1, F.concat(F.lit(" "), year, F.lit("/1449")))
        .when(k == 2, F.concat(F.lit("um "), year))
        .otherwise(F.concat(F.lit("0"), F.substring(year, 1, 2), F.lit(" x")))
    )
    return o.select("o_orderkey", S.leading_year(date).alias("year"), S.int_or_null(F.substring(date, 1, 5)).alias("number"))


@query("""
SELECT event_type, count(*) AS n, arg_min(props, event_id) AS first_example, min(event_id) AS first_pos FROM events GROUP BY event_type""")
def q_tag_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events by frequency, with their first example."""
    from textloom.operators.export import frequency

    return frequency(A.table(spark, sf_dir, "events"), "event_type", "props", "event_id")


@query("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, (props LIKE '{%')::BOOLEAN AS is_object FROM events""")
def q_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k string")
    return A.table(spark, sf_dir, "events").select("event_id", S.int_or_null(parsed["k"]).alias("k"), F.startswith("props", F.lit("{")).alias("is_object"))


@query("""
SELECT event_id, CASE event_id % 3 WHEN 1 THEN 1 ELSE 2 END::BIGINT AS n_records,
  CASE event_id % 3 WHEN 1 THEN '1' ELSE '1,2' END AS ids FROM events""")
def q_json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that are whole, cut inside their second record, or cut inside their third."""
    k = F.col("event_id") % 3
    record = lambda i: F.concat(F.lit(f'{{"id": {i}, "name": "'), "event_type", F.lit('", "more": '), "props", F.lit("}"))
    whole = F.concat(F.lit('{"results": ['), record(1), F.lit(","), record(2), F.lit("]}"))
    second = F.concat(F.lit('{"results": ['), record(1), F.lit(', {"id": 2, "na'))
    third = F.concat(F.lit('{"results":['), record(1), F.lit(","), record(2), F.lit(',{"id": 3'))
    text = F.when(k == 0, whole).when(k == 1, second).otherwise(third)
    fixed = A.table(spark, sf_dir, "events").select("event_id", readers.repaired(text).alias("r"))
    ids = F.transform("r", lambda x: F.get_json_object(x, "$.id"))
    return fixed.select("event_id", F.size("r").cast("long").alias("n_records"), F.array_join(ids, ",").alias("ids"))


@query("""
SELECT doc_id, lang, source FROM documents
WHERE contains(lower(coalesce(text, '') || ' ' || coalesce(lang, '') || ' ' || coalesce(source, '')), 'er en') AND coalesce(lang, '') = 'en'""")
def q_search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a phrase, whatever its case, in one language."""
    docs = A.table(spark, sf_dir, "documents")
    return docs.where(S.contains_in("Er en", "text", "lang", "source") & (F.coalesce("lang", F.lit("")) == "en")).select("doc_id", "lang", "source")


@query("""
SELECT doc_id, coalesce(nullif(regexp_replace(substr(regexp_replace(source || ' ' || lang || '! ' || doc_id, '[^\\pL\\pN]', '_', 'g'), 1, 40),
  '^_+|_+$', '', 'g'), ''), '') AS slug, CASE WHEN doc_id % 3 = 0 THEN 'a' ELSE '' END || CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN ' + ' ELSE '' END
  || CASE WHEN doc_id % 2 = 0 THEN 'b' ELSE '' END || CASE WHEN doc_id % 3 <> 0 AND doc_id % 2 <> 0 THEN 'OK' ELSE '' END AS badge,
  CASE WHEN doc_id % 5 = 0 THEN '' ELSE (doc_id % 700)::VARCHAR END
  || CASE WHEN doc_id % 5 <> 0 AND doc_id % 7 <> 0 THEN '-' ELSE '' END
  || CASE WHEN doc_id % 7 = 0 THEN '' ELSE (doc_id % 900)::VARCHAR END AS floruit FROM documents""".replace("\\\\", "\\"))
def q_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs, status badges and floruit texts."""
    from textloom.operators.review import status_badge

    docs, k = A.table(spark, sf_dir, "documents"), F.col("doc_id")
    rows = docs.withColumns({"a": (k % 3 == 0).cast("int"), "b": (k % 2 == 0).cast("int")})
    text = F.concat("source", F.lit(" "), "lang", F.lit("! "), k.cast("string"))
    start, end = F.when(k % 5 != 0, k % 700), F.when(k % 7 != 0, k % 900)
    return rows.select("doc_id", S.slug(text).alias("slug"), status_badge("a", "b").alias("badge"), S.floruit_text(start, end).alias("floruit"))
