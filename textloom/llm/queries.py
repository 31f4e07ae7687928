"""The registered queries of the corpus operators: each applies one operator, with production
parameters, to its whole table. ``SQL`` has DuckDB statements for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import chat, exact_dedup, kneser_ney, mixing, near_dedup, pieces, search, secrets, toxicity, warc
from textloom.llm.shared import documents, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from labelled rows that are not held out; every text is scored."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    held_out = F.coalesce(remainder("id", 5) == 0, F.lit(False))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's pieces, and whether decoding them gives the text."""
    encoded = pieces.encode(documents(spark, sf_dir))
    return encoded.select(F.col("id").alias("doc_id"), "n_pieces", "round_trip", F.col("ids").alias("piece_ids"))


def quoting_replies(messages: DataFrame) -> DataFrame:
    """The conversations as mail programs would send them: a message opens with quotations of the
    two turns before it, the older one a level deeper, in even turns only and with its white space
    changed; in every third turn only the first line of the turn before is quoted."""
    said = messages.groupBy("conv_id", "turn").agg(F.min(F.coalesce("text", F.lit(""))).alias("said"))

    def before(n: int) -> DataFrame:
        return said.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("said").alias(f"said{n}"))

    def quoted(text: Column, mark: str) -> Column:
        return F.concat(F.array_join(F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit(mark), x)), "\n"), F.lit("\n"))

    rows = messages.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    older = F.when(F.col("turn") % 2 == 0, quoted(F.replace("said2", F.lit(" "), F.lit("  ")), "> >  "))
    part = F.when(F.col("turn") % 3 == 0, F.split("said1", "\n")[0]).otherwise(F.col("said1"))
    text = F.concat(F.coalesce(older, F.lit("")), F.coalesce(quoted(part, "> "), F.lit("")), F.coalesce("text", F.lit("")))
    return rows.select("conv_id", "turn", "role", text.alias("text"))


@query
def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, sent with quotations, in reply order and without them."""
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.in_reply_order(quoting_replies(messages)).withColumnRenamed("conv", "conv_id")


SQL["op3_quotation_linking"] = r"""
WITH RECURSIVE said AS (SELECT conv_id, turn, min(coalesce(text, '')) AS said FROM conversations GROUP BY ALL),
sent AS (
  SELECT c.conv_id, c.turn, c.role,
    CASE WHEN b.said IS NOT NULL AND c.turn % 2 = 0 THEN array_to_string(list_transform(
      string_split(replace(b.said, ' ', '  '), chr(10)), lambda x: '> >  ' || x), chr(10)) || chr(10) ELSE '' END
    || CASE WHEN a.said IS NOT NULL THEN array_to_string(list_transform(
      string_split(CASE WHEN c.turn % 3 = 0 THEN string_split(a.said, chr(10))[1] ELSE a.said END, chr(10)),
      lambda x: '> ' || x), chr(10)) || chr(10) ELSE '' END
    || coalesce(c.text, '') AS text
  FROM conversations c LEFT JOIN said a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1
  LEFT JOIN said b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2),
msgs AS (
  SELECT DISTINCT conv_id AS conv, turn, coalesce(role, 'unknown') AS role, text FROM sent),
m AS (SELECT *, md5(role || chr(10) || text) AS msg FROM msgs),
ln AS (SELECT conv, turn, msg, unnest(string_split(text, chr(10))) AS line,
  unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n FROM m),
pre AS (SELECT *, regexp_extract(line, '^(?:[ \t]*>)*', 0) AS p FROM ln),
lv AS (SELECT conv, turn, msg, n, length(p) - length(replace(p, '>', '')) AS level,
  lower(trim(regexp_replace(substr(line, length(p) + 1), '[ \t\r]+', ' ', 'g'))) AS body FROM pre),
op AS (SELECT *, CASE WHEN lag(level) OVER w IS NULL OR lag(level) OVER w <> level OR lag(body) OVER w = '' THEN 1 ELSE 0 END AS o
  FROM lv WINDOW w AS (PARTITION BY conv, turn, msg ORDER BY n)),
ps AS (SELECT *, sum(o) OVER (PARTITION BY conv, turn, msg ORDER BY n) AS passage FROM op),
bodies AS (
  SELECT conv, turn, level, string_agg(body, ' ' ORDER BY n) AS body FROM ps WHERE body <> '' GROUP BY conv, turn, msg, level, passage
  UNION ALL SELECT conv, turn, level, body FROM ps WHERE body <> ''),
units AS (SELECT DISTINCT conv, turn, level, md5(body) AS hash FROM bodies WHERE conv IS NOT NULL AND turn IS NOT NULL),
linked AS (
  SELECT q.conv, q.turn, q.level, q.hash, max(o.turn) AS origin FROM units q
  LEFT JOIN units o ON o.level = 0 AND o.conv = q.conv AND o.hash = q.hash AND o.turn < q.turn
  WHERE q.level > 0 GROUP BY ALL),
replies AS (
  SELECT conv, turn, (max(struct_pack(a := -level, b := origin))).b AS reply_to FROM linked WHERE origin IS NOT NULL GROUP BY conv, turn),
chain(conv, turn, top) AS (
  SELECT conv, turn, reply_to FROM replies
  UNION SELECT c.conv, c.turn, r.reply_to FROM chain c JOIN replies r ON r.conv = c.conv AND r.turn = c.top),
threads AS (SELECT conv, turn, min(top) AS thread FROM chain GROUP BY conv, turn),
counted AS (SELECT conv, turn, count(*) AS n_quoted, count(origin) AS n_linked FROM linked GROUP BY conv, turn),
placed AS (
  SELECT m.conv, m.turn, m.role, m.msg, r.reply_to, coalesce(t.thread, m.turn) AS thread,
    coalesce(c.n_quoted, 0) AS n_quoted, coalesce(c.n_linked, 0) AS n_linked,
    regexp_replace(array_to_string(list_filter(string_split(m.text, chr(10)), lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)),
      '^(?:[ \t\r]*\n)+|(?:\n[ \t\r]*)+$', '', 'g') AS text
  FROM m LEFT JOIN counted c ON c.conv = m.conv AND c.turn = m.turn
  LEFT JOIN replies r ON r.conv = m.conv AND r.turn = m.turn
  LEFT JOIN threads t ON t.conv = m.conv AND t.turn = m.turn)
SELECT conv AS conv_id, turn, role, reply_to, thread,
  row_number() OVER (PARTITION BY conv ORDER BY thread NULLS FIRST, turn NULLS FIRST, role, msg) - 1 AS position,
  n_quoted, n_linked, text, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' AS chat
FROM placed
"""


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, sf_dir), reach=secrets.WHOLE_SCOPE)
    return found.select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"
    )


def crawl_records(pages: DataFrame) -> DataFrame:
    """Two records for each page: its response, and a later visit by another spelling of the URL
    that says "not modified" (one in five with another tag, one in seven without validators)."""
    tag = F.substring(F.md5("html"), 1, 12)
    day = F.lit(1_600_000_000) + F.col("page_id") * 60
    response = F.concat(
        F.lit("Content-Type: text/html\r\nCache-Control: max-age=60\r\nETag: \""), tag, F.lit('"\r\nContent-Length: '),
        F.length("html").cast("string"),
    )
    other = F.when(F.col("page_id") % 5 == 0, F.lit("other")).otherwise(tag)
    validators = F.when(F.col("page_id") % 7 == 0, F.lit("")).otherwise(F.concat(F.lit('ETag: W/"'), other, F.lit('"\r\n')))
    revisit = F.concat(validators, F.lit("Content-Length: 0\r\nCache-Control: max-age="), (F.col("page_id") % 100).cast("string"))
    again = F.concat(F.lit("HTTP://"), F.regexp_replace(F.regexp_replace("url", "#.*$", ""), "^https?://", ""), F.lit("#again"))
    first = pages.select(
        (F.col("page_id") * 2).alias("record_id"), F.lit("response").alias("kind"), "url", day.alias("date"),
        F.lit(200).alias("status"), response.alias("headers"), F.col("html").alias("body"),
    )
    second = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), again.alias("url"),
        (day + 30 + F.col("page_id") % 3 * 86_400).alias("date"), F.lit(304).alias("status"), revisit.alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return first.unionAll(second)


@query
def op5_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the crawl with what it stands for."""
    resolved = warc.resolve_revisits(crawl_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    headers = F.array_join(F.transform("merged", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return resolved.select(
        "record_id", "kind", "canonical", "date", "source_id", "outcome", headers.alias("headers"), F.md5("content").alias("content_md5")
    )


SQL["op5_revisit_resolution"] = r"""
WITH base AS (SELECT page_id, url, html, substr(md5(html), 1, 12) AS tag, 1600000000 + page_id * 60 AS day FROM pages),
bare AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM base),
canon AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^[^/?]*', 0)), '^[^@]*@', ''), '^www[0-9]*[.]|:80$|:443$', '', 'g')
    || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN regexp_extract(b, '^[^?]*[?](.*)$', 1) <> '' THEN '?' ||
      array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '^[^?]*[?](.*)$', 1), '&'), lambda x: x <> '')), '&')
      ELSE '' END AS canonical FROM bare),
revisits AS (
  SELECT page_id * 2 + 1 AS record_id, canonical, day + 30 + page_id % 3 * 86400 AS date, page_id % 7 <> 0 AS tagged,
    CASE WHEN page_id % 5 = 0 THEN 'other' ELSE tag END AS tag, page_id FROM canon),
found AS (
  SELECT r.*, (max(struct_pack(d := c.day, i := c.page_id))).i AS page
  FROM revisits r LEFT JOIN canon c ON c.canonical = r.canonical AND c.day < r.date GROUP BY ALL),
judged AS (
  SELECT f.*, c.tag AS stored, c.html, CASE WHEN f.page IS NULL THEN 'missing' WHEN NOT tagged THEN 'unverified'
    WHEN f.tag = c.tag THEN 'resolved' ELSE 'mismatch' END AS outcome FROM found f LEFT JOIN canon c ON c.page_id = f.page)
SELECT page_id * 2 AS record_id, 'response' AS kind, canonical, day AS date, page_id * 2 AS source_id, 'full' AS outcome,
  'content-type: text/html' || chr(10) || 'cache-control: max-age=60' || chr(10) || 'etag: "' || tag || '"' || chr(10)
    || 'content-length: ' || length(html) AS headers, md5(html) AS content_md5 FROM canon
UNION ALL
SELECT record_id, 'revisit', canonical, date, CASE WHEN outcome IN ('resolved', 'unverified') THEN page * 2 END, outcome,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN 'content-type: text/html' || chr(10)
      || CASE WHEN tagged THEN '' ELSE 'etag: "' || stored || '"' || chr(10) END || 'content-length: ' || length(html) || chr(10)
      || CASE WHEN tagged THEN 'etag: W/"' || tag || '"' || chr(10) ELSE '' END || 'cache-control: max-age=' || page_id % 100
    ELSE CASE WHEN tagged THEN 'etag: W/"' || tag || '"' || chr(10) ELSE '' END || 'content-length: 0' || chr(10)
      || 'cache-control: max-age=' || page_id % 100 END,
  CASE WHEN outcome IN ('resolved', 'unverified') THEN md5(html) END FROM judged
"""


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by 2-word shingles at 0.8."""
    groups = near_dedup.near_groups(documents(spark, sf_dir), words=2, percent=80)
    return groups.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


SQL["op6_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
items AS (SELECT doc_id, n, hash(unnest(s)) AS g FROM sized),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS k
  FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL),
links AS (SELECT x, y FROM common WHERE 100 * k >= 80 * (nx + ny - k)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
comps AS (SELECT x, least(x, min(y)) AS c FROM reach GROUP BY x)
SELECT s.doc_id, s.n AS n_shingles, coalesce(c.c, s.doc_id) AS component_id,
  s.doc_id = coalesce(c.c, s.doc_id) AS kept
FROM sized s LEFT JOIN comps c ON c.x = s.doc_id
"""


@query
def op7_water_filling_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2 in turn; 150 % of all words; at most two epochs."""
    plan = mixing.mix_plan(documents(spark, sf_dir), weights=(3, 1, 2), share_percent=150, max_epochs=2)
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


SQL["op7_water_filling_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM sized GROUP BY source),
weighed AS (SELECT *, 200 * s AS cap, [3, 1, 2][(rk - 1) % 3 + 1]::BIGINT AS w, 150 * sum(s) OVER () AS goal FROM src),
sorted AS (
  SELECT *, goal - coalesce(sum(cap) OVER (ORDER BY cap * 1.0 / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rem,
    sum(w) OVER (ORDER BY cap * 1.0 / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wrem FROM weighed),
level AS (SELECT rem, wrem FROM sorted WHERE cap * wrem > w * rem ORDER BY cap * 1.0 / w, rk LIMIT 1),
targets AS (
  SELECT z.*, CASE WHEN l.rem IS NULL OR z.cap * l.wrem <= z.w * l.rem THEN z.cap::DOUBLE
    ELSE l.rem::DOUBLE / l.wrem::DOUBLE * z.w END / 100.0::DOUBLE AS target
  FROM weighed z LEFT JOIN level l ON true),
plans AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS whole FROM targets),
docs AS (
  SELECT d.doc_id, d.size, d.h, p.rk, p.s, p.target, p.whole, floor(p.target)::BIGINT - p.whole * p.s AS gap
  FROM sized d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source),
r1 AS (SELECT *, size > 0 AND size <= gap AND sum(CASE WHEN size > 0 AND size <= gap THEN size ELSE 0 END)
  OVER (PARTITION BY rk ORDER BY h, size ROWS UNBOUNDED PRECEDING) <= gap AS p1 FROM docs),
g1 AS (SELECT *, gap - sum(CASE WHEN p1 THEN size ELSE 0 END) OVER (PARTITION BY rk) AS gap1 FROM r1),
r2 AS (SELECT *, NOT p1 AND size > 0 AND size <= gap1 AND sum(CASE WHEN NOT p1 AND size > 0 AND size <= gap1 THEN size ELSE 0 END)
  OVER (PARTITION BY rk ORDER BY h, size ROWS UNBOUNDED PRECEDING) <= gap1 AS p2 FROM g1),
g2 AS (SELECT *, gap1 - sum(CASE WHEN p2 THEN size ELSE 0 END) OVER (PARTITION BY rk) AS gap2 FROM r2),
r3 AS (SELECT *, NOT p1 AND NOT p2 AND size > 0 AND size <= gap2
  AND sum(CASE WHEN NOT p1 AND NOT p2 AND size > 0 AND size <= gap2 THEN size ELSE 0 END)
  OVER (PARTITION BY rk ORDER BY h, size ROWS UNBOUNDED PRECEDING) <= gap2 AS p3 FROM g2)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target,
  ((whole + CASE WHEN p1 OR p2 OR p3 THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM r3
"""


@query
def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigrams, learned from the rows that are not held out; every text is scored."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    model = kneser_ney.fit(docs.where(~held_out), order=2)
    scored = kneser_ney.score(docs, model)
    return scored.select(
        F.col("id").alias("doc_id"),
        F.coalesce(remainder("id", 7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


@query
def op9_bm25_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best rows for the whole text of every row whose identifier 50 divides."""
    found = search.top_k(documents(spark, sf_dir), F.col("doc_id") % 50 == 0, k=10)
    return found.select(F.col("query_id"), "rank", F.col("id").alias("doc_id"), F.round("score", 4).alias("score"))


SQL["op9_bm25_top_k"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS w FROM documents),
tf AS (SELECT doc_id, w, count(*) AS tf FROM words GROUP BY ALL),
dl AS (SELECT d.doc_id, coalesce(sum(tf), 0) AS len FROM documents d LEFT JOIN tf USING (doc_id) GROUP BY d.doc_id),
stat AS (SELECT count(*) AS n, sum(len) / count(*)::DOUBLE AS average FROM dl),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
scored AS (
  SELECT q.doc_id AS query_id, t.doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * t.tf * 2.2
    / (t.tf + 1.2 * (0.25 + 0.75 * len / average))), 6) AS s
  FROM tf q JOIN tf t ON q.w = t.w AND q.doc_id % 50 = 0 JOIN df ON df.w = q.w JOIN dl ON dl.doc_id = t.doc_id, stat
  GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, doc_id, round(s, 4) AS score FROM ranked WHERE rank <= 10
"""


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest identifier of each text stays; texts are compared unchanged."""
    groups = exact_dedup.exact_groups(documents(spark, sf_dir), keep="max")
    return groups.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


SQL["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
