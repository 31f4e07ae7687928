r"""WARC: revisit records that say "not modified" are given back the response they stand for.

Records are matched as of their date: a revisit takes the latest earlier full response (status 200)
of the same canonical URL. The validators decide whether it may: entity tags by weak comparison
where both sides have one, else the modification dates; without either the match is reported as
unverified, and with different ones as a mismatch that carries nothing over. The headers of the
result are the response's, with those that a not-modified answer may renew taken from the revisit.

The as-of join works in slices of time, so a URL that holds a third of all records is spread over
many tasks; bodies are joined last, by record, to the records that were resolved.

Canonical URLs leave out scheme, user, ``www.`` and a default port, the fragment, an empty query
and trailing slashes; hosts are in lower case and the query's parts sorted.

Defined results: a record without URL or date resolves to nothing; headers may be null or without a
colon (such lines are dropped), and of headers that repeat each is kept; responses of one date are
equal to the as-of join and the one with the larger identifier is taken; repeated rows resolve alike;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.asof import latest_before
from textloom.llm.shared import ensure_columns

#: Seconds in a slice of the as-of join.
TIME_SLICE = 86_400
#: The header fields that a 304 answer renews.
RENEWED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    head = F.regexp_extract(bare, "^[^/?]*", 0)
    host = F.regexp_replace(F.regexp_replace(F.lower(head), "^[^@]*@", ""), "^www[0-9]*[.]|:80$|:443$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"^[^?]*[?](.*)$", 1)
    parts = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda x: x != "")), "&")
    return F.concat(host, path, F.when(parts != "", F.concat(F.lit("?"), parts)).otherwise(F.lit("")))


def header_list(block: Column) -> Column:
    """An array of (name in lower case, value), in the block's order."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), "\r?\n"), lambda x: x.rlike("^[^: \t]+[ \t]*:"))
    return F.transform(
        lines,
        lambda x: F.struct(
            F.lower(F.trim(F.regexp_extract(x, "^([^:]*):", 1))).alias("name"),
            F.trim(F.regexp_extract(x, "^[^:]*:(.*)$", 1)).alias("value"),
        ),
    )


def header(headers: Column, name: str) -> Column:
    """The first value of a field; null if there is none."""
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def merged_headers(stored: Column, fresh: Column) -> Column:
    """What a stored response's headers become when a not-modified answer arrives."""
    allowed = F.filter(fresh, lambda h: h["name"].isin(*RENEWED))
    kept = F.filter(stored, lambda h: ~F.exists(allowed, lambda a: a["name"] == h["name"]))
    return F.concat(kept, allowed)


def _same_tag(a: Column, b: Column) -> Column:
    return F.regexp_replace(a, "^W/", "") == F.regexp_replace(b, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records``: record_id, kind ("response" or "revisit"), url, date (seconds), status,
    headers (an HTTP header block), body. A row per record, its columns and: canonical, source_id
    (the response that a revisit stands for, or itself), outcome ("full", "other", "resolved",
    "unverified", "mismatch" or "missing"), merged (headers), content (body)."""
    ensure_columns(records, "record_id", "kind", "url", "date", "status", "headers", "body")
    fields = F.col("fields")
    light = records.select(
        F.col("record_id").cast("long").alias("record_id"), "kind", "url", F.col("date").cast("long").alias("date"),
        F.col("status").cast("int").alias("status"), header_list(F.col("headers")).alias("fields"),
        canonical_url(F.col("url")).alias("canonical"),
    )
    light = light.withColumn("full", F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False)))
    light = light.withColumn("again", F.coalesce((F.col("kind") == "revisit") | (F.col("status") == 304), F.lit(False)))
    placed = light.where("canonical is not null and date is not null and (full or again)")
    offered = F.when(F.col("full"), F.struct("record_id", "fields"))
    found = latest_before(placed, ["canonical"], "date", offered, TIME_SLICE).where("again")
    lost = light.where("(canonical is null or date is null) and again")
    revisits = found.unionByName(lost, allowMissingColumns=True)

    stored = F.col("found.fields")
    tags = (header(stored, "etag"), header(fields, "etag"))
    dates = (header(stored, "last-modified"), header(fields, "last-modified"))
    both = lambda pair: pair[0].isNotNull() & pair[1].isNotNull()
    same = F.when(both(tags), _same_tag(*tags)).when(both(dates), dates[0] == dates[1])
    outcome = (
        F.when(F.col("found").isNull(), "missing").when(same.isNull(), "unverified").when(same, "resolved").otherwise("mismatch")
    )
    revisits = revisits.withColumn("outcome", outcome)
    carried = F.col("outcome").isin("resolved", "unverified")
    revisits = revisits.withColumn("source_id", F.when(carried, F.col("found.record_id"))).withColumn(
        "merged", F.when(carried, merged_headers(stored, fields)).otherwise(fields)
    )
    columns = ["record_id", "kind", "url", "date", "status", "canonical", "source_id", "outcome", "merged"]
    responses = records.where((F.col("kind") == "response") & (F.col("status") == 200))
    bodies = responses.groupBy(F.col("record_id").cast("long").alias("__source")).agg(F.max("body").alias("content"))
    revisits = revisits.select(*columns)
    restored = revisits.where("source_id is not null").join(bodies, F.col("source_id") == F.col("__source"), "left").drop("__source")
    restored = restored.unionByName(revisits.where("source_id is null"), allowMissingColumns=True)
    rest = records.select(
        F.col("record_id").cast("long").alias("record_id"), "kind", "url", F.col("date").cast("long").alias("date"),
        F.col("status").cast("int").alias("status"), canonical_url(F.col("url")).alias("canonical"),
        F.col("record_id").cast("long").alias("source_id"), header_list(F.col("headers")).alias("merged"),
        F.col("body").alias("content"),
    )
    again = F.coalesce((F.col("kind") == "revisit") | (F.col("status") == 304), F.lit(False))
    full = F.coalesce((F.col("kind") == "response") & (F.col("status") == 200), F.lit(False))
    rest = rest.where(~again).withColumn("outcome", F.when(full, "full").otherwise("other"))
    return restored.unionByName(rest)
