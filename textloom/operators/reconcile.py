"""Bringing two stores together: by position, by identifier with precedence, by priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.strings import or_empty, strip


def positional_join(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """The n-th left row of a key with the n-th right row of the key; ``occurrence`` counts from 0.
    Left rows without partner have nulls (see ``join_failures``)."""
    nth = lambda order: F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return left.withColumn("occurrence", nth(left_order)).join(right.withColumn("occurrence", nth(right_order)), [*keys, "occurrence"], "left")


def join_failures(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    nth = lambda order: F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return left.withColumn("occurrence", nth(left_order)).join(right.withColumn("occurrence", nth(right_order)), [*keys, "occurrence"], "left_anti")


def prefer(first: Column, second: Column) -> Column:
    """The first value unless it is null or blank."""
    return F.coalesce(F.when(strip(first.cast("string")) != "", first), second)


def reconcile_stores(a: DataFrame, b: DataFrame, key: str, prefer_a: list[str], prefer_b: list[str], conflict: list[str]) -> tuple[DataFrame, DataFrame]:
    """Full outer by ``key``: columns of ``prefer_a`` come from ``a`` where it has them, those of
    ``prefer_b`` from ``b``. Rows where both have values of ``conflict`` that differ are set apart."""
    every = list(dict.fromkeys([*prefer_a, *prefer_b, *conflict]))
    left = a.select(key, F.struct(*every).alias("__a"), F.lit(True).alias("__in_a"))
    right = b.select(key, F.struct(*every).alias("__b"), F.lit(True).alias("__in_b"))
    both = left.join(right, key, "full")
    differ = F.lit(False)
    for c in conflict:
        x, y = strip(or_empty(F.col(f"__a.{c}").cast("string"))), strip(or_empty(F.col(f"__b.{c}").cast("string")))
        differ = differ | ((x != "") & (y != "") & (x != y))
    columns = [
        (prefer(F.col(f"__a.{c}"), F.col(f"__b.{c}")) if c in prefer_a or c in conflict else prefer(F.col(f"__b.{c}"), F.col(f"__a.{c}"))).alias(c)
        for c in every
    ]
    where = F.when(F.col("__in_a") & F.col("__in_b"), "both").when(F.col("__in_a"), "a").otherwise("b")
    merged = both.where(~differ).select(key, where.alias("found_in"), *columns)
    conflicts = both.where(differ).select(key, *[F.col(f"__a.{c}").alias(f"a_{c}") for c in conflict], *[F.col(f"__b.{c}").alias(f"b_{c}") for c in conflict])
    return merged, conflicts


def resolve_references(refs: DataFrame, provisional: DataFrame, canonical: DataFrame) -> DataFrame:
    """``refs``: volume, legacy_id, review. Provisional entities of the volume come first, canonical
    ones (by identifier) after; for review targets it is the other way round. Adds ``pk``."""
    p = provisional.select("volume", "legacy_id", F.col("pk").alias("__p"))
    c = canonical.select("legacy_id", F.col("pk").alias("__c"))
    rows = refs.join(p, ["volume", "legacy_id"], "left").join(c, "legacy_id", "left")
    return rows.withColumn("pk", F.when(F.col("review"), F.coalesce("__c", "__p")).otherwise(F.coalesce("__p", "__c"))).drop("__p", "__c")


def pick_ambiguous(keyed: DataFrame, hint_matches: Column, order: str) -> DataFrame:
    """``keyed``: key and candidates. Of several, the one that alone fits the hint, else the first."""
    w = W.partitionBy("key")
    rows = keyed.withColumn("__hit", hint_matches.cast("int")).withColumn("__hits", F.sum("__hit").over(w))
    first = F.when((F.col("__hit") == 1) & (F.col("__hits") == 1), 0).otherwise(1)
    return rows.withColumn("__r", F.row_number().over(w.orderBy(first, order))).where("__r = 1").drop("__hit", "__hits", "__r")


def pending(index: DataFrame, done: DataFrame, key: str, start: int = 0, end: int = 0) -> DataFrame:
    """Rows to (re)do: in the range (``end`` 0: to the last), not done without an error."""
    good = done.where("error is null").select(key)
    rows = index.where(F.col("sequence") >= start)
    rows = rows.where(F.col("sequence") <= end) if end else rows
    return rows.join(good, key, "left_anti")


def fill_by_name(rows: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    """``found``: name, score and columns. Blank columns take the value of the best-scored row of the name."""
    best = found.groupBy("name").agg(F.max_by(F.struct(*columns), "score").alias("__best"))
    out = rows.join(best, "name", "left")
    for c in columns:
        out = out.withColumn(c, prefer(F.col(c), F.col(f"__best.{c}")))
    return out.drop("__best")


def counts_agree(sources: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Per key: rows in the source, loaded and skipped, and whether they add up."""
    s = sources.groupBy(key).agg(F.count(F.lit(1)).alias("n_source"))
    m = loaded.groupBy(key).agg(F.count_if(~F.col("skipped")).alias("n_loaded"), F.count_if("skipped").alias("n_skipped"))
    both = s.join(m, key, "full").fillna(0)
    return both.withColumn("agree", F.col("n_loaded") + F.col("n_skipped") == F.col("n_source"))


def key_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys by where they are: key, found_in (a, b or both). Null is a key."""
    both = a.select(key).intersect(b.select(key)).withColumn("found_in", F.lit("both"))
    only = lambda x, y, name: x.select(key).distinct().exceptAll(y.select(key).distinct()).withColumn("found_in", F.lit(name))
    return both.unionAll(only(a, b, "a")).unionAll(only(b, a, "b"))
