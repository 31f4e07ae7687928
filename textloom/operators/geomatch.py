"""Places and gazetteers: neighbours by distance, candidates by name and distance, blank filling."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.measures import haversine_km
from textloom.functions.similarity import SCORERS, token_sort_ratio
from textloom.functions.strings import float_or_null, normalise_place, or_empty, strip, valley_stem

KM_PER_DEGREE = math.pi * 6371.0 / 180


def near(points: DataFrame, places: DataFrame, max_km: float, block: str | None = None) -> DataFrame:
    """``points``: mention, lat, lng; ``places``: cand, c_lat, c_lng (and ``block`` on both, if
    named). Pairs at most ``max_km`` apart, with ``km``. The globe is cut into bands of latitude as
    high as the radius, and each band into cells as wide as the radius where the band is narrowest;
    a point looks into its own and the neighbouring cells, so the join is by equality."""
    height = max(max_km, 1e-6) / KM_PER_DEGREE * 1.001
    band = lambda c: F.floor(F.col(c) / height).cast("long")

    def width(of: Column) -> Column:
        outer = F.greatest(F.abs(of), F.abs(of + 1)) * height + height
        return F.when(outer >= 89.99, 360.0).otherwise(F.least(F.lit(height) / F.cos(F.radians(outer)), F.lit(360.0)))

    cell = lambda lng, of: F.floor((lng + 180.0) / width(of)).cast("long")
    last = lambda of: F.floor(F.lit(360.0) / width(of)).cast("long")

    def cells(of: Column) -> Column:
        c, end = cell(F.col("lng"), of), last(of)
        around = F.array(c - 1, c, c + 1)
        west = F.when(c <= 1, F.array(end - 1, end)).otherwise(F.array().cast("array<bigint>"))
        east = F.when(c >= end - 1, F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
        return F.transform(F.array_distinct(F.concat(around, west, east)), lambda x: F.struct(of.alias("b"), x.alias("c")))

    looks = F.flatten(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: cells(band("lat") + d)))
    left = points.where("lat is not null and lng is not null").withColumn("__cell", F.explode(looks))
    right = places.where("c_lat is not null and c_lng is not null")
    right = right.withColumn("__cell", F.struct(band("c_lat").alias("b"), cell(F.col("c_lng"), band("c_lat")).alias("c")))
    joined = left.join(right, ["__cell", *([block] if block else [])]).drop("__cell")
    km = haversine_km(F.col("lat"), F.col("lng"), F.col("c_lat"), F.col("c_lng"))
    return joined.withColumn("km", km).where(F.col("km") <= max_km)


def nearest(pairs: DataFrame, n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("mention").orderBy("km", "cand"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= n)


def _cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the folder that ``spark.checkpoint.dir`` names; only a local master may go without."""
    sc = df.sparkSession.sparkContext
    root = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="textloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return df.checkpoint()


def nearest_within(points: DataFrame, places: DataFrame, n: int, max_km: float, block: str | None = None) -> DataFrame:
    """What ``nearest(near(...), n)`` gives (mention, cand, km), without making the pairs that it drops.
    Of places at one spot only the ``n`` first identifiers can be among anyone's nearest, and points at one
    spot have the same ones, so spots are joined. The radius starts small and doubles: a spot that has
    ``n`` places inside it is done, the others look again, up to ``max_km``."""
    on = [block] if block else []
    real = lambda *columns: F.greatest(*[F.abs(F.col(c)) for c in columns]) < float("inf")  # noqa: E731  NaN is greatest
    first = F.row_number().over(W.partitionBy(*on, "c_lat", "c_lng").orderBy("cand"))
    places = places.where(real("c_lat", "c_lng") & F.col("c_lat").isNotNull() & F.col("c_lng").isNotNull())
    thin = _cut(places.withColumn("r", first).where(F.col("r") <= n).drop("r"))
    spots = points.where(real("lat", "lng") & F.col("lat").isNotNull() & F.col("lng").isNotNull()).select(*on, "lat", "lng").distinct()
    spots = spots.withColumn("mention", F.struct(*on, "lat", "lng"))  # identifiers may repeat
    left = spots = _cut(spots)
    blocks = thin.select(*on).distinct().count() if on else 1
    low, high = (F.struct(f("c_lat"), f("c_lng")) for f in (F.min, F.max))
    low, high, count = thin.agg(low, high, F.count("c_lat")).first()
    if not count:
        return points.select("mention", F.lit(None).cast("long").alias("cand"), F.lit(None).cast("double").alias("km")).limit(0)
    height, width = ((b - a) * KM_PER_DEGREE for a, b in zip(low, high, strict=True))
    area = height * width * math.cos(math.radians((low[0] + high[0]) / 2))
    radius = max(math.sqrt(abs(area) * n * blocks / (8 * math.pi * count)), max_km / 1024)
    done = []
    while True:
        radius = min(radius, max_km)
        close = _cut(nearest(near(left, thin, radius, block), n).select("mention", "cand", "km"))
        if radius == max_km:
            done.append(close)
            break
        full = close.groupBy("mention").agg(F.count(F.lit(1)).alias("found")).where(F.col("found") == n).select("mention")
        done.append(close.join(full, "mention", "left_semi"))
        left = _cut(left.join(full, "mention", "left_anti").select(*spots.columns))
        if left.isEmpty():
            break
        radius *= 2
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    found = found.select("mention.*", "cand", "km")
    return points.select("mention", "lat", "lng", *on).join(found, [*on, "lat", "lng"]).select("mention", "cand", "km")


def nearest_others(points: DataFrame, n: int, max_km: float) -> DataFrame:
    """``points``: mention, lat, lng. Of each the ``n`` nearest with another identifier, at most ``max_km`` away:
    mention, cand, km, rank. As many more are looked for as points share an identifier."""
    points = points.where("mention is not null")
    own = points.groupBy("mention").count().agg(F.max("count")).first()[0] or 0
    close = nearest_within(points, points.toDF("cand", "c_lat", "c_lng"), n + own, max_km)
    return nearest(close.where("mention <> cand"), n)


def pools(mentions: DataFrame, places: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """``mentions``: mention, district; ``places``: cand, block; ``crosswalk``: abbr, name. mention,
    cand: the places of the districts that the mention's may stand for, each once. Mentions without
    any get every place: that fallback is asked for, and pairs few mentions with a gazetteer."""
    known = crosswalk.select(F.lower(strip(F.col("abbr"))).alias("key"), F.lower(strip(F.col("name"))).alias("block"))
    bare = known.select(F.regexp_replace("key", r"\.+$", "").alias("key"), "block")
    own = places.select(F.lower(strip(F.col("block"))).alias("key"), F.lower(strip(F.col("block"))).alias("block"))
    names = known.unionAll(bare).unionAll(own).distinct()
    keyed = mentions.select("mention", F.lower(strip(or_empty(F.col("district")))).alias("key")).where("key <> ''")
    blocks = keyed.join(names, "key").select("mention", "block").distinct()
    inside = blocks.join(places.select("cand", F.lower(strip(F.col("block"))).alias("block")), "block").select("mention", "cand").distinct()
    rest = mentions.select("mention").join(inside, "mention", "left_anti").distinct()
    return inside.unionAll(rest.join(places.select("cand"), F.lit(True)).select("mention", "cand"))


def flag(km: Column, score: Column, confirm_km: float = 5, floor: float = 60, conflict_km: float = 25) -> Column:
    return (
        F.when((km <= confirm_km) & (score >= floor), "geo_confirmed")
        .when((km > conflict_km) & (score >= 80), "geo_conflict")
        .when(km <= confirm_km, "geo_only")
        .otherwise("")
    )


def _ranked(mentions: DataFrame, places: DataFrame, found: DataFrame, top: int, score: Callable[[Column, Column], Column]) -> DataFrame:
    """``found``: mention, cand, km, via. The table that ``reconcile`` describes."""
    merged = found.groupBy("mention", "cand").agg(
        F.round(F.max("km"), 2).alias("distance_km"), F.array_join(F.array_sort(F.collect_set("via")), "+").alias("sources")
    )
    merged = merged.join(mentions.select("mention", "name"), "mention").join(places.select("cand", "c_name"), "cand")
    merged = merged.withColumns({"x": normalise_place(F.col("name")), "y": normalise_place(F.col("c_name"))})
    merged = merged.withColumn("name_score", F.round(score(F.col("x"), F.col("y")), 1))
    order = [F.coalesce("distance_km", F.lit(9e9)), F.desc("name_score"), F.asc("cand")]
    ranked = merged.withColumn("rank", F.row_number().over(W.partitionBy("mention").orderBy(*order))).where(F.col("rank") <= max(top, 1))
    ranked = ranked.withColumn("flag", F.coalesce(flag(F.col("distance_km"), F.col("name_score")), F.lit("")))
    columns = ["mention", "cand", "name_score", "distance_km", "flag", "sources", "rank"]
    return mentions.select("mention").join(ranked.select(*columns), "mention", "left")


def reconcile(mentions: DataFrame, places: DataFrame, pool: DataFrame, top: int = 5, max_km: float = 15, scorer: str = "weighted") -> DataFrame:
    """``mentions``: mention, name, lat, lng; ``places``: cand, c_name, c_lat, c_lng; ``pool``:
    mention, cand. Best ``top`` by name and ``top`` by distance (from all places, if the pool has
    none near), ranked by distance, then score: mention, cand, name_score, distance_km, flag, sources,
    rank. Scores are rounded to one place, distances to two. Mentions without any get a row without cand."""
    score = SCORERS[scorer]
    names = pool.join(mentions.select("mention", "name"), "mention").join(places.select("cand", "c_name"), "cand")
    names = names.withColumns({"x": normalise_place(F.col("name")), "y": normalise_place(F.col("c_name"))})
    names = names.withColumn("score", score(F.col("x"), F.col("y")))
    best = names.withColumn("r", F.row_number().over(W.partitionBy("mention").orderBy(F.desc("score"), "cand"))).where(F.col("r") <= top)
    by_name = best.select("mention", "cand", F.lit(None).cast("double").alias("km"), F.lit("name").alias("via"))
    close = near(mentions.select("mention", "lat", "lng"), places.select("cand", "c_lat", "c_lng"), max_km).select("mention", "cand", "km")
    inside = close.join(pool, ["mention", "cand"], "left_semi")
    outside = close.join(inside.select("mention").distinct(), "mention", "left_anti")
    by_km = nearest(inside.unionAll(outside), top).select("mention", "cand", "km", F.lit("geo").alias("via"))
    return _ranked(mentions, places, by_name.unionByName(by_km), top, score)


def reconcile_within(mentions: DataFrame, places: DataFrame, block: str, top: int = 5, max_km: float = 15, scorer: str = "weighted") -> DataFrame:
    """``reconcile`` with all places of a mention's ``block`` (a column on both sides) as its pool, a
    place with the mention's own identifier left out. The pool's pairs are not made: names are scored once for a
    block, and one candidate more than asked for is kept, which is the mention's own or too many."""
    score, keep = SCORERS[scorer], top + 1
    m = mentions.select("mention", block, normalise_place(F.col("name")).alias("x"))
    c = places.select("cand", block, normalise_place(F.col("c_name")).alias("y"))
    same = F.row_number().over(W.partitionBy(block, "y").orderBy("cand"))
    c = c.withColumn("r", same).where(F.col("r") <= keep).drop("r")
    pairs = m.select(block, "x").distinct().join(c.select(block, "y").distinct(), block)
    scores = pairs.select("x", "y").distinct().withColumn("score", score(F.col("x"), F.col("y")))
    by_score = F.row_number().over(W.partitionBy(block, "x").orderBy(F.desc("score"), "cand"))
    best = pairs.join(scores, ["x", "y"]).join(c, [block, "y"]).withColumn("r", by_score).where(F.col("r") <= keep).drop("r", "y")
    others = m.join(best, [block, "x"]).where("mention <> cand")
    cut = F.row_number().over(W.partitionBy("mention").orderBy(F.desc("score"), "cand"))
    others = others.withColumn("r", cut).where(F.col("r") <= top)
    by_name = others.select("mention", "cand", F.lit(None).cast("double").alias("km"), F.lit("name").alias("via"))
    spots = places.select("cand", "c_lat", "c_lng", block)
    inside = nearest_within(mentions.select("mention", "lat", "lng", block), spots, keep, max_km, block).where("mention <> cand")
    lonely = mentions.select("mention", "lat", "lng").join(inside.select("mention").distinct(), "mention", "left_anti")
    outside = nearest_within(lonely, spots.drop(block), keep, max_km).where("mention <> cand")
    by_km = nearest(inside.unionAll(outside), top).select("mention", "cand", "km", F.lit("geo").alias("via"))
    return _ranked(mentions, places, by_name.unionByName(by_km), top, score)


def geocode(places: DataFrame, gazetteer: DataFrame, accept: int = 70) -> DataFrame:
    """``places``: pk, name, wikidata_id, lat, lng, geo_score; ``gazetteer``: qid, all_labels, g_lat,
    g_lng. Places without a latitude take the best entry's identifier and score, and its coordinates
    if the score (cut to an integer) is ``accept`` or more; what they have stays."""
    lacking = places.where("lat is null")
    names = lacking.select(F.lower("name").alias("key")).distinct()
    pairs = names.join(gazetteer.select("qid", "all_labels", "g_lat", "g_lng"), F.lit(True))
    pairs = pairs.withColumn("score", token_sort_ratio(F.col("key"), F.lower("all_labels")).cast("int"))
    best = pairs.groupBy("key").agg(F.min_by(F.struct("qid", "g_lat", "g_lng", "score"), F.struct(-F.col("score"), F.col("qid"))).alias("b"))
    rows = places.join(best, (F.lower("name") == F.col("key")) & F.col("lat").isNull(), "left")
    good = F.col("b.score") >= accept
    return rows.withColumns({
        "wikidata_id": F.coalesce(F.nullif("wikidata_id", F.lit("")), "b.qid", F.lit("")),
        "geo_score": F.coalesce("b.score", "geo_score"),
        "lat": F.coalesce("lat", F.when(good, F.col("b.g_lat"))),
        "lng": F.coalesce("lng", F.when(good, F.col("b.g_lng"))),
    }).drop("key", "b")


def valley_candidates(valleys: DataFrame, districts: DataFrame) -> DataFrame:
    """``valleys``: valley; ``districts``: district. Pairs where one stem contains the other. Both
    are small lists of a country's names, so they are compared one with another."""
    v = valleys.select("valley", valley_stem(F.col("valley")).alias("v")).where("v <> ''").distinct()
    d = districts.select("district", valley_stem(F.col("district")).alias("d")).where("d <> ''").distinct()
    return v.join(d, F.contains("v", "d") | F.contains("d", "v")).select("valley", "district").orderBy("valley", "district")


def to_geocode(places: DataFrame, ungeocoded_only: bool = False) -> DataFrame:
    """``places``: pk, canonical_name, place_type, district, region, modern_equivalent, lat and lng as
    text. What a second gazetteer is asked for: mention, name, district (else the region), region
    (else the modern equivalent), place_type, lat, lng, geocoded (it has a latitude)."""
    first = lambda *columns: F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns], F.lit(""))
    rows = places.select(
        F.col("pk").alias("mention"), or_empty(F.col("canonical_name")).alias("name"), first("district", "region").alias("district"),
        first("region", "modern_equivalent").alias("region"), or_empty(F.col("place_type")).alias("place_type"),
        float_or_null(F.col("lat")).alias("lat"), float_or_null(F.col("lng")).alias("lng"),
    ).withColumn("geocoded", F.col("lat").isNotNull())
    return rows.where(~F.col("geocoded")) if ungeocoded_only else rows
