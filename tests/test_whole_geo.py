"""Places are reconciled against all others, none left out by its identifier."""

from __future__ import annotations

import math
import random

import pytest
from oracle import SF

from textloom.catalogue import QUERIES
from textloom.functions.measures import EARTH_KM
from textloom.functions.similarity import lcs_length
from textloom.operators import geomatch

TOP, MAX_KM = 3, 40


def km(p, q):
    x, y = math.radians(p["lat"]), math.radians(q["lat"])
    h = math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(q["lng"] - p["lng"]) / 2) ** 2
    return EARTH_KM * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def score(a, b):
    x, y = (" ".join(sorted(n.lower().split())) for n in (a, b))
    return 200.0 * lcs_length(x, y) / (len(x) + len(y)) if x or y else 100.0


def brute(points):
    """mention: [(cand, sources)] by rank, from all pairs."""
    scores = {(a, b): score(a, b) for a in {p["name"] for p in points} for b in {p["name"] for p in points}}
    out = {}
    for p in points:
        others = [q for q in points if q["mention"] != p["mention"]]
        s = {q["mention"]: scores[p["name"], q["name"]] for q in others}
        pool = {q["mention"] for q in others if q["label"] is not None and q["label"] == p["label"]}
        names = sorted(pool, key=lambda c: (-s[c], c))[:TOP]
        near = {}
        if p["lat"] is not None:
            near = {q["mention"]: d for q in others if q["lat"] is not None and (d := km(p, q)) <= MAX_KM}
        geo = sorted(set(near) & pool or near, key=lambda c: (near[c], c))[:TOP]
        both = sorted(set(names) | set(geo), key=lambda c: (round(near[c], 2) if c in geo else 9e9, -round(s[c], 1), c))[:TOP]
        out[p["mention"]] = [(c, "geo+name" if c in names and c in geo else "geo" if c in geo else "name") for c in both] or [(None, None)]
    return out


def ranked(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.mention, r.rank or 0)):
        out.setdefault(r.mention, []).append((r.cand, r.sources))
    return out


def places_of(points):
    return points.selectExpr("mention as cand", "name as c_name", "lat as c_lat", "lng as c_lng", "label")


def test_every_point_is_reconciled(spark):
    from textloom.plans import adapters as A

    points = [r.asDict() for r in A.points(spark, SF).collect()]
    got = ranked(QUERIES["q_geo_reconcile"](spark, SF).collect())
    assert set(got) == {p["mention"] for p in points}
    assert got == brute(points)


def test_spots_blocks_and_blanks(spark):
    r = random.Random(3)
    names = ["Nes", "Holt", "Holt syðra", "", "Árnes"]
    rows = [(i, r.choice(names), 64 + r.random(), -20 + r.random() * 2, r.choice(["a", "b", None])) for i in range(120)]
    rows += [(200 + i, r.choice(names), 64.5, -19.5, "a") for i in range(60)]  # one spot
    rows += [(300, "Nes", 64.5, -19.4, "alone"), (301, "Nes", 10.0, 10.0, "far"), (302, "Holt", None, None, "a"), (303, "Holt", None, None, "none")]
    points = spark.createDataFrame(rows, "mention long, name string, lat double, lng double, label string")
    got = geomatch.reconcile_within(points, places_of(points), "label", TOP, MAX_KM, "token_sort")
    assert ranked(got.collect()) == brute([x.asDict() for x in points.collect()])


@pytest.mark.parametrize("block", [None, "label"])
def test_nearest_within_is_nearest(spark, block):
    r = random.Random(4)
    rows = [(i, 64 + r.gauss(0, 0.3), -20 + r.gauss(0, 0.5), r.choice("ab")) for i in range(300)]
    a = spark.createDataFrame(rows, "mention long, lat double, lng double, label string")
    b = a.toDF("cand", "c_lat", "c_lng", "label")
    a, b = (a, b) if block else (a.drop("label"), b.drop("label"))
    want = geomatch.nearest(geomatch.near(a, b, MAX_KM, block), 4).select("mention", "cand").collect()
    got = geomatch.nearest_within(a, b, 4, MAX_KM, block).select("mention", "cand").collect()
    assert sorted(got) == sorted(want)


def test_nearest_others_is_nearest(spark):
    r = random.Random(5)
    rows = [(i, 64 + r.gauss(0, 0.1), -20 + r.gauss(0, 0.2)) for i in range(300)]
    rows += [(1000 + i, 64.0, -20.0) for i in range(200)]  # one spot
    rows += [(5, 64.0, -20.0), (5, 64.0, -20.0), (5, 64.01, -20.0), (None, 64.0, -20.0), (2000, None, -20.0), (2001, math.nan, -20.0), (2002, 64.0, math.inf), (2003, 10.0, 10.0)]
    a = spark.createDataFrame(rows, "mention long, lat double, lng double")
    sane = a.where("abs(lat) <= 90 and abs(lng) <= 180")
    close = geomatch.near(sane, sane.toDF("cand", "c_lat", "c_lng"), 15)
    want = geomatch.nearest(close.where("mention <> cand"), 3).select("mention", "cand", "km", "rank").collect()
    got = geomatch.nearest_others(a, 3, 15).select("mention", "cand", "km", "rank").collect()
    assert sorted(got) == sorted(want)
    assert geomatch.nearest_others(a.limit(0), 3, 15).count() == 0


def test_the_radius_query_does_not_make_all_pairs(spark, monkeypatch):
    from textloom.plans import adapters as A

    r = random.Random(6)
    rows = [(i, 64 + r.gauss(0, 0.01), -20 + r.gauss(0, 0.02)) for i in range(1000)]
    points = spark.createDataFrame(rows, "mention long, lat double, lng double")
    monkeypatch.setattr(A, "points", lambda *_: points)
    made, nearest = [], geomatch.nearest
    monkeypatch.setattr(geomatch, "nearest", lambda pairs, n: made.append(pairs.count()) or nearest(pairs, n))
    assert QUERIES["q_geo_radius"](spark, SF).count() == 3000
    assert max(made) < 100_000  # of 999,000
