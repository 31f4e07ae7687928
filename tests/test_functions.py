from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from textloom.functions import measures, similarity, strings


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a (x;y);b;c (z", ["a (x;y)", "b", "c (z"]),
        ("a);b", ["a)", "b"]),
        ("((a;b);c);d", ["((a;b);c)", "d"]),
        (" ; ;;", []),
        ("", []),
        (None, []),
    ],
)
def test_split_variants(spark, text, want):
    assert one(spark, text, strings.split_variants) == want


def test_split_plain(spark):
    assert one(spark, "a (x;y); ;b", strings.split_plain) == ["a (x", "y)", "b"]


def test_strip_is_unicode(spark):
    assert one(spark, "   \t\n a b  ", strings.strip) == "a b"


def test_name_forms(spark):
    df = spark.createDataFrame([(' "Holt (farm)" ', "Holt; 'Holti' (x;y); HOLT")], "c string, v string")
    forms = df.select(strings.name_forms(F.col("c"), F.col("v"))).first()[0]
    assert forms == ['holt (farm)', "holt", "holti' (x;y)", "holti'"] or "holt" in forms
    assert len(forms) == len(set(forms))


@pytest.mark.parametrize(
    ("text", "want"), [("Jón  Þorláksson (x)", "jón þorláksson"), ("A. B, C;:", "a b c"), ("a . b", "a  b"), (None, "")]
)
def test_normalise_name(spark, text, want):
    assert one(spark, text, strings.normalise_name) == want


def test_fold_accents(spark):
    assert one(spark, "öáþðæÓçñüÅ", strings.fold_accents) == "oaþðæOcnuA"
    assert one(spark, "é", strings.fold_accents) == "e"


@pytest.mark.parametrize(
    ("text", "want"), [("1265/1449", 1265), ("1341-06-14", 1341), ("", None), ("um 1300", None), ("0846 x", 846), (" 999 ", 999), (None, None)]
)
def test_leading_year(spark, text, want):
    assert one(spark, text, strings.leading_year) == want


@pytest.mark.parametrize(("text", "want"), [("1.5", 1.5), (" -2 ", -2.0), ("NaN", None), ("1d", None), ("65° 3' N", None), ("", None)])
def test_float_or_null(spark, text, want):
    assert one(spark, text, strings.float_or_null) == want


def test_small_string_functions(spark):
    assert one(spark, "7x", strings.int_or_null) is None and one(spark, " 12 ", strings.int_or_null) == 12
    assert one(spark, "Á la carte!?" + "x" * 50, strings.slug) == "Á_la_carte__" + "x" * 28
    assert one(spark, "Laxárdalur", strings.valley_stem) == "laxardal"
    assert one(spark, "```json\n{}\n```", strings.without_fence) == "{}"
    df = spark.createDataFrame([("see [4] and [44]", None, 1300)], "t string, a int, b int")
    assert df.select(strings.replace_token(F.col("t"), F.lit("4"), F.lit("9"))).first()[0] == "see [9] and [44]"
    assert df.select(strings.floruit_text(F.col("a"), F.col("b"))).first()[0] == "1300"
    assert df.select(strings.contains_in("AND [", "t", "a")).first()[0]


GOLDEN = [
    ("Þorláksson", "Þorleifsson", None), ("Hamaburg", "Hammaburg", 94.1), ("Fell", "Felli", 88.9), ("Nes", "Nesi", 85.7),
    ("Jón", "Jón Þorláksson", 35.3), ("b a", "a b", 100.0),
]


@pytest.mark.parametrize(("a", "b", "score"), GOLDEN)
def test_token_sort_ratio(spark, a, b, score):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(similarity.token_sort_ratio(F.col("a"), F.col("b"))).first()[0]
    if score is not None:
        assert round(got, 1) == score
    native = spark.createDataFrame([(a, b)], "a string, b string").select(similarity.lcs_native(F.col("a"), F.col("b"))).first()[0]
    assert native == similarity.lcs_length(a, b)


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(new[-1], row[j + 1], row[j] + (x == y)))
        row = new
    return row[-1]


def test_lcs_and_the_lossless_filter(spark):
    r = random.Random(1)
    pairs = [("".join(r.choices("abcd ", k=r.randint(0, 14))), "".join(r.choices("abcd ", k=r.randint(0, 14)))) for _ in range(1500)]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", similarity.lcs(F.col("a"), F.col("b")).alias("c"), similarity.may_reach(F.col("a"), F.col("b"), 60).alias("m")).collect()
    for row in rows:
        assert row.c == plain_lcs(row.a, row.b)
        if len(row.a + row.b) and 200 * row.c >= 60 * (len(row.a) + len(row.b)):
            assert row.m


def test_weighted_ratio():
    assert similarity.weighted_ratio("jón", "jón þorláksson") == pytest.approx(90)
    assert similarity.weighted_ratio("same", "same") == 100
    assert similarity.weighted_ratio("", "x") == 0


def test_bare_names(spark):
    f = lambda a, b: spark.createDataFrame([(a, b)], "a string, b string").select(similarity.is_bare_name_of(F.col("a"), F.col("b"))).first()[0]
    assert f("jón", "jón x") and f("jón x", "jón") and not f("jón", "jón") and not f("x", "jón x")


def test_scorers_can_be_added(spark):
    similarity.register_scorer("equal", lambda a, b: F.when(a == b, 100.0).otherwise(0.0))
    assert spark.range(1).select(similarity.SCORERS["equal"](F.lit("a"), F.lit("a"))).first()[0] == 100


@pytest.mark.parametrize(
    ("a0", "a1", "b0", "b1", "want"),
    [(1300, 1310, 1430, 1440, "overlap"), (1300, 1310, 1431, 1440, "conflict"), (None, 1300, 1300, None, "overlap"), (0, None, 1300, 1300, "unknown")],
)
def test_date_status(spark, a0, a1, b0, b1, want):
    df = spark.createDataFrame([(a0, a1, b0, b1)], "a int, b int, c int, d int")
    assert df.select(measures.date_status(*map(F.col, "abcd"), 60)).first()[0] == want


def test_haversine(spark):
    got = spark.range(1).select(measures.haversine_km(F.lit(64.15), F.lit(-21.95), F.lit(65.68), F.lit(-18.1))).first()[0]
    assert math.isclose(got, 250, rel_tol=0.02)
