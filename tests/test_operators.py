from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.functions.measures import EARTH_KM
from textloom.operators import duplicates, export, geomatch, merge, reconcile, resolve, review, segment

PAGES = [
    (1, 1, "TITLE\n\n834—1264.\n\n1. fyrst þat\n\n  1341. Júní 14.  \nbody one\n2) note\n\nXII. Holt.\n1. clause\n2. clause"),
    (1, 2, "running head\n54.  1397. Deed...... 62\n\n1345—1350.\nmore text\n[1400] í Holti\n" + "x\n" * 40),
    (2, 1, "head\n[um 1300—1310]. á alþingi.\ntext\n5. 31. Mai 858.\nlast"),
]


@pytest.fixture
def tagged(spark):
    return segment.tag_lines(segment.lines_of(spark.createDataFrame(PAGES, "volume int, page_no int, text string"))).cache()


def test_tags(tagged):
    got = [(r.line.strip(), r.tag) for r in tagged.where("volume = 1").orderBy("pos").collect()]
    kinds = dict(got)
    assert kinds["TITLE"] == "page_header" and kinds["834—1264."] == "body"
    assert kinds["1. fyrst þat"] == "candidate" and kinds["1341. Júní 14."] == "strict_open"
    assert kinds["2) note"] == "footnote" and kinds["XII. Holt."] == "candidate"
    assert kinds["1. clause"] == kinds["2. clause"] == "body"
    assert kinds["54.  1397. Deed...... 62"] == "toc_entry" and kinds["1345—1350."] == "strict_open"
    assert kinds["[1400] í Holti"] == "strict_open"


def test_assembly_and_classes(spark, tagged):
    plain = {(r.volume, r.seq): r for r in segment.assemble(tagged).collect()}
    assert plain[1, 1].date_header == "1341. Júní 14." and plain[1, 1].page_start == 1
    assert plain[1, 1].text.startswith("1341. Júní 14.\nbody one\n\nXII. Holt.\n1. clause\n")
    assert plain[2, 1].date_header == "[um 1300—1310]. á alþingi." and plain[2, 2].text == "5. 31. Mai 858.\nlast\n"
    context = segment.candidate_context(tagged)
    holt = context.where("line like 'XII%'").first()
    assert holt.container_header == "1341. Júní 14." and holt.context_before.endswith("body one")
    classes = segment.classify_candidates(context)
    assert {r["class"] for r in classes.collect()} == {"uncertain"}

    def opens(frames):
        for f in frames:
            yield pd.DataFrame({"volume": f.volume, "pos": f.pos, "class": ["new_document" if x.startswith("XII") else "header_noise" for x in f.line], "correction": ""})

    found = segment.classify_candidates(context, opens)
    cut = {(r.volume, r.seq): r for r in segment.assemble(tagged, found).collect()}
    assert cut[1, 2].date_header == "XII. Holt." and len(cut) == len(plain) + 1
    assert segment.flagged(tagged, classes).count() == 2


def test_length_outliers(spark):
    rows = [(1, i, n) for i, n in enumerate([1, 2, 3, 4, 19])] + [(2, 1, 50), (2, 2, 1)]
    found = segment.length_outliers(spark.createDataFrame(rows, "volume int, seq int, n_lines int")).collect()
    assert [(r.volume, r.seq, r.median) for r in found] == [(1, 4, 3)]


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_fuzzy_best_is_the_first_best(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        authority = spark.createDataFrame([(1, "Jon Holt", "Holt"), (2, "Jon Hold", ""), (3, "Anna", "Jon Holt")], "pk long, canonical_name string, variant_names string")
        forms = resolve.forms_last_wins(authority)
        assert {r.form: r.pk for r in forms.collect()}["jon holt"] == 3
        mentions = spark.createDataFrame([(1, 0, "Holt Jon"), (1, 1, "jon hol"), (1, 2, "zzz"), (1, 3, " ")], "doc long, ordinal int, name string")
        got = {r.ordinal: r for r in resolve.resolve_persons(mentions, forms).collect()}
        assert got[0].pk == 3 and got[0].band == "accept" and got[1].matched_form == "jon holt"
        assert got[2].band == "new" and got[2].score == 0 and 3 not in got
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_exact_and_multi_lookup(spark):
    authority = spark.createDataFrame([(2, "Holt (farm)", "", "Q7"), (1, "Nes", "Holt", "")], "pk long, canonical_name string, variant_names string, wikidata_id string")
    mentions = spark.createDataFrame([(1, "HOLT", "", ""), (2, "Nes (x)", "", ""), (3, "?", "Q7", ""), (4, "?", "", "a; nes"), (5, None, None, None)], "id long, name string, wikidata_id string, variants string")
    assert {r.id: r.pk for r in resolve.exact_lookup(mentions, authority).collect()} == {1: 1, 2: None, 3: None, 4: None, 5: None}
    got = {r.id: (r.pk, r.strategy) for r in resolve.multi_lookup(mentions, authority).collect()}
    assert got == {1: (1, "canonical"), 2: (1, "paren"), 3: (2, "wikidata"), 4: (1, "variant"), 5: (None, None)}


def test_places_take_exact_hits_first(spark):
    authority = spark.createDataFrame([(1, "Nes", "")], "pk long, canonical_name string, variant_names string")
    m = spark.createDataFrame([(1, 0, "NES"), (1, 1, "Nesi")], "doc long, ordinal int, name string")
    got = {r.ordinal: (r.pk, r.score) for r in resolve.resolve_places(m, authority).collect()}
    assert got[0] == (1, 100.0) and got[1][0] == 1 and got[1][1] < 100


def test_mentions_union_and_minting(spark):
    docs = spark.createDataFrame([(1, [("Nes", "loc.writing", "r")], ["nes", "Holt", " ", "Holt"])], "doc long, locations array<struct<name:string,role:string,region:string>>, all_places array<string>")
    got = [(r.ordinal, r.name, r.role) for r in resolve.place_mentions(docs).orderBy("ordinal").collect()]
    assert got == [(0, "Nes", "loc.writing"), (1, "Holt", "loc.mentioned")]
    new = spark.createDataFrame([(2, 5, 1, "b"), (1, 9, 2, "a"), (1, 9, 3, "A"), (1, 8, 1, "c")], "volume int, doc long, ordinal int, name string")
    assert [(r.legacy_id, r.display_id, r.name) for r in resolve.mint(new, "p", 7).orderBy("number").collect()] == [
        ("p008", "v01-p008", "c"), ("p009", "v01-p009", "a"), ("p010", "v02-p010", "b")
    ]
    ids = spark.createDataFrame([("p007",), ("p12x",), ("q99",), ("p011",)], "legacy_id string")
    assert resolve.max_suffix(ids, "p") == 11
    again = resolve.suffix_repeats(spark.createDataFrame([("x", 1), ("x", 2), ("x", 3), ("y", 4)], "i string, o int"), "i", "o")
    assert sorted(r.unique_id for r in again.collect()) == ["x", "x-b", "x-c", "y"]


def test_place_folding(spark):
    assert resolve.fold_names(["Hamaburg", "Hammaburg", "Nes", "Hamaburgh", "Holt"]) == [0, 0, 1, 0, 2]
    new = spark.createDataFrame([(1, 1, "Hammaburg"), (1, 0, "Hamaburg"), (2, 0, "Hamaburg"), (2, 1, None)], "doc long, ordinal int, name string")
    got = {(r.doc, r.ordinal): r.place for r in resolve.fold_places(new).collect()}
    assert got == {(1, 0): 0, (1, 1): 0, (2, 0): 0, (2, 1): 1}


def test_places_of_many_documents_are_folded_at_once(spark, monkeypatch):
    r = random.Random(7)
    stems = ["Hammaburg", "Hamaburg", "Hamborg", "Nes", "Nés", "Holt", "holt syðra", "Syðra Holt", "Árnes \U0001d538", " ", "", None]
    spell = lambda: (lambda n: n if not n or r.random() < 0.5 else n.replace(r.choice(n), r.choice("aeo "), 1))(r.choice(stems))
    rows = [(doc, i, spell()) for doc in range(400) for i in range(r.choice([1, 3, 7, 30]))]
    rows += [(None, 0, "Nes"), (None, 1, "Nes"), (1000, None, "Holt"), (1000, 4, "Nes")]
    rows += [(2000, i, "".join(r.choices("abcd", k=12))) for i in range(400)]  # pairs and rows in several pieces
    want = []
    for doc in {d for d, _, _ in rows}:
        own = sorted([x for x in rows if x[0] == doc], key=lambda x: (x[1] is None, x[1]))
        want += zip(own, resolve.fold_names([n or "" for _, _, n in own]), strict=True)
    new = spark.createDataFrame(r.sample(rows, len(rows)), "doc long, ordinal int, name string")
    got = [((x.doc, x.ordinal, x.name), x.place) for x in resolve.fold_places(new).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # in small pieces
    monkeypatch.setattr(resolve, "FOLDED_ROWS", 300)
    monkeypatch.setattr(resolve._Folder, "PAIRS", 150)
    monkeypatch.setattr(resolve._Folder, "KEPT", 100)
    table = pa.table([pa.array(c) for c in zip(*(x for x, _ in want), strict=True)], ["doc", "ordinal", "name"])
    out = pa.Table.from_batches(resolve._fold(resolve.SAME_PLACE)(iter(table.to_batches(max_chunksize=70))))
    assert out.column("place").to_pylist() == [p for _, p in want] and out.column("name").to_pylist() == [x[2] for x, _ in want]


def test_pairs_of_names_that_cannot_be_the_same_place_are_not_scored(monkeypatch):
    names = [f"{a}{b}" for a in ("Holt", "Nes", "Vík", "Dalur í Mýrum") for b in ("", "i", "a")]
    want, calls, lcs = resolve.fold_names(names), [], resolve.lcs_length
    monkeypatch.setattr(resolve, "lcs_length", lambda a, b: calls.append((a, b)) or lcs(a, b))
    assert resolve._Folder(resolve.SAME_PLACE)(np.repeat(np.arange(50), 12), pa.array(names * 50)).tolist() == want * 50
    assert len(calls) == len(set(calls)) < 12


def test_classify_pairs(spark):
    people = [(1, "Þórunn Jónsdóttir", "", 1300, None), (2, "Jórunn Jónsdóttir", "", 1310, None), (3, "Jón", "", None, None), (4, "Jón Holt", "", 1300, 1300),
              (5, "Jón Holt", "", 1600, 1600), (6, "zzz", "Jon Holt", None, None)]
    df = spark.createDataFrame(people, "pk long, canonical_name string, variant_names string, floruit_start int, floruit_end int")
    got = {(r.a, r.b): (r.classification, r.confidence, r.date_status) for r in duplicates.classify_pairs(df).collect()}
    assert got[1, 2][0] == "likely_duplicate" and got[4, 5] == ("name_match_date_conflict", "medium", "conflict")
    assert got[3, 4] == ("possible_duplicate_bare_name", "low", "unknown") and (4, 6) in got and (1, 3) not in got
    ordered = [r.classification for r in duplicates.by_priority(duplicates.classify_pairs(df)).collect()]
    assert ordered == sorted(ordered, key=duplicates.ORDER.index)


def test_upsert_and_status(spark):
    stored = spark.createDataFrame([(1, 2, 80, "different"), (3, 4, 80, "")], "a long, b long, name_score int, decision string")
    fresh = spark.createDataFrame([(2, 1, 95), (4, 3, 95), (6, 5, 90), (7, 7, 99)], "a long, b long, name_score int")
    got = {(r.a, r.b): (r.name_score, r.decision) for r in duplicates.upsert_pairs(stored, fresh).collect()}
    assert got == {(1, 2): (80, "different"), (3, 4): (95, ""), (5, 6): (90, "")}
    pairs = spark.createDataFrame([(1, 1, 2, "different"), (2, 2, 3, "same"), (3, 3, 1, "")], "candidate_pk long, a long, b long, decision string")
    people = spark.createDataFrame([(i, "provisional", "add", 1) for i in (1, 2, 3, 4)], "pk long, status string, review_status string, source_volume int")
    status = duplicates.duplicate_status(people, pairs)
    assert {r.pk: (r.duplicate_status, r.other_pk) for r in status.collect()} == {1: ("warning", 2), 2: ("blocked", 3), 3: ("blocked", 2), 4: ("none", None)}
    strict = duplicates.duplicate_status(people, pairs, ignore_different=True)
    assert {r.pk: r.other_pk for r in strict.collect()}[1] == 3
    assert {r.pk: r.status for r in duplicates.promote(people, status).collect()} == {1: "canonical", 2: "provisional", 3: "provisional", 4: "canonical"}
    places = spark.createDataFrame([(5, 1, "different"), (4, 2, ""), (9, 2, "same")], "candidate_pk long, pk long, decision string")
    assert {r.pk: (r.duplicate_status, r.candidate_pk) for r in duplicates.place_status(people.where("pk < 3"), places).collect()} == {1: ("none", None), 2: ("warning", 4)}


def test_merge_and_relink(spark):
    rows = [(3, "Jón", "Jon;JÓN", "a;b", "s1", "", "", " ", "", "", "Q1", 1310, 1320, 1, ""), (7, "John", "jon", "B;c", "s2", "x", "son", "smith", "", "m", "", 1300, None, 2, "4"),
            (9, "Johan", "", "", "", "", "other", "", "", "", "", None, 1400, 1, "1;5"), (20, "Alone", "v", "", "", "", "", "", "", "", "", None, None, 3, "")]
    cols = "pk long, canonical_name string, variant_names string, notes string, sources string, associated_places string, patronymic string, occupation string, title string, gender string, wikidata_id string, floruit_start int, floruit_end int, source_volume int, merged_volumes string"
    df = spark.createDataFrame(rows, cols)
    mapping = merge.survivors(spark.createDataFrame([(1, 9), (1, 3), (1, 7)], "grp int, pk long"))
    out = {r.pk: r for r in merge.merge_rows(df, mapping).collect()}
    m = out[3]
    assert set(out) == {3, 20} and m.variant_names == "Jon;John;Johan" and m.notes == "a;b;c" and m.sources == "s1;s2"
    assert (m.patronymic, m.occupation, m.wikidata_id, m.gender) == ("son", "smith", "Q1", "m")
    assert (m.floruit_start, m.floruit_end, m.source_volume, m.merged_volumes) == (1300, 1400, 1, "4;5;2")
    links = spark.createDataFrame([(1, 7), (2, 20), (3, None)], "link_id long, pk long")
    assert {r.link_id: r.pk for r in merge.relink(links, mapping, "pk").collect()} == {1: 3, 2: 20, 3: None}
    pairs = spark.createDataFrame([(1, 3, 7, ""), (2, 9, 20, ""), (3, 7, 20, "different")], "candidate_pk long, a long, b long, decision string")
    assert [(r.a, r.b, r.candidate_pk) for r in merge.relink_pairs(pairs, mapping).collect()] == [(3, 20, 3)]
    texts = spark.createDataFrame([(1, "a [7] b [20] [9]"), (2, None)], "k int, t string")
    assert {r.k: r.t for r in merge.rewrite_tokens(texts, mapping, "t", "k").collect()}[1] == "a [3] b [20] [3]"
    again = merge.merge_rows(merge.merge_rows(df, mapping), mapping.limit(0))
    assert {r.pk: r.notes for r in again.collect()} == {r.pk: r.notes for r in out.values()}


def test_geo(spark):
    r = random.Random(2)
    pts = [(i, r.uniform(-89, 89), r.uniform(-180, 180)) for i in range(150)] + [(200, 10.0, 179.99), (201, 10.0, -179.99), (202, 89.95, 10.0), (203, 89.95, -170.0)]
    a = spark.createDataFrame(pts, "mention long, lat double, lng double")
    b = a.toDF("cand", "c_lat", "c_lng")
    import math

    def km(p, q):
        x, y = math.radians(p[1]), math.radians(q[1])
        h = math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2
        return EARTH_KM * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    for radius in (15, 900):
        want = {(p[0], q[0]) for p in pts for q in pts if km(p, q) <= radius}
        rows = [(x.mention, x.cand) for x in geomatch.near(a, b, radius).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want
    flags = spark.createDataFrame([(4.0, 70.0), (4.0, 10.0), (30.0, 90.0), (10.0, 99.0), (None, 99.0)], "k double, s double")
    assert [x[0] for x in flags.select(geomatch.flag(F.col("k"), F.col("s"))).collect()] == ["geo_confirmed", "geo_only", "geo_conflict", "", ""]


def test_pools_and_geocode(spark):
    places = spark.createDataFrame([(1, "Árnes"), (2, "Rang"), (3, "Rang")], "cand long, block string")
    cross = spark.createDataFrame([("Rv.", "Rang"), ("Rv.", "Árnes")], "abbr string, name string")
    m = spark.createDataFrame([(1, "rv"), (2, "Árnes"), (3, "??"), (4, None)], "mention long, district string")
    got = {}
    for x in geomatch.pools(m, places, cross).collect():
        got.setdefault(x.mention, set()).add(x.cand)
    assert got == {1: {1, 2, 3}, 2: {1}, 3: {1, 2, 3}, 4: {1, 2, 3}}
    own = spark.createDataFrame([(1, "Nes", "", None, None, None), (2, "zzzz", "", None, None, None), (3, "Nes", "Q9", 1.0, 2.0, 5)], "pk long, name string, wikidata_id string, lat double, lng double, geo_score int")
    gaz = spark.createDataFrame([("Q1", "nes", 64.0, -20.0)], "qid string, all_labels string, g_lat double, g_lng double")
    out = {r.pk: (r.wikidata_id, r.lat, r.geo_score) for r in geomatch.geocode(own, gaz).collect()}
    assert out == {1: ("Q1", 64.0, 100), 2: ("Q1", None, 0), 3: ("Q9", 1.0, 5)}
    v = geomatch.valley_candidates(spark.createDataFrame([("Laxárdalur",)], "valley string"), spark.createDataFrame([("Laxárdals",), ("Nes",)], "district string"))
    assert [(r.valley, r.district) for r in v.collect()] == [("Laxárdalur", "Laxárdals")]


def test_reconcile(spark):
    a = spark.createDataFrame([("f", 1, "x"), ("f", 2, "y"), ("g", 1, "z")], "k string, o int, v string")
    b = spark.createDataFrame([("f", 9, "p")], "k string, q int, w string")
    got = {(r.k, r.occurrence): r.w for r in reconcile.positional_join(a, b, ["k"], ["o"], ["q"]).collect()}
    assert got == {("f", 0): "p", ("f", 1): None, ("g", 0): None}
    assert reconcile.join_failures(a, b, ["k"], ["o"], ["q"]).count() == 2
    x = spark.createDataFrame([(1, "n", "", "r1"), (2, "m", "t", "r2")], "key long, name string, note string, region string")
    y = spark.createDataFrame([(1, "other", "u", ""), (2, "m2", "", "r3"), (3, "k", "", "")], "key long, name string, note string, region string")
    merged, conflicts = reconcile.reconcile_stores(x, y, "key", ["name"], ["note"], ["region"])
    assert {r.key: (r.found_in, r.name, r.note, r.region) for r in merged.collect()} == {1: ("both", "n", "u", "r1"), 3: ("b", "k", None, None)} or merged.count() == 2
    assert [r.key for r in conflicts.collect()] == [2]
    keyed = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "a"), ("j", 2, "a")], "key string, pos int, name string")
    assert {r.key: r.pos for r in reconcile.pick_ambiguous(keyed, F.col("name") == "b", "pos").collect()} == {"k": 2, "j": 1}
    rows = spark.createDataFrame([("n", "", 1.0), ("m", "Q2", None)], "name string, qid string, lat double")
    found = spark.createDataFrame([("n", "Q1", 5.0, 60), ("n", "Q3", 6.0, 90), ("m", "Q4", 7.0, 99)], "name string, qid string, lat double, score int")
    assert {r.name: (r.qid, r.lat) for r in reconcile.fill_by_name(rows, found, ["qid", "lat"]).collect()} == {"n": ("Q3", 1.0), "m": ("Q2", 7.0)}
    counts = reconcile.counts_agree(spark.createDataFrame([("f",), ("f",), ("g",)], "file string"), spark.createDataFrame([("f", False), ("f", True)], "file string, skipped boolean"), "file")
    assert {r.file: r.agree for r in counts.collect()} == {"f": True, "g": False}


def test_review(spark):
    items = spark.createDataFrame(
        [(1, 11, 1, "a", 5, "", "open"), (2, 12, 1, "b", 6, "", "open"), (3, 13, 2, "c", 7, "", "open"), (4, 14, 2, "d", 8, "", "resolved")],
        "item_id long, link_id long, volume int, name string, match_pk long, decision string, status string",
    )
    links = spark.createDataFrame([(i, None, "pending_review") for i in (11, 12, 13, 14)], "link_id long, pk long, resolution_state string")
    decided = review.record_decisions(items, spark.createDataFrame([(1, "accept"), (2, "reject"), (3, "reject"), (4, "accept")], "item_id long, decision string"))
    closed, moved, minted = review.apply_decisions(decided, links, 100)
    assert {r.item_id: (r.status, r.outcome_pk) for r in closed.collect()} == {1: ("resolved", 5), 2: ("resolved", 100), 3: ("resolved", 101), 4: ("resolved", None)}
    assert {r.link_id: (r.pk, r.resolution_state) for r in moved.collect()} == {11: (5, "resolved"), 12: (100, "resolved"), 13: (101, "resolved"), 14: (None, "pending_review")}
    assert {r.legacy_id for r in minted.collect()} == {"REJECTED-2", "REJECTED-3"}
    people = spark.createDataFrame([(1, "d1", "provisional", "", 3), (2, "d2", "canonical", "", 3)], "pk long, display_id string, status string, review_status string, source_volume int")
    pairs = spark.createDataFrame([(1, 1, 2, "different")], "candidate_pk long, a long, b long, decision string")
    assert {r.pk: r.review_status for r in review.send_to_final_review(people, pairs).collect()} == {1: "add", 2: ""}
    acts = spark.createDataFrame([(1, "ok", 1), (1, "skip", 2), (2, "bogus", 3)], "pk long, action string, at int")
    assert {r.pk: r.review_status for r in review.apply_actions(people, acts).collect()} == {1: "skip", 2: ""}
    assert {r.check: r.n for r in review.integrity(people, moved.select("link_id", "pk"), pairs).collect()}["broken_links"] == 3
    left = review.purge(3, spark.createDataFrame([(1, 3), (2, 4)], "doc long, volume int"), {"links": spark.createDataFrame([(1,), (2,)], "doc long")}, people, pairs)
    assert {k: v.count() for k, v in left.items()} == {"documents": 1, "links": 1, "entities": 1, "pairs": 0}
    changed = review.changed_rows(people, review.apply_actions(people, acts), "pk", ["status", "review_status"]).collect()
    assert [(r.pk, r.changes) for r in changed] == [(1, {"review_status": "skip"})]
    cands = spark.createDataFrame([(1, 1, "L5", ""), (2, 1, "L6", "")], "candidate_pk long, pk long, external_id string, decision string")
    places = spark.createDataFrame([(1, ""), (2, "L1")], "pk long, external_id string")
    _, filled = review.decide_place_pairs(cands, places, spark.createDataFrame([(2, "same")], "candidate_pk long, decision string"))
    assert {r.pk: r.external_id for r in filled.collect()} == {1: "L6", 2: "L1"}
    queue = review.queue_index({"person_review": items.withColumn("score", F.col("match_pk").cast("double"))})
    assert [r.item_id for r in review.page(review.filter_queue(queue, "a", [1]), "score_desc", 0, 5).collect()] == [2, 1] or queue.count() == 4


def test_export(spark):
    rows = spark.createDataFrame([("l1", "Nes", "nes; Nesi;Nesi"), ("", "x", ""), ("l2", " ", "")], "i string, n string, v string")
    assert [tuple(r) for r in export.seed_rows(rows, "i", "n", "v").collect()] == [("l1", "Nes", "Nesi")]
    people = spark.createDataFrame([(1, "canonical", "Q1"), (2, "provisional", ""), (3, "canonical", None)], "pk long, status string, wikidata_id string")
    assert [tuple(r) for r in export.authority_rows(people, ["pk"]).orderBy("pk").collect()] == [(1, "https://www.wikidata.org/wiki/Q1"), (3, "")]
    tags = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "b", "z"), (4, "c", "w")], "o int, t string, e string")
    assert [(r.t, r.n, r.first_example) for r in export.frequency(tags, "t", "e", "o").collect()] == [("b", 2, "y"), ("a", 1, "x"), ("c", 1, "w")]
