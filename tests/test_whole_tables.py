"""Every row of the tables is on a side of the joins of stores, pairs and references."""

from __future__ import annotations

from oracle import SF

from textloom.catalogue import QUERIES
from textloom.plans import adapters as A


def keys(spark, table, key):
    return {r[0] for r in A.table(spark, SF, table).select(key).collect()}


def test_stores_have_every_row(spark):
    s, c = keys(spark, "supplier", "s_suppkey"), {k + 3 for k in keys(spark, "customer", "c_custkey")}
    got = {r.key: r.found_in for r in QUERIES["q_reconcile_full_outer"](spark, SF).collect()}
    conflicts = {k for k in s & c if k % 10 == 1}
    assert set(got) == (s | c) - conflicts
    assert set(got.values()) == {"a", "b", "both"}


def test_pairs_have_every_row(spark):
    stored = {(r.a, r.b) for r in A.pairs(spark, SF).collect()}
    fresh = {(k, k + 1 + k % 3) for k in keys(spark, "customer", "c_custkey")}
    got = {(r.a, r.b) for r in QUERIES["q_upsert_pairs"](spark, SF).collect()}
    assert got == stored | fresh and stored - fresh and fresh - stored and stored & fresh


def test_references_look_at_every_row(spark):
    c, s = keys(spark, "customer", "c_custkey"), keys(spark, "supplier", "s_suppkey")
    want = {}
    for ref in s:
        p = ref + 4 if ref + 4 in c and (ref + 4) % 8 == ref % 4 else None
        k = ref if ref in c and ref % 3 else None
        want[ref] = (k or p) if ref % 2 == 0 else (p or k)
    got = {r.ref: r.pk for r in QUERIES["q_resolve_references"](spark, SF).collect()}
    assert got == want and {x % 3 for x in got.values() if x} == {0, 1, 2}
