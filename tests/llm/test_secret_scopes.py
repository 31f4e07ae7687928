"""The query links the parts of a credential anywhere in their block."""

from __future__ import annotations

from textloom.llm import queries


def test_long_blocks_are_linked_whole(spark, docs, tmp_path):
    far = "client_id=app7\n" + "filler line\n" * 200 + "password=hunter22"
    rows = [(1, far), (2, far.replace("password", "\npassword")), (3, "user=bob\npassword=hunter22")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_linked for r in queries.op4_secret_scan(spark, str(tmp_path)).collect()}
    assert got == {1: 2, 2: 0, 3: 2}
