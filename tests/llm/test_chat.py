from __future__ import annotations

import pytest
from oracle import assert_same
from pyspark.sql import types as T

from textloom.llm import chat
from textloom.llm.queries import QUERIES, SQL

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
ROWS = [
    (1, 0, "user", "How do I sort a list?\nI tried a loop."),
    (1, 1, "assistant", "Use sorted().\n\nIt returns a new list."),
    (1, 2, "user", "> How do I   SORT a list?\n> I tried a loop.\n\nDescending, I mean."),
    (1, 3, "assistant", "> > How do I sort a list?\n> Descending, I mean.\n\nPass reverse=True.\n"),
    (1, 4, "user", ">It returns a new list.\nAnd in place?"),
    (1, 5, "assistant", "> never said by anyone\nplain"),
    (1, 6, "user", ">> Pass reverse=True.\n> And in place?\nBoth, please"),
    (2, 0, "user", "> How do I sort a list?\nother conversation"),
    (2, 1, None, None),
    (2, 1, None, None),
    (2, 2, "user", ""),
    (2, 2, "system", ">\n> \n"),
    (3, 5, "user", "ok"), (3, 6, "user", "ok"), (3, 7, "user", "> ok"), (3, 8, "user", "> ok\n> ok"), (3, 9, "user", "ok"), (3, 10, "user", "> ok"),
    (None, 1, "user", "> ok"), (4, None, "user", "x"),
]


@pytest.fixture
def messages(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as conv", "'x' as hash", "'y' as level", "0 as part")


def test_links_and_order(messages):
    got = {(r.conv, r.turn): r for r in chat.in_reply_order(messages(ROWS)).collect()}
    assert [got[1, t].reply_to for t in range(7)] == [None, None, 0, 2, 1, None, 4]
    order = sorted((r for (c, _), r in got.items() if c == 1), key=lambda r: r.position)
    assert [r.turn for r in order] == [0, 2, 3, 1, 4, 6, 5]
    assert [r.position for r in order] == list(range(7))
    for r in order:
        assert r.reply_to is None or got[1, r.reply_to].position < r.position
    assert got[1, 2].text == "Descending, I mean." and got[1, 3].text == "Pass reverse=True."
    assert got[1, 3].chat == "<|im_start|>assistant\nPass reverse=True.<|im_end|>"
    assert got[2, 0].reply_to is None and got[2, 1].chat == "<|im_start|>unknown\n<|im_end|>"
    assert [got[3, t].reply_to for t in (7, 8, 10)] == [6, 6, 9]


def test_same_as_sql(spark, messages, tmp_path):
    rows = [r for r in ROWS if r[0] is not None and r[1] is not None]
    deep = [(9, t, "user", f"line {t}" if not t else f"> line {t - 1}\nline {t}") for t in range(40)]
    for name in ("documents", "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "pages", "benchmark", "labels"):
        spark.range(1).write.parquet(f"{tmp_path}/{name}.parquet.d")
    spark.createDataFrame(rows + deep, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/c")
    import duckdb

    part = next((tmp_path / "c").glob("part-*.parquet"))
    (tmp_path / "conversations.parquet").symlink_to(part)
    for name in ("documents", "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "pages", "benchmark", "labels"):
        duckdb.sql("select 1 as x").write_parquet(str(tmp_path / f"{name}.parquet"))
    assert_same(spark, QUERIES["op3_quotation_linking"], SQL["op3_quotation_linking"], str(tmp_path))


def test_empty_table(messages):
    assert chat.in_reply_order(messages([])).count() == 0


def test_the_query_links_many_messages(spark):
    from oracle import SF

    from textloom.llm import queries

    rows = queries.op3_quotation_linking(spark, SF).collect()
    linked = [r for r in rows if r.n_linked]
    assert len(linked) > len(rows) / 4
    assert all(0 <= r.thread <= r.reply_to < r.turn for r in linked)


def test_very_long_messages(spark):
    long = "\n".join(f"line {i} {'x' * (i % 50)}" for i in range(20_000))
    rows = [(1, 0, "user", long), (1, 1, "bot", "> " + long.split("\n")[777] + "\nyes")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat.in_reply_order(table).collect()}
    assert got[1].reply_to == 0 and got[1].text == "yes" and got[0].text == long
