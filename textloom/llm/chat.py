r"""Chat formatting by quotation linking.

A message's lines are read with their quote level (the number of ``>`` before them). Consecutive
lines of one level without a blank line are a passage. Passages, and their single lines, are
normalised (levels off, white space runs as one space, lower case) and hashed; a quoted passage
is linked to the latest earlier message of its conversation whose own, unquoted, text has it. A
message answers the message that its outermost linked quotation comes from (the latest, if several).

Conversations are put in reply order: each message follows the message that it answers. A message
that answers none stands at its own turn; one that answers stands in the thread that its chain of
answers leads to, by turn. The text that is left has no quoted lines.

Only DataFrame operations. Links are an as-of join in slices of turns; chains are followed by
pointer doubling; positions are counted in a range partitioning, so a conversation that holds a
third of all rows is spread over many tasks.

Defined results: null texts are empty, null roles are written as "unknown"; rows with a null
conversation or turn form conversations of their own kind (null is a value) but link nothing;
rows that repeat in full are one message; different messages of one turn keep their order by role
and text, and share what the turn answers; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.llm.asof import latest_before
from textloom.llm.shared import ensure_columns, written

TURN_SLICE = 256
QUOTE = r"^(?:[ \t]*>)*"


def _normal(body: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(body, r"[ \t\r]+", " ")))


def own_text(text: Column) -> Column:
    """The unquoted lines, without blank lines at either end."""
    lines = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(r"^[ \t]*>"))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^(?:[ \t\r]*\n)+|(?:\n[ \t\r]*)+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """``messages``: conv, turn, msg, text. A row per passage and per line of it: conv, turn, msg,
    level, hash."""
    lines = messages.select("conv", "turn", "msg", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    prefix = F.regexp_extract("line", QUOTE, 0)
    lines = lines.select(
        "conv",
        "turn",
        "msg",
        "n",
        (F.length(prefix) - F.length(F.replace(prefix, F.lit(">"), F.lit("")))).alias("level"),
        _normal(F.expr(f"substring(line, length(regexp_extract(line, r'{QUOTE}', 0)) + 1)")).alias("body"),
    )
    own = W.partitionBy("conv", "turn", "msg").orderBy("n")
    before = F.lag(F.struct("level", (F.col("body") == "").alias("blank"))).over(own)
    opens = before.isNull() | (before["level"] != F.col("level")) | before["blank"]
    filled = lines.withColumn("opens", opens.cast("int")).withColumn("passage", F.sum("opens").over(own)).where("body <> ''")
    whole = filled.groupBy("conv", "turn", "msg", "level", "passage").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "body"))), lambda x: x["body"]), " ").alias("body")
    )
    both = whole.drop("passage").unionByName(filled.select("conv", "turn", "msg", "level", "body"))
    return both.select("conv", "turn", "msg", "level", F.md5("body").alias("hash"))


def reply_links(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``units`` (see ``passages``): quoted units with the turn they come from, and a row per
    answering turn: conv, turn, reply_to."""
    units = units.where("conv is not null and turn is not null")
    quoted = units.where("level > 0").select("conv", "hash", "turn", "level").distinct()
    wanted = quoted.select("conv", "hash").distinct()
    own = units.where("level = 0").select("conv", "hash", "turn").distinct().join(wanted, ["conv", "hash"], "left_semi")
    events = quoted.withColumn("origin", F.lit(None).cast("long")).unionByName(
        own.withColumn("origin", F.col("turn")).withColumn("level", F.lit(0))
    )
    offered = F.when(F.col("origin").isNotNull(), F.struct("origin"))
    linked = latest_before(events, ["conv", "hash"], "turn", offered, TURN_SLICE).where("level > 0")
    linked = written(linked.select("conv", "turn", "level", "hash", F.col("found.origin").alias("origin")), "linked")
    first = F.max(F.struct((-F.col("level")).alias("outer"), "origin"))
    replies = linked.where("origin is not null").groupBy("conv", "turn").agg(first.alias("best"))
    return linked, written(replies.select("conv", "turn", F.col("best.origin").alias("reply_to")), "replies")


def threads(replies: DataFrame) -> DataFrame:
    """The turn that each chain of answers leads to: conv, turn, thread. Pointers double in rounds,
    and only those that have not reached the end of their chain take part in the next one."""
    moving = replies.select("conv", "turn", F.col("reply_to").alias("thread"))
    there = moving.where("false")
    while True:
        above = moving.unionAll(there).select("conv", F.col("turn").alias("thread"), F.col("thread").alias("upper"))
        jumped = moving.join(above, ["conv", "thread"], "left")
        jumped = written(
            jumped.select("conv", "turn", F.coalesce("upper", "thread").alias("thread"), F.col("upper").isNotNull().alias("moved")),
            "threads",
        )
        there = there.unionAll(jumped.where("not moved").drop("moved"))
        moving = jumped.where("moved").drop("moved")
        if not moving.limit(1).count():
            return there


def in_reply_order(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """A row per message: conv, turn, role, reply_to, thread, position (from 0 in its
    conversation), n_quoted and n_linked (distinct quoted units), text (its own), chat (formatted)."""
    ensure_columns(messages, conv_col, turn_col, role_col, text_col)
    rows = messages.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("msg", F.md5(F.concat_ws("\n", "role", "text"))).dropDuplicates(["conv", "turn", "msg"])
    rows = written(rows, "messages")
    quoting = rows.where(F.col("text").rlike(r"(?:^|\n)[ \t]*>")).select("conv").distinct()
    asked = rows.join(quoting, "conv", "left_semi")  # the others have nothing to link
    linked, replies = reply_links(written(passages(asked), "units"))
    chains = threads(replies)
    counted = linked.groupBy("conv", "turn").agg(
        F.count(F.lit(1)).alias("n_quoted"), F.count("origin").alias("n_linked")
    )
    facts = counted.join(replies, ["conv", "turn"], "left").join(chains, ["conv", "turn"], "left")
    facts = facts.select(F.col("conv").alias("__conv"), F.col("turn").alias("__turn"), "reply_to", "thread", "n_quoted", "n_linked")
    placed = rows.join(facts, (F.col("conv") == F.col("__conv")) & (F.col("turn") == F.col("__turn")), "left")
    placed = placed.select(
        "conv", "turn", "role", "msg", "reply_to", F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        own_text(F.col("text")).alias("text"),
    )

    order = ["conv", "thread", "turn", "role", "msg"]
    parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    ranged = written(ranged, "ranged")
    heads = ranged.groupBy("conv", "part").agg(F.min("at").alias("head"), F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    heads = heads.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    heads = heads.select(F.col("conv").alias("__conv"), F.col("part").alias("__part"), "head", "base")
    numbered = ranged.join(heads, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("part") == F.col("__part")))
    chat = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>"))
    return numbered.select(
        "conv", "turn", "role", "reply_to", "thread",
        (F.col("base") + F.col("at") - F.col("head")).alias("position"),
        "n_quoted", "n_linked", "text", chat.alias("chat"),
    )
