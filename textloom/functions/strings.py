"""String and list functions as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

PAREN_TAIL = r"\s*\([^)]*\)\s*$"


def strip(c: Column) -> Column:
    """Unicode white space off both ends (``trim`` takes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def without_paren_tail(c: Column) -> Column:
    return F.regexp_replace(c, PAREN_TAIL, "")


def split_plain(c: Column) -> Column:
    """``;``-list without regard to parentheses; items trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(or_empty(c), ";"), strip), lambda x: x != "")


def split_variants(c: Column) -> Column:
    """``;``-list where a ``;`` inside parentheses does not separate. A stray ``)`` is ignored, an
    open ``(`` holds the rest together."""
    start = F.struct(
        F.lit(0).alias("depth"), F.lit("").alias("item"), F.array().cast("array<string>").alias("items")
    )

    def step(state: Column, ch: Column) -> Column:
        depth = F.when(ch == "(", state["depth"] + 1).when(ch == ")", F.greatest(F.lit(0), state["depth"] - 1))
        ends = (ch == ";") & (state["depth"] == 0)
        return F.struct(
            depth.otherwise(state["depth"]).alias("depth"),
            F.when(ends, F.lit("")).otherwise(F.concat(state["item"], ch)).alias("item"),
            F.when(ends, F.concat(state["items"], F.array(state["item"]))).otherwise(state["items"]).alias("items"),
        )

    chars = F.filter(F.split(or_empty(c), ""), lambda x: x != "")
    items = F.aggregate(chars, start, step, lambda s: F.concat(s["items"], F.array(s["item"])))
    return F.filter(F.transform(items, strip), lambda x: x != "")


def name_forms(canonical: Column, variants: Column) -> Column:
    """All forms of a name in lower case: each as it is and without a parenthesis at its end, in
    order, without repetitions."""

    def forms(c: Column) -> Column:
        bare = F.lower(F.regexp_replace(F.regexp_replace(strip(or_empty(c)), '^"+|"+$', ""), "^'+|'+$", ""))
        return F.filter(F.array(bare, strip(without_paren_tail(bare))), lambda x: x != "")

    each = F.concat(F.array(or_empty(canonical)), split_variants(variants))
    return F.array_distinct(F.flatten(F.transform(each, forms)))


def normalise_name(c: Column) -> Column:
    """For comparing persons: parenthesis off, lower case, white space as one space, then without
    ``. , ; :`` (so that two spaces may be left)."""
    text = F.lower(strip(without_paren_tail(or_empty(c))))
    return F.translate(F.regexp_replace(text, r"(?U)\s+", " "), ".,;:", "")


def _folding() -> tuple[str, str]:
    """Latin letters that decompose into an ASCII letter and marks, and those letters."""
    pairs = []
    for code in range(0xC0, 0x250):
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(plain) == 1 and plain.isascii():
            pairs.append((chr(code), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_accents(c: Column) -> Column:
    marked, plain = _folding()
    return F.regexp_replace(F.translate(c, marked, plain), r"\p{Mn}+", "")


def normalise_place(c: Column, fold: bool = True) -> Column:
    name = normalise_name(c)
    return fold_accents(name) if fold else name


def leading_year(c: Column) -> Column:
    """A date text's first three or four digits as a number."""
    return F.expr("cast(null as int)") if c is None else F.regexp_extract(strip(c), r"^(\d{3,4})", 1).try_cast("int")


def int_or_null(c: Column) -> Column:
    return strip(c).try_cast("long")


def float_or_null(c: Column) -> Column:
    return F.when(strip(c).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), strip(c).try_cast("double"))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.substring(F.regexp_replace(c, r"[^\p{L}\p{N}]", "_"), 1, 40), "^_+|_+$", "")


def valley_stem(c: Column) -> Column:
    return F.regexp_replace(fold_accents(F.lower(strip(c))), "(ur|s)$", "")


def floruit_text(start: Column, end: Column) -> Column:
    joined = F.concat(or_empty(start.cast("string")), F.lit("-"), or_empty(end.cast("string")))
    return F.regexp_replace(joined, "^-+|-+$", "")


def without_fence(c: Column) -> Column:
    """A reply's text without the Markdown fence around it."""
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"^```[A-Za-z]*\s*", ""), r"\s*```$", ""))


def replace_token(c: Column, old: Column, new: Column) -> Column:
    """``[old]`` becomes ``[new]``."""
    return F.replace(c, F.concat(F.lit("["), old, F.lit("]")), F.concat(F.lit("["), new, F.lit("]")))


def contains_in(needle: str, *columns: str) -> Column:
    """Whether the columns, joined by spaces (null as empty), contain the text, whatever the case."""
    joined = F.concat_ws(" ", *[or_empty(F.col(x).cast("string")) for x in columns])
    return F.contains(F.lower(joined), F.lit(needle.lower()))


# Fixed value: a line that is a date, as the simplest headers of documents are.
SIMPLE_HEADER = r"^\s*(\d{1,2}\.\s+\w+\s+\d{3,4}|\d{3,4}\.\s+\w+\s+\d{1,2}|\d{3,4})\.\s*$"


def has_simple_header(c: Column) -> Column:
    """Whether any line of a text is one."""
    return c.rlike("(?Um)" + SIMPLE_HEADER)
