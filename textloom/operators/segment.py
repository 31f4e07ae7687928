r"""Cutting paged text into documents: tag each line, then assemble what opens a document and
what belongs to it. Order is always explicit: ``pos`` numbers a volume's lines."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.strings import strip

# The shapes of date lines that open a document.
YEAR = r"(?:8[3-9]\d|9\d\d|1[0-5]\d\d)"
MONTH = r"[A-Za-zÀ-öø-ÿÞþÐðÆæÖö]{3,}"
SEQ = r"(?:\d{1,4}\.\s+)?"
TRAIL = r"(?:\s+(?:í|á|at|að|undir|fyrir)\s+\S.{0,25})?"
OPENERS = (
    rf"^\s*\d{{1,3}}\.\s{{2,}}{MONTH}\.?\s+{YEAR}\.?\s*$",
    rf"^\s*{YEAR}[.,]\s+{MONTH}\.?\s+\d{{1,2}}\.?\s*$",
    rf"^\s*{YEAR}\.\s*$",
    rf"^\s*{SEQ}\d{{1,2}}\.\s+{MONTH}\.?\s+{YEAR}\.{TRAIL}\s*$",
    rf"^\s*{SEQ}\[{YEAR}\]\.?{TRAIL}\s*$",
    rf"(?i)^\s*{SEQ}\[um\s+{YEAR}(?:[—–-]{YEAR})?\]\.?{TRAIL}\s*$",
    rf"^\s*{SEQ}\[{MONTH}\s+{YEAR}\.?\]\.?{TRAIL}\s*$",
    rf"(?i)^\s*{SEQ}\[eptir\s+{YEAR}\]\.?{TRAIL}\s*$",
    rf"^\s*{SEQ}\[[^\]]*{YEAR}[^\]]*\]\s*\[[^\]]+\]\.?{TRAIL}\s*$",
)
YEAR_RANGE = rf"^\s*{YEAR}[—–-]{YEAR}\.?\s*$"
FOOTNOTE = r"^\s*\d+\)\s"
DOT_LEADER = r"\.\s?\.\s?\."
CANDIDATES = (r"(?i)^[IVXLCDM]{1,8}\.\s", r"^\d{1,4}\.\s", r"^\[")
CANDIDATE_LENGTH = 90


def _any(c: Column, patterns) -> Column:
    found = F.lit(False)
    for p in patterns:
        found = found | c.rlike("(?U)" + p)
    return found


def pages_of(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """A row per page (pages end with a form feed), numbered from 1."""
    others = [c for c in texts.columns if c != text_col]
    return texts.select(*others, F.posexplode(F.split(text_col, "\f")).alias("n", "text")).select(
        *others, (F.col("n") + 1).alias("page_no"), "text"
    )


#: Lines of a volume that one task orders. What runs through a volume is summed up per slice, and
#: only these sums, a row for each slice, are ordered for the whole volume.
SLICE = 4096


def _over_earlier(rows: DataFrame, keys: tuple[str, ...], part: str, **totals: Column) -> DataFrame:
    """Adds ``totals``, aggregates of rows, over all earlier parts of the same keys: sums of longs
    (0 if there are none), or the latest struct. Keys may be null."""
    heads = rows.groupBy(*keys, part).agg(*[c.alias(f"__own_{name}") for name, c in totals.items()])
    before = W.partitionBy(*keys).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    of = {}
    for name in totals:
        own = F.col(f"__own_{name}")
        number = heads.schema[f"__own_{name}"].dataType.typeName() in ("long", "integer")
        of[name] = F.coalesce(F.sum(own).over(before), F.lit(0)) if number else F.last(own, ignorenulls=True).over(before)
    names = {c: f"__k{i}" for i, c in enumerate((*keys, part))}
    heads = heads.select(*[F.col(c).alias(n) for c, n in names.items()], *[c.alias(name) for name, c in of.items()])
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    return rows.join(heads, reduce(Column.__and__, same)).drop(*names.values())


def lines_of(pages: DataFrame) -> DataFrame:
    """``pages``: volume, page_no, text. A row per line: volume, page_no, pos, line."""
    cut = pages.select("volume", "page_no", F.split("text", "\r\n|\n|\r").alias("lines"))
    counted = _over_earlier(cut, ("volume",), "page_no", head=F.sum(F.size("lines")))
    lines = counted.select("volume", "page_no", "head", F.posexplode("lines").alias("n", "line"))
    # pages are told apart by their number; those that share one are ordered line by line
    inside = F.row_number().over(W.partitionBy("volume", "page_no").orderBy("n"))
    return lines.select("volume", "page_no", (F.col("head") + inside).cast("long").alias("pos"), "line")


def tag_lines(lines: DataFrame) -> DataFrame:
    """``lines``: volume, page_no, pos (and more), line. Adds ``tag``: blank, page_header,
    toc_entry, strict_open, footnote, candidate or body. A year range opens only after another
    opener of its volume; a candidate needs a blank line before it on its page."""
    text = strip(F.col("line"))
    on_page = W.partitionBy("volume", "page_no").orderBy("pos")
    rows = lines.withColumns({"__text": text, "__blank": text == ""})
    first = F.row_number().over(W.partitionBy("volume", "page_no", "__blank").orderBy("pos")) == 1
    rows = rows.withColumns({"__first": first & ~F.col("__blank"), "__after_blank": F.coalesce(F.lag("__blank").over(on_page), F.lit(False))})
    plain = ~F.col("__blank") & ~F.col("__first") & ~F.col("__text").rlike(DOT_LEADER)
    rows = rows.withColumn("__always", plain & _any(F.col("__text"), OPENERS))
    openers = rows.groupBy("volume").agg(F.min(F.when(F.col("__always"), F.col("pos"))).alias("__from"))
    openers = openers.select(F.col("volume").alias("__volume"), "__from")
    rows = rows.join(openers, F.col("volume").eqNullSafe(F.col("__volume")), "left")
    rows = rows.withColumn("__opened", F.coalesce(F.col("pos") > F.col("__from"), F.lit(False)))
    candidate = (
        F.col("__after_blank") & (F.length("__text") <= CANDIDATE_LENGTH) & _any(F.col("__text"), CANDIDATES)
    )
    tag = (
        F.when(F.col("__blank"), "blank")
        .when(F.col("__first"), "page_header")
        .when(F.col("__text").rlike(DOT_LEADER), "toc_entry")
        .when(F.col("__always") | (F.col("__opened") & F.col("__text").rlike("(?U)" + YEAR_RANGE)), "strict_open")
        .when(F.col("line").rlike("(?U)" + FOOTNOTE), "footnote")
        .when(candidate, "candidate")
        .otherwise("body")
    )
    return rows.withColumn("tag", tag).drop("__text", "__blank", "__first", "__after_blank", "__always", "__opened", "__volume", "__from")


def candidate_context(tagged: DataFrame, keep: int = 3, reach: int = 10) -> DataFrame:
    """For each candidate: the last ``keep`` texts of the ``reach`` events before it, the last
    ``keep`` of those after it, and the opener above it."""
    stripped = strip(F.col("line"))
    rows = tagged.select("volume", "pos", "line", "tag", stripped.alias("__text"), F.floor(F.col("pos") / SLICE).alias("__slice"))
    opener = F.when(F.col("tag") == "strict_open", F.struct("pos", "__text"))
    rows = _over_earlier(rows, ("volume",), "__slice", __n=F.count(F.lit(1)), __opener=F.max(opener))
    inside = W.partitionBy("volume", "__slice").orderBy("pos")
    rows = rows.withColumns({
        "__n": F.col("__n") + F.row_number().over(inside) - 1,
        "__above": F.coalesce(F.max(opener).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.col("__opener"))["__text"],
    })
    # the rows of a volume in slices of equal length, with the ``reach`` rows on either side
    first, last = F.floor((F.col("__n") - reach) / SLICE), F.floor((F.col("__n") + reach) / SLICE)
    rows = rows.withColumn("__home", F.floor(F.col("__n") / SLICE)).withColumn("__in", F.explode(F.sequence(first, last)))
    w = W.partitionBy("volume", "__in").orderBy("pos")
    text = F.when(F.col("tag").isin("body", "strict_open"), F.col("__text"))

    def near(frame) -> Column:
        found = F.collect_list(text).over(frame)
        return F.array_join(F.slice(found, F.greatest(F.size(found) - keep + 1, F.lit(1)), keep), " / ")

    around = rows.withColumns({"context_before": near(w.rowsBetween(-reach, -1)), "context_after": near(w.rowsBetween(1, reach))})
    return around.where("tag = 'candidate' and __in = __home").select(
        "volume", "pos", "line", "context_before", "context_after", F.coalesce("__above", F.lit("")).alias("container_header")
    )


def classify_candidates(contexts: DataFrame, classifier: Callable | None = None) -> DataFrame:
    """volume, pos, class, correction. ``classifier`` maps an iterator of pandas frames (in batches)
    to frames of these columns; without one every candidate is uncertain, and so are those of a batch
    for which it fails or that it leaves out."""
    if classifier is None:
        return contexts.select("volume", "pos", F.lit("uncertain").alias("class"), F.lit("").alias("correction"))
    kind = contexts.schema["volume"].dataType.simpleString()

    def guarded(frames):
        for frame in frames:
            try:
                found = [f for f in classifier(iter([frame]))]
            except Exception:  # a hook's failure is an answer: none of the batch is known
                found = []
            answers = {(v, p): (c, k) for f in found for v, p, c, k in f[["volume", "pos", "class", "correction"]].itertuples(index=False)}
            rows = frame[["volume", "pos"]].copy()
            of = [answers.get((v, p), ("uncertain", "")) for v, p in rows.itertuples(index=False)]
            rows["class"], rows["correction"] = [c for c, _ in of], [k for _, k in of]
            yield rows

    return contexts.mapInPandas(guarded, f"volume {kind}, pos long, class string, correction string")


def assemble(tagged: DataFrame, classes: DataFrame | None = None, opening: str = "new_document") -> DataFrame:
    """A row per document: volume, seq, page_start, date_header, text, n_lines. ``opening``: the
    classifier's word for a candidate that opens a document."""
    if classes is not None:
        tagged = tagged.join(classes.select("volume", "pos", "class"), ["volume", "pos"], "left")
    else:
        tagged = tagged.withColumn("class", F.lit(None).cast("string"))
    kind = F.coalesce("class", F.lit("uncertain"))
    opens = (F.col("tag") == "strict_open") | ((F.col("tag") == "candidate") & (kind == opening))
    kept = F.col("tag").isin("blank", "body", "strict_open") | ((F.col("tag") == "candidate") & (kind != "header_noise"))
    piece = (
        F.when(F.col("tag") == "blank", "\n")
        .when(F.col("tag") == "body", F.concat("line", F.lit("\n")))
        .otherwise(F.concat(strip(F.col("line")), F.lit("\n")))
    )
    rows = tagged.withColumns({"opens": opens.cast("int"), "piece": piece, "__slice": F.floor(F.col("pos") / SLICE)}).where(kept)
    rows = _over_earlier(rows, ("volume",), "__slice", __opened=F.sum("opens"))
    running = W.partitionBy("volume", "__slice").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("seq", F.col("__opened") + F.sum("opens").over(running)).where("seq > 0")
    parts = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    first = F.min_by(F.struct("page_no", strip(F.col("line")).alias("line")), "pos")
    return rows.groupBy("volume", "seq").agg(
        first["page_no"].alias("page_start"),
        first["line"].alias("date_header"),
        F.array_join(F.transform(parts, lambda x: x["piece"]), "").alias("text"),
        F.count(F.lit(1)).alias("n_lines"),
    )


def flagged(tagged: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidates for review: uncertain ones, and those with a suggested year."""
    return tagged.join(classes, ["volume", "pos"]).where("class = 'uncertain' or correction <> ''")


def length_outliers(segments: DataFrame, factor: int = 6, least: int = 3) -> DataFrame:
    """Documents longer than ``factor`` times their volume's upper median of lines; volumes with
    fewer than ``least`` documents have none."""
    rows = segments.where("volume is not null")
    # of each volume and length how many documents there are: lengths are few, whatever a volume has
    lengths = rows.groupBy("volume", "n_lines").agg(F.count(F.lit(1)).alias("n"))
    in_volume = W.partitionBy("volume")
    ordered = lengths.withColumns({
        "upto": F.sum("n").over(in_volume.orderBy("n_lines").rowsBetween(W.unboundedPreceding, 0)), "every": F.sum("n").over(in_volume),
    })
    reached = F.when(F.col("upto") >= F.floor(F.col("every") / 2) + 1, F.col("n_lines"))
    middle = ordered.where(F.col("every") >= least).groupBy("volume").agg(F.min(reached).alias("median"))
    return rows.join(middle, "volume").where(F.col("n_lines") > F.col("median") * factor)
