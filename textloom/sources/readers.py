"""Reading the pipeline's inputs: paged text, indexes, nested JSON, tolerant CSV, gazetteers, REST."""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from textloom.functions.strings import strip, without_fence

PERSON = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "role_category", "qualifier")])
LOCATION = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "role", "region")])
#: An extracted document. A reply that was no JSON, or a failed call, is marked in the row.
EXTRACTION = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("filename", "date", "scribe", "scribe_source", "di_reference", "doc_type", "subject", "outcome", "seal_info", "language", "date_header")]
    + [T.StructField(n, T.IntegerType()) for n in ("volume", "sequence", "page_start")]
    + [
        T.StructField("date_uncertain", T.BooleanType()),
        T.StructField("persons", T.ArrayType(PERSON)),
        T.StructField("locations", T.ArrayType(LOCATION)),
        T.StructField("all_places_mentioned", T.ArrayType(T.StringType())),
        T.StructField("_parse_error", T.StringType()),
        T.StructField("_raw_response", T.StringType()),
        T.StructField("_api_error", T.StringType()),
    ]
)


def read_paged_text(spark: SparkSession, path: str) -> DataFrame:
    """file, page_no, text: whole text files, cut at form feeds."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return files.select("file", F.posexplode(F.split("value", "\f")).alias("n", "text")).select("file", (F.col("n") + 1).alias("page_no"), "text")


def read_documents_as_text(spark: SparkSession, path: str, converter: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> DataFrame:
    """file, text: binary documents given to a converter (frames of path, content to file, text)."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(converter, "file string, text string")


def trailing_number(file: Column) -> Column:
    """The number at the end of a file's stem; files are ordered by it, not by their letters."""
    return F.regexp_extract(file, r"(\d+)\s*\.\w+$", 1).try_cast("int")


def list_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """file, number, in the order of the numbers."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"))
    return files.withColumn("number", trailing_number(F.col("file"))).orderBy("number", "file")


def discover_volumes(spark: SparkSession, path: str, pattern: str = r"vol(\d+)_\w+\.csv$") -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"))
    return files.select(F.regexp_extract("file", pattern, 1).try_cast("int").alias("volume")).where("volume is not null").distinct()


def read_extractions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXTRACTION).json(path, multiLine=True)


def parse_extractions(replies: DataFrame, col: str = "reply") -> DataFrame:
    """A model's replies as rows of EXTRACTION; what is no JSON is kept as an error."""
    parsed = F.from_json(without_fence(F.col(col)), _with_corrupt(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = replies.withColumn("doc", parsed)
    bad = F.col("doc._corrupt").isNotNull()
    rows = rows.withColumn("doc", F.col("doc").withField("_parse_error", F.when(bad, "not a JSON object")).withField("_raw_response", F.when(bad, F.col(col))))
    return rows.withColumn("doc", F.col("doc").dropFields("_corrupt"))


def _with_corrupt() -> T.StructType:
    return T.StructType([*EXTRACTION.fields, T.StructField("_corrupt", T.StringType())])


def is_error(doc: str = "doc") -> Column:
    return F.col(f"{doc}._parse_error").isNotNull() | F.col(f"{doc}._api_error").isNotNull()


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Header, all strings, rows of any length, a byte order mark or blanks around header names.
    With ``columns``: those, matched whatever their case and blanks; what is missing is empty."""
    raw = spark.read.option("header", True).option("mode", "PERMISSIVE").option("encoding", "UTF-8").option("multiLine", True).csv(path)
    clean = {c: c.replace("﻿", "").strip() for c in raw.columns}
    rows = raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in clean.items()])
    if columns is None:
        return rows
    found = {n.lower(): n for n in rows.columns}
    return rows.select(*[(F.col(f"`{found[c.lower()]}`") if c.lower() in found else F.lit("")).alias(c) for c in columns])


def read_csv_or_empty(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return read_csv(spark, path, columns)


def read_sheet(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """A spreadsheet's sheet, all strings, empty cells as ''. Needs a spreadsheet engine for pandas."""
    try:
        frame = pd.read_excel(path, sheet_name=sheet, dtype=str).fillna("")
    except ImportError as e:
        raise RuntimeError("reading spreadsheets needs an engine for pandas.read_excel") from e
    schema = T.StructType([T.StructField(str(c), T.StringType()) for c in frame.columns])
    return spark.createDataFrame(frame.to_dict("split")["data"], schema)


def literal_name(c: Column, field: str = "nafn") -> Column:
    """A field of a dictionary that was written as Python text: ``{'id': 4, 'nafn': 'x'}``."""
    return F.regexp_extract(c, rf"'{field}':\s*'([^']*)'", 1)


def literal_list(c: Column, schema: str) -> Column:
    """A Python literal as JSON; null where that fails."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    return F.from_json(text, schema, {"allowSingleQuotes": "true"})


def read_crosswalk(rows: DataFrame, key: str = "abbreviation", names: str = "full_names_modern") -> DataFrame:
    """abbr, name: each abbreviation, with and without dots at its end, and each of its names."""
    abbr, each = strip(F.col(key)), F.filter(F.transform(F.split(names, ";"), strip), lambda x: x != "")
    rows = rows.where((abbr != "") & (F.size(each) > 0))
    both = F.array_distinct(F.array(abbr, F.regexp_replace(abbr, r"\.+$", "")))
    return rows.select(F.explode(both).alias("abbr"), each.alias("each")).select("abbr", F.explode("each").alias("name")).distinct()


def group_labels(bindings: DataFrame) -> DataFrame:
    """``bindings``: qid, label, alt, lat, long (alt may be null). qid, all_labels (the label, then the
    others, by ``|``), g_lat, g_lng; entries without coordinates are left out."""
    rows = bindings.where("lat is not null and long is not null")
    alts = F.array_join(F.array_sort(F.collect_set("alt")), "|")
    out = rows.groupBy("qid").agg(F.min("label").alias("label"), alts.alias("alts"), F.min("lat").alias("g_lat"), F.min("long").alias("g_lng"))
    return out.withColumn("all_labels", F.concat_ws("|", "label", F.nullif("alts", F.lit(""))))


def repair_json(text: str | None) -> list[dict]:
    """The records of a cut or broken reply: as it is; else up to the last whole object of its
    results; else every balanced object that has an id and a name."""
    if not text:
        return []

    def records(data) -> list:
        got = data.get("results", []) if isinstance(data, dict) else data if isinstance(data, list) else []
        return [r for r in got if isinstance(r, dict)]

    cut = text.rfind("},{")
    for attempt in (text, text[: cut + 1] + "]}" if cut >= 0 else None):
        try:
            if attempt is not None:
                return records(json.loads(attempt))
        except ValueError:
            continue
    return repair_objects(text)


def repair_objects(text: str) -> list[dict]:
    decoder, at, out = json.JSONDecoder(), text.find("{"), []
    while at >= 0:
        try:
            got, end = decoder.raw_decode(text, at)
        except ValueError:
            end, got = at + 1, None
        if isinstance(got, dict) and "id" in got and "name" in got:
            out.append(got)
        at = text.find("{", end)
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def repaired(texts: pd.Series) -> pd.Series:
    """Each record of ``repair_json`` as JSON text."""
    return texts.map(lambda t: [json.dumps(r, sort_keys=True, ensure_ascii=False) for r in repair_json(t)])


#: As many as the studied reader follows.
MAX_PAGES = 200


class PagedReader(DataSourceReader):
    """Follows ``next`` links; a payload is a list, an object with results, or one object. At most
    ``maxpages`` pages are read (200 unless given). If a link is left then, the default limit is an
    error, because records would be lost unasked; a limit that was given is a warning."""

    def __init__(self, options: dict, fetch: Callable[[str], dict | list] | None = None):
        self.options, self.fetch = options, fetch or self._get

    @staticmethod
    def _get(url: str):
        with urllib.request.urlopen(url, timeout=60) as reply:  # noqa: S310
            return json.loads(reply.read().decode("utf-8"))

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        params = {k[6:]: v for k, v in self.options.items() if k.startswith("param.")}
        url = self.options["path"] + ("?" + urllib.parse.urlencode(params) if params else "")
        limit = int(self.options.get("maxpages", MAX_PAGES))
        for _ in range(limit):
            data = self.fetch(url)
            results = data["results"] if isinstance(data, dict) and "results" in data else data if isinstance(data, list) else [data]
            for record in results:
                yield (json.dumps(record, sort_keys=True, ensure_ascii=False),)
            url = data.get("next") if isinstance(data, dict) else None
            if not url:
                return
        left = f"{self.options['path']} has more than {limit} pages; the next one is {url}"
        if "maxpages" not in self.options:
            raise RuntimeError(f"{left}; set maxpages")
        warnings.warn(left, stacklevel=2)


class PagedSource(DataSource):
    """``spark.read.format("paged_rest").option("path", url).option("param.type", ...).load()``"""

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))
