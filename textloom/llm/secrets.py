"""Secret scans with multipart credential linking.

Strong candidates (assignments, access identifiers, long hexadecimal runs) are reported
wherever they stand. Weak candidates, too common to report alone, are identifiers (``user=``,
``client_id=``), short or unnamed secrets, and endpoints (URLs, ``host=``). Each part is an
interval; parts are joined with complementary parts inside the same scope (a block of lines
without a blank line) and at most ``reach`` code points apart, by a sweep over the sorted parts:

* a weak identifier counts if a secret is near it,
* a weak secret counts if an identifier is near it,
* an endpoint counts if a secret that is itself reported is near it.

The sweep looks only at the nearest complement on either side, so a text with n parts costs
n log n. Each text is scanned whole, alone, in one pass of a Python worker; nothing is shuffled.

Defined results: null and empty texts have no spans; repeated rows give repeated results; an
empty table gives an empty result; further columns are ignored. Offsets count code points.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.shared import ensure_columns, tidy

REACH = 240
#: A reach that leaves the scope as the only bound.
WHOLE_SCOPE = sys.maxsize


def _either_case(words: str) -> str:
    """ASCII letters in either case, and no others that fold to them."""
    return re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", words)


ASSIGN = re.compile(
    "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
WEAK_ID = re.compile(
    r"(?<![A-Za-z0-9])(?:"
    + _either_case("access_?key_?id|client_?id|account|username|user|login")
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})"""
)
WEAK_ID_HINTS = ("accesskey", "access_key", "clientid", "client_id", "account", "user", "login")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{20,}={0,2}")
ENDPOINT = re.compile(
    r"""[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>|]+|(?<![A-Za-z0-9])(?:"""
    + _either_case("host|hostname|endpoint|server")
    + r""")["']?\x20*[:=]\x20*["']?[A-Za-z0-9][A-Za-z0-9.:/-]{2,}"""
)
ENDPOINT_HINTS = ("://", "host", "endpoint", "server")
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")


@dataclass(frozen=True, order=True)
class Span:
    start: int
    rank: int
    end: int

    @property
    def kind(self) -> str:
        return KINDS[self.rank]

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def base_spans(text: str, lowered: str) -> tuple[list[Span], list[Span]]:
    """Strong spans, and assignments whose value is too short to stand alone."""
    found, short = [], []
    if any(h in lowered for h in ASSIGN_HINTS):
        for m in ASSIGN.finditer(text):
            n = m.end(2) - m.start(2)
            if n >= 12:
                found.append(Span(m.start(), 0, m.end()))
            elif n >= 6:
                short.append(Span(m.start(), 4, m.end()))
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found), short


def _random_looking(s: str) -> bool:
    return bool(re.search("[0-9]", s) and re.search("[a-z]", s) and re.search("[A-Z]", s)) and len(set(s)) >= 12


class Near:
    """Sorted intervals; tells whether one of them is in reach of a span and in its scope."""

    def __init__(self, spans: list[Span], scope_of, reach: int):
        self.spans = sorted(spans)
        self.starts = [s.start for s in self.spans]
        self.scope_of, self.reach = scope_of, reach
        self.last_end: list[tuple[int, int]] = []
        best = (-1, -1)  # the largest end so far, and whose it is
        for i, s in enumerate(self.spans):
            best = max(best, (s.end, i))
            self.last_end.append(best)

    def __call__(self, span: Span) -> bool:
        at = bisect.bisect_left(self.starts, span.start)
        scope = self.scope_of(span.start)
        if at < len(self.spans):
            right = self.spans[at]
            if right.start - span.end <= self.reach and self.scope_of(right.start) == scope:
                return True
        if at:
            end, i = self.last_end[at - 1]
            if span.start - end <= self.reach and scope in (self.scope_of(end - 1), self.scope_of(self.spans[i].start)):
                return True
        return False


def linked_spans(text: str, lowered: str, base: list[Span], short: list[Span], reach: int = REACH) -> list[Span]:
    """The weak candidates that complementary parts support."""
    ids = []
    if any(h in lowered for h in WEAK_ID_HINTS):
        ids = [Span(m.start(), 3, m.end()) for m in WEAK_ID.finditer(text)]
    strong_ids = [s for s in base if s.rank == 1]
    strong_secrets = [s for s in base if s.rank != 1]
    ends = []
    if any(h in lowered for h in ENDPOINT_HINTS):
        ends = [Span(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    if not ids and not strong_ids and not (ends and strong_secrets):
        return []
    secrets = list(short)
    if ids or strong_ids:
        secrets += [Span(m.start(), 4, m.end()) for m in TOKEN.finditer(text) if _random_looking(m[0])]

    covered = Near(base, lambda _: 0, 0)

    def outside(span: Span) -> bool:
        """Not inside a strong span."""
        at = bisect.bisect_right(covered.starts, span.start)
        return not (at and covered.last_end[at - 1][0] >= span.end)

    ids, secrets, ends = ([s for s in part if outside(s)] for part in (ids, secrets, ends))
    breaks = [m.start() for m in BLANK_LINE.finditer(text)]

    def scope_of(at: int) -> int:
        return bisect.bisect_right(breaks, at)

    near_id = Near(strong_ids + ids, scope_of, reach)
    linked = [s for s in secrets if near_id(s)]
    near_secret = Near(strong_secrets + secrets, scope_of, reach)
    linked += [s for s in ids if near_secret(s)]
    near_reported = Near(strong_secrets + [s for s in linked if s.rank == 4], scope_of, reach)
    linked += [s for s in ends if near_reported(s)]
    return sorted(set(linked))


def find_secrets(text: str | None, reach: int = REACH) -> tuple[list[Span], list[Span]]:
    """Base spans and linked spans of one text, each sorted by start and kind."""
    if not text:
        return [], []
    lowered = text.lower()
    base, short = base_spans(text, lowered)
    return base, linked_spans(text, lowered, base, short, reach)


SCHEMA = (
    "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long, "
    "found array<struct<kind:string,start:long,end:long>>"
)


def _scan(reach: int):
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, linked = find_secrets(text.as_py(), reach)
                every = sorted(base + linked)
                counts = [sum(s.rank == k for s in base) for k in range(3)]
                digest = hashlib.sha256(",".join(map(str, base)).encode()).hexdigest()
                found = [{"kind": s.kind, "start": s.start, "end": s.end} for s in every]
                rows.append((*counts, digest, ",".join(map(str, every)), len(linked), found))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), kind_type]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked", "found"],
            )

    return run


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """A row per input row: its counts, its digest and its spans, as text and as an array."""
    ensure_columns(docs, id_col, text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(tidy(_scan(reach)), SCHEMA)
