"""Secret scan with multipart credential linking."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.llm.storage import stored

BASE = ("assign", "access", "hex")
WEAK = ("ident", "key", "endpoint")
#: Which parts make a weak candidate worth reporting.
COMPLEMENTS = {"ident": ("assign", "hex", "key"), "key": ("access", "ident", "endpoint"), "endpoint": ("assign", "hex", "key")}

_ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_IDENT = re.compile(
    r"""(?ai)(?<![A-Za-z0-9])(?<!secret[_-])(?:user(?:name)?|login|account(?:_?id)?|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
)
_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
_URL = re.compile(r"""(?a)[a-z][a-z0-9+]{1,15}://[^\s"'<>]+""")
_RUN = re.compile(r"(?a)[A-Za-z0-9.-]++(?P<port>:[0-9]{2,5}\b)?")  # every sign is read once, whatever the run
_EDGE = re.compile(r"(?a)\b[A-Za-z0-9-]")

_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_SPANS = "array<struct<kind:string,start:int,end:int>>"
PARTS = f"doc_id bigint, base {_SPANS}, weak {_SPANS}"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans that count by themselves, by start and then by kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return [(a, b, BASE[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


def _mixed(token: str) -> bool:
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


def _host_start(text: str, low: int, high: int) -> int:
    """First place of ``[low, high)`` from which dotted names reach up to ``high``; -1 if none.

    A name begins at a word boundary, names are not empty and there are two at least.
    """
    if text[high - 1] == ".":
        return -1
    gap = text.rfind("..", low, high)
    low = gap + 2 if gap >= 0 else low + (text[low] == ".")
    while (dot := text.find(".", low, high)) >= 0:
        if found := _EDGE.search(text, low, dot):
            return found.start()
        low = dot + 1
    return -1


def endpoints(text: str) -> list[tuple[int, int, str]]:
    """URLs, and dotted host names with a port that lie outside them."""
    urls = [m.span() for m in _URL.finditer(text)]
    found, k = [(a, b, "endpoint") for a, b in urls], 0
    at = 0
    while run := _RUN.search(text, at):
        low, at = run.span()
        while k < len(urls) and urls[k][1] <= low:
            k += 1
        if k < len(urls) and urls[k][0] < at:  # the run touches a URL: go on behind it
            at = max(at if not run["port"] else 0, urls[k][1])
            continue
        if run["port"]:
            start = _host_start(text, low, run.start("port"))
            if start >= 0:
                found.append((start, at, "endpoint"))
            else:
                at = run.start("port") + 1  # the digits may begin a name
    return found


def weak_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Parts that only mean something beside another part; none overlaps a base span or a weak part before it."""
    found: list[tuple[int, int, str]] = []
    if ":" in text:
        found += endpoints(text)
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "ident") for m in _IDENT.finditer(text)]
    found += [(m.start(), m.end(), "key") for m in _KEY.finditer(text) if _mixed(m[0])]
    if not found:
        return found
    kept: list[tuple[int, int, str]] = []
    taken, last = iter([*base, (1 << 60, 1 << 60, "")]), -1
    ahead, behind = next(taken), -1
    for part in sorted(found, key=lambda x: (x[0], WEAK.index(x[2]))):
        while ahead[0] < part[1]:
            behind, ahead = max(behind, ahead[1]), next(taken)
        if behind <= part[0] and last <= part[0]:
            kept.append(part)
            last = part[1]
    return kept


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, weak = [], []
        for text in batch["text"]:
            text = text.as_py() or ""
            strong = base_spans(text)
            base.append([dict(kind=k, start=a, end=b) for a, b, k in strong])
            weak.append([dict(kind=k, start=a, end=b) for a, b, k in weak_spans(text, strong)])
        spans = pa.list_(_SPAN)
        yield pa.record_batch({"doc_id": batch["doc_id"], "base": pa.array(base, spans), "weak": pa.array(weak, spans)})


def _bins(low: Column, high: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(low / width), F.floor(high / width)))


def linked(parts: DataFrame, reach: int) -> DataFrame:
    """Weak parts with a complementary part less than ``reach`` code points away in the same text.

    An interval join: scopes are dealt into bins of ``reach`` code points, so a part meets only the
    parts of three bins, and a bin of text holds a bounded number of parts.
    """
    weak = parts.select("key", F.explode("weak").alias("w")).select("key", "w.*")
    every = parts.select("key", F.explode(F.concat("base", "weak")).alias("p")).select("key", "p.*")
    needs = F.create_map(*[x for k, v in COMPLEMENTS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    scopes = weak.select(
        "key", "kind", "start", "end", _bins(F.greatest(F.col("start") - reach, F.lit(0)), F.col("end") + reach, reach).alias("bin")
    )
    scopes = scopes.withColumn("needs", needs[F.col("kind")]).alias("s")
    spots = every.select("key", "kind", "start", "end", _bins(F.col("start"), F.col("end"), reach).alias("bin")).alias("p")
    meets = (
        (F.col("s.key") == F.col("p.key"))
        & (F.col("s.bin") == F.col("p.bin"))
        & F.array_contains("s.needs", F.col("p.kind"))
        & (F.col("p.start") < F.col("s.end") + reach)
        & (F.col("p.end") > F.col("s.start") - reach)
    )
    return scopes.join(spots, meets, "left_semi").select("key", "kind", "start", "end").distinct()


def scan_secrets(docs: DataFrame, reach: int = 200) -> DataFrame:
    """All secret spans of every text: base spans, and weak parts linked to a complementary part.

    Base spans are assignments, access identifiers and long hex strings. Weak parts are account names,
    mixed-case tokens and endpoints; one is reported only where a complementary part (see
    ``COMPLEMENTS``) lies within ``reach`` code points.

    Returns ``doc_id`` and ``spans``, an array of (start, end, kind) by start and then by kind as
    listed in ``BASE`` and ``WEAK``; positions are code points, end exclusive. A null or empty text
    has none; every row is scanned by itself, whatever its ``doc_id``.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = stored(docs.mapInArrow(_scan, PARTS).withColumn("key", F.monotonically_increasing_id()), "secrets")
    order = F.create_map(*[x for i, k in enumerate((*BASE, *WEAK)) for x in (F.lit(k), F.lit(i))])
    added = linked(parts, reach).groupBy("key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    whole = parts.join(added, "key", "left")
    spans = F.concat("base", F.coalesce("added", F.array().cast(_SPANS)))
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return whole.select("doc_id", F.transform(ranked, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias("spans"))
