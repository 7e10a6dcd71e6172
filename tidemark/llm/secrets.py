"""Secret scan: keyword automaton, anchored patterns near hits, checksum validation.

One Aho-Corasick pass over each text (bytes, ASCII letters lower-cased) finds
the keywords; a pattern is tried only where its keyword ends up. Long hex runs
have no keyword and are found by one linear pattern. Token formats that embed
a checksum are accepted only if it holds.

Defined cases: null text counts as empty and has no spans; spans are in code
points, end exclusive; every row of the input gets a row; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import small_batches, text_column, utf8

# Keywords and patterns of the formats (base kinds in their listed order).
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")
KEYWORDS = {"assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
            "access": ("akia",),
            "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
            "npm": ("npm_",)}
ASSIGN = re.compile(
    rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
CHECKED = {"github": re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"),
           "npm": re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
MIN_VALUE, MIN_ACCESS = 6, 20

SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "kinds array<string>, starts array<long>, ends array<long>")

_automaton = None


def _keywords() -> ahocorasick.Automaton:
    """The automaton, built once per worker."""
    global _automaton
    if _automaton is None:
        a = ahocorasick.Automaton()
        for kind, found in KEYWORDS.items():
            for word in found:
                a.add_word(word, (kind, len(word)))
        a.make_automaton()
        _automaton = a
    return _automaton


def checksum_holds(body: bytes, check: bytes) -> bool:
    """The last six characters are the CRC-32 of the rest in base 62."""
    n, out = zlib.crc32(body), bytearray()
    for _ in range(6):
        n, r = divmod(n, 62)
        out.append(BASE62[r])
    return bytes(reversed(out)) == check


def find_spans(text: bytes) -> list[tuple[int, int, str]]:
    """All spans as (start, end, kind) in bytes, by start and then kind."""
    spans = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    free = {"assign": 0, "access": 0}
    hits = sorted((end - n + 1, kind) for end, (kind, n) in _keywords().iter(text.lower().decode("latin-1")))
    for at, kind in hits:
        if kind == "assign" and at >= free["assign"] and (m := ASSIGN.match(text, at)):
            free["assign"] = m.end()
            if m.end(2) - m.start(2) >= MIN_VALUE:
                spans.append((m.start(), m.end(), kind))
        elif kind == "access" and at >= free["access"] and (m := ACCESS.match(text, at)):
            free["access"] = m.end()
            if m.end() - m.start() >= MIN_ACCESS:
                spans.append((m.start(), m.end(), kind))
        elif kind in CHECKED and (m := CHECKED[kind].match(text, at)) and checksum_holds(m[1], m[2]):
            spans.append((m.start(), m.end(), kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def in_code_points(text: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte spans as code-point spans; spans begin and end on characters."""
    if text.isascii():
        return spans
    edges = sorted({e for s in spans for e in s[:2]})
    at, chars, where = 0, 0, {}
    for e in edges:
        chars += len(text[at:e].decode("utf-8", "replace"))
        at, where[e] = e, chars
    return [(where[a], where[b], kind) for a, b, kind in spans]


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [in_code_points(t, find_spans(t)) for t in utf8(batch.column(1))]
        base = [[s for s in x if s[2] in BASE_KINDS] for x in found]
        counts = [[sum(s[2] == kind for s in x) for x in found] for kind in BASE_KINDS]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in counts),
             pa.array([hashlib.sha256(_listed(x).encode()).hexdigest() for x in base]),
             pa.array([_listed(x) for x in found], pa.string()),
             pa.array([[s[2] for s in x] for x in found], pa.list_(pa.string())),
             pa.array([[s[0] for s in x] for x in found], pa.list_(pa.int64())),
             pa.array([[s[1] for s in x] for x in found], pa.list_(pa.int64()))],
            names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "kinds", "starts", "ends"])


def scan(docs: DataFrame) -> DataFrame:
    """Spans of every document: one row per input row, no shuffle."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), text_column().alias("text")).mapInArrow(_scan_batches, SCHEMA)


def redacted(text: str, mask: str = "[SECRET]") -> str:
    """The text with every span (overlaps merged) replaced by ``mask``."""
    raw = text.encode("utf-8", "surrogatepass")
    out, at = [], 0
    for a, b, _ in find_spans(raw):
        if a >= at:
            out += [raw[at:a], mask.encode()]
        at = max(at, b)
    return (b"".join(out) + raw[at:]).decode("utf-8", "surrogatepass") if out else text


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """Documents with secrets masked in ``text`` and ``n_chars`` counted anew where it is
    present; other columns, order of columns and rows without secrets are unchanged
    (null text stays null). Rows pass through as they are, so repeated ids are safe."""
    small_batches(docs.sparkSession)
    at, names = docs.columns.index("text"), docs.columns
    schema = docs.schema

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column(at).to_pylist()
            after = [None if t is None else redacted(t, mask) for t in before]
            columns = list(batch.columns)
            columns[at] = pa.array(after, batch.column(at).type)
            if "n_chars" in names:
                k = names.index("n_chars")
                kept = batch.column(k).to_pylist()
                columns[k] = pa.array([n if a == b else len(a) for n, a, b in zip(kept, after, before, strict=True)],
                                      batch.column(k).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(masked, schema)
