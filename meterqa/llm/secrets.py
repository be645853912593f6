"""Secrets in texts: plain patterns, and credentials given in several parts.

Plain patterns (``assign``, ``access``, ``hex``) are reported wherever they stand. A weak candidate - a short value after a
key word, or a random-looking token - says little alone. Identifiers, weak secrets and endpoints of a document are
intervals; an interval join finds, for each weak secret, the parts that lie in its scope, and the candidate is
reported (``multipart``) only where an identifier and an endpoint, or an access identifier, stand there too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterqa.llm.base import ship_code

# The plain patterns and the least lengths of their matches.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run is matched whole, so the least length may stand in the pattern
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Parts of one credential lie at most so many characters apart.
SCOPE = 240
IDENTIFIER = re.compile(
    r"""\b(?:client[_-]?id|account|user(?:name)?|login|key[_-]?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}""",
    re.ASCII | re.IGNORECASE,
)
#: The start of a scheme, and an address from its colon on; what lies between is looked back over, not searched anew from every dash.
SCHEME, ADDRESS = re.compile(r"\b[a-z]", re.ASCII | re.IGNORECASE), re.compile(r"""://[^\s"'<>]+""")
_IN_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
HOST = re.compile(
    r"""\b(?:host|endpoint|server|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._:/-]{4,}"""
    r"""|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])""",
    re.ASCII | re.IGNORECASE,
)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{20,}", re.ASCII)

KINDS = ("assign", "access", "hex", "multipart")
Span = tuple[int, int, int]  # start, place in KINDS, end


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Plain matches in order, and the too short ones after a key word as (start, end)."""
    spans: list[Span] = []
    short: list[tuple[int, int]] = []
    lower = text.encode("utf-8", "surrogatepass").lower()
    if any(word in lower for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                spans.append((m.start(), 0, m.end()))
            else:
                short.append(m.span())
    if b"akia" in lower:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans), short


def endpoint_spans(text: str) -> list[tuple[int, int]]:
    """Addresses with a scheme, named hosts and numeric addresses, the leftmost first and none inside another."""
    spans = [m.span() for m in HOST.finditer(text)]
    at = text.find("://")
    while at >= 0:
        begin, address = at, ADDRESS.match(text, at)
        while begin and text[begin - 1] in _IN_SCHEME:
            begin -= 1
        scheme = SCHEME.search(text, begin, at)
        if scheme and address:
            spans.append((scheme.start(), address.end()))
            at = text.find("://", address.end())
        else:
            at = text.find("://", at + 3)
    found: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if not found or start >= found[-1][1]:
            found.append((start, end))
    return found


def _within(parts: np.ndarray, starts: np.ndarray, ends: np.ndarray, scope: int) -> np.ndarray:
    """Interval join: whether any of ``parts`` (starts and ends, sorted by start) comes within ``scope`` of each interval."""
    if not len(parts):
        return np.zeros(len(starts), bool)
    reach = np.maximum.accumulate(parts[:, 1])
    last = np.searchsorted(parts[:, 0], ends + scope, "right") - 1
    return (last >= 0) & (reach[np.maximum(last, 0)] >= starts - scope)


def multipart_spans(text: str, base: list[Span], short: list[tuple[int, int]], scope: int = SCOPE) -> list[Span]:
    """Weak secrets with complementary parts in their scope.

    A text without any identifier or access key has none, so tokens and endpoints are searched only beside those.
    """
    access = [(s, e) for s, k, e in base if k == 1]
    names = sorted([m.span() for m in IDENTIFIER.finditer(text)] if ("=" in text or ":" in text) else [])
    if not names and not access:
        return []
    taken = [(s, e) for s, _, e in base]
    endpoints = endpoint_spans(text)
    weak = set(short) | {m.span() for m in TOKEN.finditer(text)}
    covered = np.array(sorted(taken), np.int64).reshape(-1, 2)
    intervals = np.array(sorted(weak), np.int64).reshape(-1, 2)
    if not len(intervals):
        return []
    starts, ends = intervals[:, 0], intervals[:, 1]
    # What touches a plain match, an identifier or an endpoint is that, not a secret of its own.
    others = np.array(sorted([*names, *endpoints]), np.int64).reshape(-1, 2)
    free = ~_within(covered, starts, ends - 1, -1) & ~_within(others, starts, ends - 1, -1)
    near = [_within(np.array(sorted(p), np.int64).reshape(-1, 2), starts, ends, scope) for p in (names, endpoints, access)]
    linked = free & ((near[0] & near[1]) | near[2])
    return [(int(s), 3, int(e)) for s, e in intervals[linked]]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _found(scope: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text in batch.column(1):
                text = text.as_py() or ""
                base, short = base_spans(text)
                spans = sorted(base + multipart_spans(text, base, short, scope))
                for k in range(3):
                    out[k].append(sum(1 for x in base if x[1] == k))
                out[3].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out[4].append(_joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), *(pa.array(x, pa.string()) for x in out[3:])],
                names=[batch.schema.names[0], "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return found


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per document: ``id_col``, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. A null text counts as empty and has
    none. Rows are handled one by one where they lie, without a shuffle, so repeated rows give equal rows and an
    empty table an empty result.
    """
    ship_code(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select(id_col, text_col).mapInArrow(_found(scope), schema)
