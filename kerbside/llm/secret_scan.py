"""Secret scans with linking of credentials that come in parts.

Strong kinds (``assign``, ``access``, ``hex``) are reported wherever they stand. Weak parts are too common to report alone:
short or prefixed access identifiers and named users (``weak_id``), short assigned values and bare mixed tokens
(``weak_secret``), and addresses of services (``endpoint``). They are candidates, and are linked by an interval join: each
part's span, widened by ``reach`` code points, is joined with the spans of the complementary parts of its scope, a stretch
of text without a blank line. An identifier needs a secret, a secret an identifier, an endpoint both; strong spans count
as identifiers (``access``) or secrets (``assign``, ``hex``). The join sorts the spans of a document and keeps the furthest
end so far, so a scope with n parts costs n log n steps and no pairs are listed.

Every pattern starts at an edge or a keyword and never goes back over what it has read, so that a megabyte without blanks
takes time in proportion to its length. A document is read by one task; nothing is shuffled, and a lost task repeats itself.

Defined results: a null or empty text has no spans; weak parts that overlap a strong span, and weak secrets that overlap a
weak identifier, are no candidates; repeated rows are scanned each; very long texts are scanned whole; other columns are
never read; an empty table gives no rows. Spans are code points with the end exclusive; values are never returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import documents, sliced

KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
BASE = KINDS[:3]
REACH = 300

# What a text must hold for a pattern to match anywhere, in lower case: looking for it first is much faster.
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ID_WORDS = ("key", "client", "account", "user", "login", "akia", "asia", "aida", "aroa", "agpa", "anpa")

Span = tuple[int, int]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_VALUE = r"""["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=@-]{3,}+"""
_WEAK_ID = re.compile(
    r"(?<![A-Z0-9])(?:A(?:KIA|SIA|IDA|ROA|GPA|NPA)[A-Z0-9]{4,}+)"
    rf"|(?<![A-Za-z])(?i:access_?key(?:_?id)?|key_?id|client_?id|account|user(?:_?name)?|login){_VALUE}",
    re.A,
)
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}", re.A)
_MIXED = tuple(map(re.compile, ("[a-z]", "[A-Z]", "[0-9]")))
_ENDPOINT = re.compile(
    r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,30}+://[^\s"'<>]++"""
    r"|(?<![\w.-])(?:[A-Za-z0-9-]{1,63}+\.)++[A-Za-z]{2,24}+:[0-9]{2,5}+"
    rf"|(?<![A-Za-z])(?i:endpoint|host(?:_?name)?|server|bucket|base_?url){_VALUE}",
    re.A,
)
_SCOPE_END = re.compile(r"\n[\x20\t\r]*+\n")


def _assigned(text: str, low: str, least: int, most: int) -> list[Span]:
    if not any(w in low for w in _ASSIGN_WORDS):
        return []
    return [m.span() for m in _ASSIGN.finditer(text) if least <= m.end(2) - m.start(2) <= most]


def base_spans(text: str, low: str) -> dict[str, list[Span]]:
    """The strong spans, by kind; of each kind leftmost and non-overlapping. ``low`` is the text in lower case."""
    return {
        "assign": _assigned(text, low, 12, len(text)),
        "access": [m.span() for m in _ACCESS.finditer(text)] if "AKIA" in text else [],
        "hex": [m.span() for m in _HEX.finditer(text)],
    }


def _columns(spans: list[Span], scopes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, sorted, each scope in a stretch of numbers of its own."""
    starts, ends = np.asarray(sorted(spans), np.int64).reshape(-1, 2).T
    own = np.searchsorted(scopes, starts, side="right") * room
    return starts + own, ends + own


def meets(spans: list[Span], others: list[Span], scopes: np.ndarray, length: int, reach: int) -> dict[Span, bool]:
    """For each span whether one of ``others`` lies in its scope and within ``reach`` of it; ``scopes`` are their starts."""
    room = length + 2 * reach + 1
    starts, ends = _columns(spans, scopes, room)
    other_starts, other_ends = _columns(others, scopes, room)
    furthest = np.maximum.accumulate(np.concatenate(([-1 - room], other_ends)))
    upto = np.searchsorted(other_starts, ends + reach, side="right")
    return dict(zip(sorted(spans), (furthest[upto] >= starts - reach).tolist(), strict=True))


def _apart(spans: list[Span], taken: list[Span], length: int) -> list[Span]:
    """The spans that overlap none of ``taken``."""
    if not spans or not taken:
        return spans
    none = np.empty(0, np.int64)
    # Half-open spans overlap if, with ends one less, they touch.
    closed = {(a, b - 1): (a, b) for a, b in spans}
    met = meets(list(closed), [(a, b - 1) for a, b in taken], none, length, 0)
    return [closed[s] for s, hit in met.items() if not hit]


def scan(text: str, reach: int = REACH) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans to report, by start and then by the order of ``KINDS``."""
    low, n = text.lower(), len(text)
    found = base_spans(text, low)
    strong = [s for kind in BASE for s in found[kind]]
    weak_ids = _apart([m.span() for m in _WEAK_ID.finditer(text)], strong, n) if any(w in low for w in _ID_WORDS) else []
    identifiers = found["access"] + weak_ids
    if identifiers:
        values = _assigned(text, low, 6, 11)
        values += [m.span() for m in _TOKEN.finditer(text) if all(p.search(m[0]) for p in _MIXED)]
        weak_secrets = _apart(sorted(set(values)), strong + weak_ids, n)
        secrets = found["assign"] + found["hex"] + weak_secrets
        if secrets:
            scopes = np.asarray([m.end() for m in _SCOPE_END.finditer(text)], np.int64)
            endpoints = _apart([m.span() for m in _ENDPOINT.finditer(text)], strong, n)
            found["weak_id"] = [s for s, met in meets(weak_ids, secrets, scopes, n, reach).items() if met]
            found["weak_secret"] = [s for s, met in meets(weak_secrets, identifiers, scopes, n, reach).items() if met]
            by_id, by_secret = (meets(endpoints, x, scopes, n, reach) for x in (identifiers, secrets))
            found["endpoint"] = [s for s in endpoints if by_id[s] and by_secret[s]]
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(((kind, *s) for kind, spans in found.items() for s in spans), key=lambda x: (x[1], order[x[0]], x[2]))


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan_secrets(df: DataFrame, reach: int = REACH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ``found``, an array of (kind, start, end)."""
    docs = documents(df, id_col, text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in _FOUND.value_type]
        for batch in sliced(batches):
            found = [[dict(zip(names, s, strict=True)) for s in scan(text.as_py() or "", reach)] for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _FOUND)], ["doc_id", "found"])

    return docs.mapInArrow(run, f"doc_id {id_type}, found array<struct<kind: string, start: int, end: int>>")


def count_of(kind: str, found: str = "found") -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def listed(kinds: tuple[str, ...] = KINDS, found: str = "found") -> Column:
    """The spans of some kinds as kind:start:end, joined by commas."""
    spans = F.filter(found, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
