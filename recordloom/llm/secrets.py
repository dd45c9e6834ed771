"""Secret scans: fixed patterns, and windows of high entropy inside candidate strings."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import of_rows, ship

ship(__name__)

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: A hexadecimal run holds at least this many characters, so shorter ones need no look.
LONG_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Least entropy, in bits a character, of a window of 20 characters of one class.
CLASSES = (
    ("entropy_hex", re.compile(r"[0-9a-fA-F]{20,}"), 3.0),
    ("entropy_alnum", re.compile(r"[0-9A-Za-z]{20,}"), 3.6),
    ("entropy_base64", re.compile(r"[0-9A-Za-z+/_=-]{20,}"), 3.8),
)
KINDS = ("assign", "access", "hex", *(c[0] for c in CLASSES))
#: Runs that look random and are not secret: identifiers, words, dates and numbers.
SHAPES = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"[A-Za-z]+([-_/][A-Za-z]+)*"),
    re.compile(r"[0-9/=_+-]+"),
)
#: What a found span may hold if it is an example or an alphabet.
EXAMPLES = re.compile(r"(?i)example|sample|placeholder|changeme|your[_-]?(key|token|secret)|xxxx|abcdef|012345|qwerty")

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                    ("n_entropy", pa.int64()), ("base_spans", pa.string()), ("spans", pa.string())])


def dense_windows(s: str, least: float) -> list[tuple[int, int]]:
    """Unions of the windows of 20 characters whose Shannon entropy reaches ``least``.

    The sum of ``c * log2 c`` over the counts is kept while the window slides: one character
    leaves, one enters, so each step costs the same whatever the window's length.
    """
    part = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
    bits = math.log2(WINDOW)
    counts = Counter(s[:WINDOW])
    total = sum(part[c] for c in counts.values())
    found: list[tuple[int, int]] = []
    for i in range(len(s) - WINDOW + 1):
        if i:
            for c, step in ((s[i - 1], -1), (s[i + WINDOW - 1], 1)):
                total += part[counts[c] + step] - part[counts[c]]
                counts[c] += step
        if bits - total / WINDOW >= least - 1e-9:
            if found and i <= found[-1][1]:
                found[-1] = (found[-1][0], i + WINDOW)
            else:
                found.append((i, i + WINDOW))
    return found


def entropy_spans(text: str) -> list[tuple[int, str, int]]:
    """Spans of candidate strings by character class, from the narrowest.  The allow list is held against the run and the span found,
    not the candidate around them, and a span of a wider class goes only where it overlaps one of a narrower class."""
    out = []
    for m in CANDIDATE.finditer(text):
        s = m.group()
        taken: list[tuple[int, int]] = []
        for kind, runs, least in CLASSES:
            for run in runs.finditer(s):
                body, first = run.group(), run.start()
                if any(a.fullmatch(body) for a in SHAPES) or not (any(c.isdigit() for c in body) and any(c.isalpha() for c in body)):
                    continue
                ids = [x.span() for x in SHAPES[0].finditer(body)]
                for a, b in dense_windows(body, least):
                    if EXAMPLES.search(body, a, b) or any(x < b and a < y for x, y in ids):
                        continue
                    if not any(x < first + b and first + a < y for x, y in taken):
                        out.append((m.start() + first + a, kind, m.start() + first + b))
                        taken.append((first + a, first + b))
    return out


def base_spans(text: str) -> list[tuple[int, str, int]]:
    out = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return out + [(m.start(), "hex", m.end()) for m in LONG_HEX.finditer(text)]


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2])))


def scan(rows: list) -> list:
    out = []
    for doc_id, text in rows:
        base = base_spans(text or "")
        more = entropy_spans(text or "")
        n = Counter(k for _, k, _ in base)
        out.append((doc_id, n["assign"], n["access"], n["hex"], len(more), joined(base), joined(base + more)))
    return out


def secret_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Spans of secrets in every row: doc_id, counts per kind, base_spans and spans.

    Spans are kind:start:end in code points, end exclusive, by start.  A null or empty text has none.
    Texts of any length are handled one at a time and whole; repeated rows give repeated results; other columns
    are ignored; an empty table gives no rows.  A narrow map: nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(of_rows(scan, SCHEMA, "doc_id", "text"),
                           "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_spans string, spans string")
