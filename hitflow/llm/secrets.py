"""Secret scans: fixed patterns, and Shannon entropy in a sliding window over candidate strings.

Base spans come from three patterns. The method adds strings that look random: runs of key characters are
candidates; a window slides over each, per character class, and its entropy is kept up to date from the counts
of the character that enters and the one that leaves. A candidate becomes a span where the entropy of some
window reaches the threshold of its class, unless the allow list knows it or a base span already covers it.

Offsets are code points, the end exclusive. Defined cases: a null or empty text has no spans; rows keep their
doc_id, null or repeated.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Base patterns and least lengths: fixed values.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "entropy")

# Cheap sign that an assignment may be there at all.
_KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")

WINDOW = 20
# Candidates of at least one window; the classes, narrowest first, with the entropy in bits that counts as random.
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("base32", re.compile(r"[A-Z2-7]+"), 3.4),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.8),
)
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
# What looks random and is none: examples, alphabets, placeholders, UUIDs, words joined by signs.
ALLOWED = (
    re.compile(r"(?i)example|sample|dummy|placeholder|test|changeme|redacted"),
    re.compile(r"(?i)abcdefghij|0123456789|1234567890|qwertyuiop"),
    re.compile(r"(.)\1{5}"),
    re.compile(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"),
    re.compile(r"^[A-Za-z]+([_/=-]+[A-Za-z]+)*[_/=-]*[0-9]{0,4}$"),
)

# c * log2(c) for the counts a window can have.
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def peak_entropy(text: str, window: int = WINDOW) -> float:
    """Largest entropy, in bits per character, of any window of ``text``; of the whole text if it is shorter.

    With counts c of a window of n characters the entropy is log2(n) - sum(c * log2(c)) / n; a step changes
    two counts, so only two terms of the sum.
    """
    size = min(window, len(text))
    if not size:
        return 0.0
    counts: dict[str, int] = {}
    total = 0.0
    for character in text[:size]:
        c = counts.get(character, 0)
        total += _TERM[c + 1] - _TERM[c]
        counts[character] = c + 1
    least = total
    for gone, new in zip(text, text[size:]):
        if gone != new:
            c = counts[gone]
            total += _TERM[c - 1] - _TERM[c]
            counts[gone] = c - 1
            c = counts.get(new, 0)
            total += _TERM[c + 1] - _TERM[c]
            counts[new] = c + 1
            least = min(least, total)
    return math.log2(size) - least / size


def is_allowed(text: str) -> bool:
    return any(pattern.search(text) for pattern in ALLOWED)


def looks_random(text: str) -> bool:
    """Whether a candidate mixes letters and digits and is as uneven as its class demands."""
    if not (_DIGIT.search(text) and _LETTER.search(text)) or is_allowed(text):
        return False
    for _, pattern, threshold in CLASSES:
        if pattern.fullmatch(text):
            return peak_entropy(text) >= threshold
    return False


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans of a text as (start, end, kind), by start and then in the order of the kinds."""
    if not text:
        return []
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    known = sorted(found)
    for match in CANDIDATE.finditer(text):
        start, end = match.span()
        if any(a < end and start < b for a, b, _ in known):
            continue
        if looks_random(match[0]):
            found.append((start, end, "entropy"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


SCANNED = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_entropy bigint, base_sha256 string, spans string"


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text); one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                found = spans(text.as_py())
                base = [s for s in found if s[2] != "entropy"]
                counts = [sum(s[2] == kind for s in found) for kind in KINDS]
                rows.append((*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(found)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            columns = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCANNED)
