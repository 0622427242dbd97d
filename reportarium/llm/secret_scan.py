"""Find secrets in whole texts: three fixed shapes, and random-looking strings.

Fixed shapes are matched leftmost and without overlap, each kind for itself: assignments to a
password-like name, access key ids, long hex strings. Beyond these, candidate strings (long
runs of key characters) are searched with a sliding window: counts of the characters in the
window are kept up to date as it moves, and give the Shannon entropy of the window within
each character class. Windows above their class's bound are joined into spans of the kind
``entropy``, unless a fixed shape already has the place.

A candidate has parts between '/', '-' and '_'. The allow-list (UUIDs, alphabets, marked
examples) takes out the parts that it covers and no others; windows go over all parts between
these. Parts made like words or names are no keys: a window counts if most of it is other parts.

Null text: as empty, no spans. Empty table: no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reportarium.llm.common import steps

#: The shapes, in the order in which kinds are listed, and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LENGTH = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 16
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "entropy")

#: Character classes: pattern of a candidate, window, and least entropy in bits of a window.
#: A random window of 20 hex digits has 3.4 bits on average, one of 24 base-64 characters 4.2.
CLASSES = {
    "hex": (re.compile(r"(?<![A-Za-z0-9+])[0-9a-fA-F]{20,}(?![A-Za-z0-9+])"), 20, 3.0),
    "base64": (re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}"), 24, 3.8),
}
#: Parts that look random and are no secrets; held against up to ``ALLOWED_PARTS`` in a row.
ALLOWED = (
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
    r"(?i)[^-/_]*(?:example|sample|placeholder|changeme|dummy|xxxx|0123456789|abcdefgh)[^-/_]*",
    r"[0-9]+(?:[-/_][0-9]+)*",
)
ALLOWED_PARTS = 5
PART = re.compile(r"[^/_-]+")
#: What names are put together from: words in either way of writing, and numbers.
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
CONSONANTS = re.compile(r"[^aeiouyAEIOUY]{6}")
VOWEL = re.compile(r"[aeiouyAEIOUY]")
#: Share of a part's letters in words that can be spoken, from which it is taken for a name.
SPOKEN = 0.75
#: Shorter parts of a key may look like a word or a number, so they are left to their neighbours.
SHORT = 4
#: Least share of a window in parts that are no names.
OTHER = 0.6

Span = tuple[str, int, int]


def fixed_spans(text: str) -> list[Span]:
    spans = []
    if ":" in text or "=" in text:
        spans += [
            ("assign", m.start(), m.end())
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        spans += [
            ("access", m.start(), m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    return spans + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def entropies(text: str, window: int) -> Iterator[float]:
    """Shannon entropy in bits of each window, from counts updated as it slides.

    With counts n of a window of w characters, it is log2 w - (sum of n log2 n) / w.
    """
    weight = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    for i, c in enumerate(text):
        if i >= window:
            out = text[i - window]
            n = counts[out]
            counts[out] = n - 1
            total += weight[n - 1] - weight[n]
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += weight[n + 1] - weight[n]
        if i >= window - 1:
            yield math.log2(window) - total / window


def mixed(text: str) -> bool:
    """Whether a string has digits and letters; hex keys do."""
    return any(c.isdigit() for c in text) and any(c.isalpha() for c in text)


def named(part: str) -> bool:
    """Whether a part is made like a name: a number, letters of one word, or a few of both."""
    chunks = WORD.findall(part)
    words = [c for c in chunks if not c[0].isdigit()]
    numbers = len(chunks) - len(words)
    if not words or len(words) == 1 and not numbers:
        return True
    if numbers > 2:
        return False
    spoken = [w for w in words if len(w) >= 3 and VOWEL.search(w) and not CONSONANTS.search(w)]
    return sum(map(len, spoken)) >= SPOKEN * sum(map(len, words))


def covered(
    text: str, parts: list[tuple[int, int]], allowed: list[re.Pattern]
) -> list[tuple[int, int]]:
    """The places in a candidate that the allow-list covers, from part to part.

    Numbers are allowed, too, but a short one may be a piece of a key.
    """
    places, i = [], 0
    while i < len(parts):
        start = parts[i][0]
        for j in range(min(i + ALLOWED_PARTS, len(parts)) - 1, i - 1, -1):
            end = parts[j][1]
            if end - start >= SHORT and any(a.fullmatch(text, start, end) for a in allowed):
                places.append((start, end))
                i = j
                break
        i += 1
    return places


def before(size: int, places: Iterable[tuple[int, int]]) -> list[int]:
    """How many characters of some places lie before each position."""
    inside = [0] * (size + 1)
    for start, end in places:
        inside[start + 1 : end + 1] = [1] * (end - start)
    return list(accumulate(inside))


def key_spans(
    text: str, window: int, least: float, allowed: list[re.Pattern]
) -> list[tuple[int, int]]:
    """The places in a candidate whose windows are random and mostly other parts than names."""
    parts = [m.span() for m in PART.finditer(text)]
    long = [(a, b) for a, b in parts if b - a >= SHORT]
    names = {(a, b) for a, b in long if named(text[a:b])}
    if len(names) == len(long):
        return []
    others = before(len(text), (p for p in long if p not in names))
    # Slack for rounding: sums of floats added and taken away again.
    hits = [
        i
        for i, h in enumerate(entropies(text, window))
        if h >= least - 1e-9 and others[i + window] - others[i] >= OTHER * window
    ]
    if not hits:
        return []
    taken = before(len(text), covered(text, parts, allowed))
    found = joined((i, i + window) for i in hits if taken[i + window] == taken[i])
    # A span starts and ends with no name.
    kept = [p for p in parts if p not in names]
    starts, ends = [a for a, _ in kept], [b for _, b in kept]

    def trimmed(start: int, end: int) -> tuple[int, int]:
        i, j = bisect_left(parts, (start + 1,)) - 1, bisect_left(parts, (end,)) - 1
        if i >= 0 and parts[i] in names and start < parts[i][1]:
            start = starts[bisect_right(ends, start)]
        if parts[j] in names:
            end = ends[bisect_left(starts, end) - 1]
        return start, end

    return [trimmed(a, b) for a, b in found]


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def entropy_spans(text: str, allowed: list[re.Pattern]) -> list[tuple[int, int]]:
    spans = []
    for kind, (candidate, window, least) in CLASSES.items():
        for m in candidate.finditer(text):
            if kind == "hex" and not mixed(m[0]):
                continue
            spans += [
                (m.start() + a, m.start() + b) for a, b in key_spans(m[0], window, least, allowed)
            ]
    return joined(spans)


def spans_of(text: str, allowed: list[re.Pattern]) -> list[Span]:
    """All spans by start, then by the order of kinds; positions are code points."""
    fixed = fixed_spans(text)
    added = [
        ("entropy", a, b)
        for a, b in entropy_spans(text, allowed)
        if not any(a < end and start < b for _, start, end in fixed)
    ]
    return sorted(fixed + added, key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str, spans: list[Span], mark: str) -> str:
    """The text with each stretch of overlapping spans replaced by a mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def find_secrets(documents: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id and its spans, an array of (kind, start, end)."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))]
    )
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(a) for a in allowed]
        for batch in steps(batches):
            spans = [
                [dict(zip(SPAN.names, s, strict=True)) for s in spans_of(text, patterns)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "spans": spans}, schema=arrow
            )

    return documents.select("doc_id", "text").mapInArrow(scan, schema)


def redact(
    documents: DataFrame, mark: str = "[secret]", allowed: tuple[str, ...] = ALLOWED
) -> DataFrame:
    """The same rows and columns, with secrets in the text replaced by a mark.

    ``n_chars``, where present, is counted anew for changed texts; null texts stay null.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(a) for a in allowed]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            clean = [
                t if t is None or not (spans := spans_of(t, patterns)) else redacted(t, spans, mark)
                for t in texts
            ]
            changes = {"text": clean}
            if "n_chars" in batch.schema.names:
                old = batch.column("n_chars").to_pylist()
                changes["n_chars"] = [
                    n if t == c else len(c) for n, t, c in zip(old, texts, clean, strict=True)
                ]
            for name, values in changes.items():
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(
                    at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type)
                )
            yield batch

    return documents.mapInArrow(scan, documents.schema)


def listed(spans: Column) -> Column:
    """Spans as one text, kind:start:end joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
