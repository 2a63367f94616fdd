"""Secrets in texts: three fixed shapes, and strings too random to be language.

The fixed shapes are assignments to a name like `password`, access keys and long lowercase hexadecimal strings. The method
adds what they miss. For each character class the maximal runs of its characters, WINDOW or longer, are candidate strings.
A window of WINDOW characters slides over a candidate; its counts change by one character in and one out, and so does the
sum that its Shannon entropy is made of. Windows at or above the class's entropy that hold every kind of character the
class asks for are random; windows that overlap or touch join to one span. A span inside a match of the allow-list (links,
UUIDs, checksums named as such, placeholders) is suppressed, and one inside a span of a fixed shape adds nothing. Fixed
shapes are never suppressed.

Entropy is summed in whole 1/2**20 bits, so sliding and counting afresh agree exactly. Each text is worked on by itself, in
the task that reads it: nothing is shuffled, and memory follows the longest text, read in slices of about a megabyte.

Defined results: positions count code points, ends are exclusive; a null or empty text has no spans; a very long text is
scanned whole; repeated rows and repeated ids are rows of their own; an empty table gives no rows; columns asked for come
back inside `row`, so no name clashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablespan.llm.common import text_blocks

#: The fixed shapes: kind, pattern, group whose length counts, least length. Only ASCII letters match in either case.
SHAPES = [
    ("assign", re.compile(r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))"), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}"), 0, 24),
]
BASE_KINDS = [kind for kind, *_ in SHAPES]

WINDOW = 20
UNITS = 1 << 20


@dataclass(frozen=True)
class Charset:
    kind: str
    characters: str             # as in a regular expression's brackets
    bits: float                 # least entropy of a random window
    needs: tuple[str, ...]      # character kinds that a random window holds, as in brackets


#: Random windows of 20 hexadecimal digits have 3.5 bits on average, of 64 characters 4.1; words stay below 3.9 or lack digits.
CHARSETS = (
    Charset("entropy_hex", "0-9A-Fa-f", 2.9, ("0-9", "A-Fa-f")),
    Charset("entropy_base64", "0-9A-Za-z+/_-", 3.75, ("0-9", "a-z", "A-Z")),
)
KINDS = [*BASE_KINDS, *[c.kind for c in CHARSETS]]

#: What looks random and is no secret.
ALLOWED = (
    r"[A-Za-z][A-Za-z0-9+.-]*://[^\s\"'<>]+",                                                      # links
    r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])",        # UUIDs
    r"(?i:md5|sha-?(?:1|224|256|384|512)|checksum|commit|etag)[\"']?[ ]*[-:= ][ ]*[\"']?[0-9A-Za-z+/=]+",  # checksums
    r"[0-9A-Za-z+/_-]*(?i:example|placeholder|changeme|x{8})[0-9A-Za-z+/_-]*",                     # placeholders
)

_ALLOWED = [re.compile(p) for p in ALLOWED]
_RUNS = [re.compile(f"(?<![{c.characters}])[{c.characters}]{{{WINDOW},}}") for c in CHARSETS]
_MARKS = [[re.compile(f"[{need}]") for need in c.needs] for c in CHARSETS]
#: n * log2(n) in units, for the times n that a character may be in a window.
_WEIGHT = [0, *[round(n * log2(n) * UNITS) for n in range(1, WINDOW + 1)]]


def random_windows(text: str, needs: list[re.Pattern], bits: float) -> Iterator[tuple[int, int]]:
    """Spans of the windows of `text` that have at least `bits` of entropy and a character of each kind in `needs`; windows
    that overlap or touch are one span. H = log2 W - (sum of n log2 n) / W, so H is high where the sum is low."""
    most = round((log2(WINDOW) - bits) * WINDOW * UNITS)
    kinds = {ch: tuple(k for k, need in enumerate(needs) if need.match(ch)) for ch in set(text)}
    counts, present, total, start, end = dict.fromkeys(kinds, 0), [0] * len(needs), 0, -1, -1
    for i, ch in enumerate(text):
        n = counts[ch]
        total += _WEIGHT[n + 1] - _WEIGHT[n]
        counts[ch] = n + 1
        for k in kinds[ch]:
            present[k] += 1
        if i < WINDOW - 1:
            continue
        at = i - WINDOW + 1
        if total <= most and all(present):
            if at > end >= 0:
                yield start, end
                start = at
            elif end < 0:
                start = at
            end = i + 1
        gone = text[at]
        n = counts[gone]
        total += _WEIGHT[n - 1] - _WEIGHT[n]
        counts[gone] = n - 1
        for k in kinds[gone]:
            present[k] -= 1
    if end >= 0:
        yield start, end


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every span, in order."""
    base = [(m.start(), k, m.end()) for k, (_, pattern, group, least) in enumerate(SHAPES)
            for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    extra = [(m.start() + a, len(SHAPES) + k, m.start() + b) for k, charset in enumerate(CHARSETS)
             for m in _RUNS[k].finditer(text) for a, b in random_windows(m.group(), _MARKS[k], charset.bits)]
    if extra:
        covers = sorted([(a, b) for a, _, b in base] + [m.span() for p in _ALLOWED for m in p.finditer(text)])
        reach, at, kept = -1, 0, []
        for a, k, b in sorted(extra):       # a cover that begins at or before a span holds it if it reaches its end
            while at < len(covers) and covers[at][0] <= a:
                reach, at = max(reach, covers[at][1]), at + 1
            if reach < b:
                kept.append((a, k, b))
        extra = kept
    return sorted(base + extra)


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def found_secrets(documents: DataFrame, columns: list[str]) -> DataFrame:
    """(row, spans): the asked-for columns of every document, and its spans by start and kind."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in text_blocks(batches):
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, kind)], names=["row", "spans"])

    rows = documents.select(F.struct(*columns).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(scan, T.StructType([rows.schema["row"], T.StructField("spans", SPANS)]))


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with every span of their texts replaced by its kind in brackets; spans that overlap become one."""
    columns = documents.columns

    def blacken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            out = []
            for text in batch.column("text").to_pylist():
                parts, done = [], 0
                for a, k, b in spans_of(text or ""):
                    if a >= done:
                        parts += [text[done:a], f"[{KINDS[k]}]"]
                    done = max(done, b)
                out.append(text and "".join(parts) + text[done:])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "text"])

    rows = documents.select(F.struct(*columns).alias("row"), "text")
    clean = rows.mapInArrow(blacken, T.StructType([rows.schema["row"], rows.schema["text"]]))
    return clean.select([F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns])


def listed(spans: Column) -> Column:
    """Spans as one text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
