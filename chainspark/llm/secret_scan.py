"""Secrets in texts: three fixed patterns, and strings of high entropy.

Patterns: `assign` (a keyword, then a value of 12 characters or more), `access` (AKIA, 18 or more)
and `hex` (16 or more). Matches are leftmost and non-overlapping for each kind.

Entropy: candidates are runs of `[A-Za-z0-9+/_=-]` of `MIN_RUN` characters or more. A run belongs
to the narrowest class that holds it (hex, alphanumeric, base64), each with a window, a threshold
in bits, and a set of character groups it has to mix. The window slides over the run; its Shannon
entropy is kept up to date from the counts of the character that leaves and the one that enters,
as log2 w - (sum c log2 c) / w. The run is a secret where a window reaches the threshold. Runs on the
allow-list (UUIDs, dates, paths, dotted names, words joined by - or _, one character repeated) are
passed over, and so is a run that patterns already cover wholly. Of a run that they cover in part,
the whole is looked at, and where that is no secret, each rest of `MIN_RUN` characters or more.
Entropy spans come beside the patterns' spans and never remove them.

Edge cases: null text is empty, no spans; repeated rows each give a row; an empty table gives no
rows; null doc_id is kept; extra columns are ignored. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import schema_of, tuned

KINDS = ("assign", "access", "hex", "entropy")
_KEY = "|".join(("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)) for w in ("password", "passwd", "secret", "token", "api_?key"))
ASSIGN = re.compile(rf"""({_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{16,}")
RUN = re.compile("[A-Za-z0-9+/_=-]{20,}")
MIN_RUN = 20
#: class: (characters, window, bits that a window has to reach)
CLASSES = {
    "hex": (re.compile("[0-9a-fA-F]+"), 20, 3.0),
    "alphanumeric": (re.compile("[A-Za-z0-9]+"), 20, 3.55),
    "base64": (re.compile("[A-Za-z0-9+/_=-]+"), 20, 3.65),
}
ALLOW = re.compile(
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"  # UUID
    r"|\d{4}-\d\d-\d\d[T_-]?[\d_-]*"  # dates
    r"|[/_=+-]+"  # rules of signs
    r"|/?(?:[A-Za-z][a-z]*[/_-])+[A-Za-z]?[a-z]*/?"  # paths and joined words
    r"|(.)\1+"  # one character
    r"|\d+(?:[-/]\d+)*"  # numbers
)
_SUM = [0.0] + [c * math.log2(c) for c in range(1, 65)]
_WORDS = ("password", "passwd", "secret", "token", "api")


def peak_entropy(run: str, window: int) -> float:
    """The largest Shannon entropy, in bits, of any window of the run, by incremental counts."""
    w = min(window, len(run))
    counts: dict[str, int] = {}
    total = 0.0
    best = 0.0
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        total += _SUM[n + 1] - _SUM[n]
        counts[c] = n + 1
        if i >= w:
            old = run[i - w]
            n = counts[old]
            total += _SUM[n - 1] - _SUM[n]
            counts[old] = n - 1
        if i >= w - 1:
            best = max(best, math.log2(w) - total / w)
    return best


def mixed(run: str) -> bool:
    """Digits and letters, or both cases in the inside: prose and names aren't."""
    digits = sum(c.isdigit() for c in run)
    if digits >= 2 and digits < len(run):
        return True
    inner = run[1:]
    return any(c.isupper() for c in inner) and any(c.islower() for c in inner)


def high_entropy(run: str) -> bool:
    if ALLOW.fullmatch(run) or not mixed(run):
        return False
    for chars, window, bits in CLASSES.values():
        if chars.fullmatch(run):
            return peak_entropy(run, window) >= bits
    return False


def uncovered(runs: list[tuple[int, int]], spans: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, what the spans leave of it) for ascending disjoint runs and spans sorted by start: one pass over both."""
    merged: list[tuple[int, int]] = []
    for a, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    k = 0
    for start, end in runs:
        while k < len(merged) and merged[k][1] <= start:
            k += 1
        rest, at, j = [], start, k
        while j < len(merged) and merged[j][0] < end:
            if merged[j][0] > at:
                rest.append((at, merged[j][0]))
            at = max(at, merged[j][1])
            j += 1
        yield start, end, [*rest, (at, end)] if at < end else rest


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start, then by kind as listed in KINDS."""
    spans: list[tuple[int, int, str]] = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    runs = [m.span() for m in RUN.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for s, e, rest in uncovered(runs, sorted((a, b) for a, b, _ in spans)):
        if rest and high_entropy(text[s:e]):
            spans.append((s, e, "entropy"))
        elif rest != [(s, e)]:
            spans += [(a, b, "entropy") for a, b in rest if b - a >= MIN_RUN and high_entropy(text[a:b])]
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) of every row: no shuffle."""
    tuned(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in find(t or "")] for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema_of(f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,end:bigint>>"))


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span replaced; overlapping spans count as one."""
    out, at = [], 0
    for s, e, _ in find(text):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]]) if at else text


def redact(documents: DataFrame) -> DataFrame:
    """`documents` with secrets in column text replaced and n_chars following it, all other columns as they are."""
    tuned(documents.sparkSession)
    out = documents.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column("text").to_pylist()
            new = [None if t is None else redacted(t) for t in old]
            cols = dict(zip(b.schema.names, b.columns, strict=True))
            cols["text"] = pa.array(new, pa.string())
            if "n_chars" in cols:
                was = cols["n_chars"].to_pylist()
                cols["n_chars"] = pa.array([n if a is None or a == t else len(t) for n, a, t in zip(was, old, new, strict=True)], cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return documents.mapInArrow(run, out)


def digests(spans: list[tuple[int, int, str]]) -> tuple[int, int, int, str, str]:
    """(n_assign, n_access, n_hex, base_sha256, spans) of a text's spans."""
    base = [x for x in spans if x[2] != "entropy"]
    n = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
    return (*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


def report(documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans string): `scan` in one line a row, in the same pass."""
    tuned(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = list(zip(*[digests(find(t or "")) for t in b.column("text").to_pylist()], strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, pa.int64()) for c in got[:3]], *[pa.array(c, pa.string()) for c in got[3:]]], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema_of(f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"))
