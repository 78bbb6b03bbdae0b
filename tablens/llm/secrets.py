"""Secret scans: pattern rules plus sliding-window Shannon entropy over candidate strings.

The pattern rules give the base spans. The entropy method looks at every maximal run of token
characters of at least SHORTEST characters; a window of WINDOW characters (of the run's own length,
if that is less) slides over it one character at a time
with incrementally kept counts, and its entropy is compared with the limit of its character
class. Consecutive hits merge into one span of kind ``entropy``. A host name, address or date at the
start of a run is passed over and what follows it is scanned as a run of its own. Allow-listed runs
(repeated or spelled-out placeholders, plain words and numbers) give none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbatch import cut, runs, slices, text_column

# The pattern rules (kind, pattern, group whose length counts, least length).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "entropy")

TOKEN = np.zeros(256, dtype=bool)
TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True

WINDOW, SHORTEST = 20, 12
#: Least entropy, in bits per character, of a window of WINDOW characters, by character class; a
#: shorter window's limit is less by the ratio of the most entropy the two lengths can have.
#: A window of only letters or only digits is never a secret on its own.
LIMITS = {"hex": 2.9, "upper": 3.3, "lower": 3.2, "mixed": 3.5}
HEXDIGITS = frozenset("0123456789abcdefABCDEF")

#: Host names, addresses and dates: suppressed themselves, but not what follows them in a run.
HEADS = (
    re.compile(r"(?:[A-Za-z0-9-]+\.)+(?:com|org|net|edu|gov|io|example|invalid|test|local)(?=[/.=-]|\Z)"),
    re.compile(r"[0-9]{1,4}(?:[-./][0-9]{1,4})+(?:T[0-9:.+-]*Z?(?![A-Za-z0-9])|\Z)"),
)
_JOIN = re.compile(r"[-_./=+]*")
#: Candidates that are suppressed.
ALLOW = (
    *HEADS,
    re.compile(r"(.{1,8}?)\1{2,}.{0,8}"),
    re.compile(r"[A-Za-z]+(?:[-_./=+][A-Za-z]+)*[-_./=+0-9]{0,6}"),
    # Words with numbers between them.
    re.compile(r"(?:[A-Za-z][a-z]*|[0-9]{1,4}(?:st|nd|rd|th|s)?)(?:[-_./=+]+(?:[A-Za-z][a-z]*|[0-9]{1,4}(?:st|nd|rd|th|s)?))*"),
    re.compile(r"[A-Fa-f0-9]{8}-(?:[A-Fa-f0-9]{4}-){3}[A-Fa-f0-9]{12}"),
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern rules in code points, leftmost and non-overlapping per kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return out


def _class(upper: int, lower: int, digit: int, hexa: int, size: int) -> str | None:
    if not digit or digit == size:
        return None
    if hexa == size:
        return "hex"
    if upper and not lower:
        return "upper"
    if upper:
        return "mixed"
    return "lower" if lower else None


def run_spans(run: str) -> list[tuple[int, int]]:
    """Merged (start, end) of the hits of a whole run behind its leading host names, addresses and dates."""
    at, last = 0, max(map(run.rfind, "0123456789"))
    while at <= last:
        head = next((m for p in HEADS if (m := p.match(run, at))), None)
        if not head:
            rest = run[at:]
            return [(at + s, at + e) for s, e in entropy_spans(rest, min(WINDOW, len(rest)))] if len(rest) >= SHORTEST else []
        at = _JOIN.match(run, head.end()).end()
    return []


def entropy_spans(candidate: str, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged (start, end) of the windows of a candidate whose entropy reaches its class's limit."""
    n = len(candidate)
    if n < window or any(p.fullmatch(candidate) for p in ALLOW):
        return []
    if any(p.match(candidate) for p in HEADS):
        return run_spans(candidate)
    least = {k: v * math.log2(window) / math.log2(WINDOW) for k, v in LIMITS.items()}
    weight = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0
    upper = lower = digit = hexa = 0
    out: list[tuple[int, int]] = []
    for i, c in enumerate(candidate):
        k = counts.get(c, 0)
        total += weight[k + 1] - weight[k]
        counts[c] = k + 1
        upper, lower, digit, hexa = upper + c.isupper(), lower + c.islower(), digit + c.isdigit(), hexa + (c in HEXDIGITS)
        if i >= window:
            old = candidate[i - window]
            k = counts[old]
            total += weight[k - 1] - weight[k]
            counts[old] = k - 1
            upper, lower, digit, hexa = (upper - old.isupper(), lower - old.islower(), digit - old.isdigit(),
                                         hexa - (old in HEXDIGITS))
        if i >= window - 1:
            kind = _class(upper, lower, digit, hexa, window)
            if kind and math.log2(window) - total / window >= least[kind]:
                at = i - window + 1
                if out and at <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((at, i + 1))
    return out


def _document(raw: bytes, found: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """All spans of one text, in code points; ``found``: its token runs of 12 bytes or more."""
    text = raw.decode()
    ascii_only = len(text) == len(raw)
    out: list[tuple[int, int, str]] = []
    if b":" in raw or b"=" in raw:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for a, b in found:
        run = raw[a:b].decode()
        at = a if ascii_only else len(raw[:a].decode())
        # Token runs are maximal, and the characters of both rules are token characters.
        out += [(at + m.start(), at + m.end(), "access") for m in ACCESS.finditer(run) if len(m[0]) >= LEAST["access"]]
        out += [(at + m.start(), at + m.end(), "hex") for m in HEX.finditer(run) if len(m[0]) >= LEAST["hex"]]
        out += [(at + s, at + e, "entropy") for s, e in run_spans(run)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


SPANS = "array<struct<kind:string,start:int,end:int>>"


def _batch_spans(batch: pa.RecordBatch, at: int) -> Iterator[list[tuple[int, int, str]]]:
    buf, offs = text_column(batch.column(at))
    for i, j in slices(offs):
        chunk, rel = cut(buf, offs, i, j)
        starts, ends = runs(TOKEN[chunk[:rel[-1]]], rel)
        long = ends - starts >= min(LEAST.values())
        starts, ends = starts[long], ends[long]
        first = np.searchsorted(starts, rel)
        for k in range(j - i):
            if first[k] == first[k + 1]:
                yield []
                continue
            a = int(rel[k])
            pairs = [(int(s) - a, int(e) - a) for s, e in zip(starts[first[k]:first[k + 1]], ends[first[k]:first[k + 1]], strict=True)]
            yield _document(chunk[a:rel[k + 1]].tobytes(), pairs)


def scan_secrets(docs: DataFrame, text_col: str = "text", spans_col: str = "secret_spans") -> DataFrame:
    """``docs`` with ``spans_col``: every span (kind, start, end) in code points, by start, then kind.

    All columns pass through; null and empty texts give an empty list, repeated rows each their
    own. A column of ``docs`` named ``spans_col`` is replaced. An empty table gives an empty
    result.
    """
    docs = docs.drop(spans_col)
    at = docs.columns.index(text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": s, "end": e} for s, e, k in x] for x in _batch_spans(batch, at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], names=[*batch.schema.names, spans_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{spans_col}` {SPANS}")


def _redact(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    out, at = [], 0
    for s, e in spans:
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], mark]
        at = e
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", n_chars_col: str | None = None) -> DataFrame:
    """``docs`` with each found span (overlapping ones as one) replaced by ``mark``; no row is dropped.

    ``n_chars_col``, if given, gets the new number of code points. Null texts stay null.
    """
    at, names = docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, spans in enumerate(_batch_spans(batch, at)):
                if spans:
                    texts[i] = _redact(texts[i], [(s, e) for s, e, _ in spans], mark)
            cols = [pa.array(texts, batch.schema.field(at).type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(n_chars_col, F.length(text_col).cast("long")) if n_chars_col else out


def span_text(col: str, kinds: tuple[str, ...] = KINDS):
    """``kind:start:end`` of a span list, comma-joined, in its order."""
    keep = F.filter(col, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(keep, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def base_digest(text: str | None) -> str:
    """The sha256 of one text's base spans, for tests."""
    found = sorted(base_spans(text or ""), key=lambda x: (x[0], KINDS.index(x[2])))
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in found).encode()).hexdigest()
