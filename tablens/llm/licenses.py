"""Licence scan: one Aho-Corasick pass for notice phrases and identifier tags, then a shunting-yard parser.

A text is lower-cased (A-Z) and read as words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. The automaton reads
the words joined by single blanks, every pattern with a blank on either side, so that it matches whole
words only and finds every place, overlaps included. Behind an identifier tag and ``:`` or ``=`` stands
an expression of identifiers, ``and``, ``or``, ``with`` and parentheses, which is parsed in the original
text (``with`` binds closest, ``or`` loosest) and evaluated: ``or`` permits if either side does,
``and`` if both do, ``with`` lets an exception permit.

An expression ends where no valid token follows; one with an operator or a parenthesis left open is
malformed and gives no label. Null and empty texts have no words and score 0; repeated rows are scanned
each; an empty table gives an empty result; other columns are not read, whatever their names. Texts of any
length are read whole, in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches

# The base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Further notice phrases, their labels and how much each speaks for a licence.
NOTICES = (
    ("permission is hereby granted free of charge", "mit", 0.9), ("licensed under the apache license", "apache", 0.9),
    ("redistribution and use in source and binary forms", "bsd", 0.9), ("bsd license", "bsd", 0.6), ("mozilla public license", "mpl", 0.8),
    ("eclipse public license", "epl", 0.8), ("gnu general public license", "gpl", 0.9), ("lesser general public license", "lgpl", 0.9),
    ("affero general public license", "agpl", 0.9), ("isc license", "isc", 0.6), ("boost software license", "boost", 0.8), ("zlib license", "zlib", 0.6),
    ("creative commons attribution", "cc-by", 0.8), ("cc by", "cc-by", 0.5), ("cc by nc", "cc-by-nc", 0.8), ("cc by sa", "cc-by-sa", 0.8),
    ("cc by nd", "cc-by-nd", 0.8), ("cc0", "cc0", 0.5), ("free and unencumbered software released into the public domain", "unlicense", 0.9),
    ("released into the public domain", "public-domain", 0.7), ("all rights reserved", "proprietary", 0.4),
)
BASE_WEIGHT, TAG_WEIGHT = 0.7, 0.95
# Words of the tags in front of an expression.
TAGS = ("spdx license identifier", "license expression", "license id")
# Beginnings of identifiers, the longest that fits counts; label; whether the licence is permissive.
IDENTIFIERS = (
    ("mit", "mit", True), ("apache", "apache", True), ("bsd", "bsd", True), ("isc", "isc", True), ("zlib", "zlib", True), ("bsl", "boost", True),
    ("unlicense", "unlicense", True), ("cc0", "cc0", True), ("cc-by", "cc-by", True), ("cc-by-nc", "cc-by-nc", False), ("cc-by-nd", "cc-by-nd", False),
    ("cc-by-sa", "cc-by-sa", False), ("gpl", "gpl", False), ("lgpl", "lgpl", False), ("agpl", "agpl", False), ("mpl", "mpl", False), ("epl", "epl", False),
)
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

_SPACES = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_ASSIGN = re.compile(rb"[\x20\t]*[:=][\x20\t]*[\"']?")
_TOKEN = re.compile(rb"[\x20\t]*([()]|[0-9a-z][0-9a-z.+-]*)")


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found: dict[str, list] = {}
    for phrase, label in BASE:
        found.setdefault(phrase, []).append(("base", label, BASE_WEIGHT))
    for phrase, label, weight in NOTICES:
        found.setdefault(phrase, []).append(("notice", label, weight))
    for phrase in TAGS:
        found.setdefault(phrase, []).append(("tag", "", 0.0))
    machine = ahocorasick.Automaton()
    for phrase, uses in found.items():
        machine.add_word(f" {phrase} ", (phrase.count(" ") + 1, uses))
    machine.make_automaton()
    return machine


def identify(name: str) -> tuple[str, bool]:
    """Label of an identifier (``other`` if it isn't known) and whether it permits."""
    best = max((x for x in IDENTIFIERS if name == x[0] or name.startswith((x[0] + "-", x[0] + "."))), key=lambda x: len(x[0]), default=None)
    return (best[1], best[2]) if best else ("other", False)


def parse(text: bytes, at: int = 0) -> list[str] | None:
    """The expression that begins at ``at``, in postfix order; None if there is none or it is malformed."""
    out: list[str] = []
    held: list[str] = []
    operand = True  # whether an identifier or "(" must follow
    while m := _TOKEN.match(text, at):
        token = m.group(1).decode()
        if token == "(":
            if not operand:
                break
            held.append(token)
        elif token == ")":
            if operand or "(" not in held:
                break
            while (top := held.pop()) != "(":
                out.append(top)
        elif token in PRECEDENCE:
            if operand:
                return None
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
            operand = True
        else:
            if not operand:
                break
            out.append(token.rstrip(".-"))
            operand = False
        at = m.end()
    if operand or "(" in held:
        return None
    return out + held[::-1]


def evaluate(postfix: list[str]) -> tuple[set[str], bool]:
    """The labels of an expression's licences and whether it leaves a permissive choice."""
    stack: list[tuple[set[str], bool]] = []
    for token in postfix:
        if token not in PRECEDENCE:
            label, free = identify(token)
            stack.append(({label}, free))
            continue
        b, a = stack.pop(), stack.pop()
        if token == "with":  # the right side names an exception, which is no licence
            stack.append((a[0], True))
        else:
            stack.append((a[0] | b[0], a[1] or b[1] if token == "or" else a[1] and b[1]))
    return stack[-1]


def scan_text(text: str) -> dict:
    """All that one text holds: words, places, expressions, labels and score."""
    raw = text.encode().lower()  # bytes: only A-Z change
    words = raw.translate(_SPACES).split()
    places, tags, weights = [], [], {}
    if words:
        joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
        at = word = 0
        for end, (size, uses) in automaton().iter(joined):
            word += joined.count(" ", at, end)  # blanks before the closing one: words up to here
            at = end
            for use, label, weight in uses:
                if use == "tag":
                    tags.append(word)
                    continue
                places.append((use, label, word - size, size, weight))
    # A notice inside a longer notice (cc by in cc by nc) doesn't count; base places always do.
    reach, kept = 0, []
    for place in sorted(places, key=lambda p: (p[2], -p[3])):
        if place[0] == "notice":
            if place[2] + place[3] <= reach:
                continue
            reach = place[2] + place[3]
        kept.append(place[:4])
        weights[place[1]] = max(weights.get(place[1], 0.0), place[4])
    places = kept
    expressions = []
    if tags:
        nth, ends = 0, iter(_WORD.finditer(raw))
        for last in tags:
            while nth < last:
                m, nth = next(ends), nth + 1
            found = _ASSIGN.match(raw, m.end())
            if not found:
                continue
            postfix = parse(raw, found.end())
            if postfix is None:
                expressions.append("malformed")
                continue
            labels, free = evaluate(postfix)
            expressions.append(f"{' '.join(postfix)} = {'permissive' if free else 'restrictive'}")
            for label in labels:
                weights[label] = max(weights.get(label, 0.0), TAG_WEIGHT)
    rest = 1.0
    for label in sorted(weights):
        rest *= 1 - weights[label]
    base = [p for p in places if p[0] == "base"]
    starts = [p[2] for p in base]
    return {"n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted({p[1] for p in base})), "labels": ",".join(sorted(weights)), "score": 1 - rest,
            "expressions": "; ".join(expressions), "places": [{"use": u, "label": n, "word": w, "words": s} for u, n, w, s in places]}


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions string, "
          "places array<struct<use:string,label:string,word:long,words:int>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and, for every row, words, base places, labels, score, evaluated expressions and all places."""
    bounded_batches(docs.sparkSession)
    place = pa.struct([("use", pa.string()), ("label", pa.string()), ("word", pa.int64()), ("words", pa.int32())])
    kinds = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
             ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.string()), ("places", pa.list_(place))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[n] for r in rows], t) for n, t in kinds]], names=[id_col, *[n for n, _ in kinds]])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")
