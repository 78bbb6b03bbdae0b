"""Substring dedup by line or paragraph hashing.

Each text is cut into lines (or paragraphs, at blank lines); since a repeated passage seldom
begins and ends with a line, the unit ``sentence`` also cuts lines behind the marks that end a
sentence; ``all`` takes paragraphs, lines and sentences beside one another. A unit is normalised (A-Z
lower-cased, runs of white space as one space, none at the ends) and hashed to 128 bits.
Digests are grouped over the whole table, each kind of unit by itself; of every repeated unit the
occurrence with the least (id, offset) stays and all others are removed with the line break after
them. The removed ranges are kept as offsets into the original text; with ``all`` their union goes.
An occurrence that stays for one kind may lie in a larger unit that is removed: its words then
stay where that larger unit does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Shorter units repeat by chance in unrelated texts and stay.
MIN_WORDS = 6
#: The units of ``all``, the larger first; whole paragraphs and lines have no least length in it.
UNITS = ("paragraph", "line", "sentence")
_FLUSH = 1 << 16
BREAKS = {"line": re.compile(r"\n"), "sentence": re.compile(r"[.!?]+[\x20\x09-\x0D]+|\n"), "paragraph": re.compile(r"\n(?:[\x20\x09\x0B-\x0D]*\n)+")}


def units(text: str, unit: str = "line") -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, end with the break, lower-cased words) of each unit of a text, in code points.

    ``bytes`` lower-case A-Z and split at the white space \\x20 and \\x09-\\x0D alone.
    """
    at = 0
    for m in BREAKS[unit].finditer(text):
        yield at, m.end(), text[at:m.end()].encode().lower().split()
        at = m.end()
    if at < len(text):
        yield at, len(text), text[at:].encode().lower().split()


def _kinds(unit: str, min_words: int) -> dict[str, int]:
    """The kinds of units to take and the least words of each."""
    return {u: min_words if u == "sentence" else 1 for u in UNITS} if unit == "all" else {unit: max(1, min_words)}


def unit_table(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, unit, start, end, digest`` of every unit of at least ``min_words`` words; ``unit`` is its place in UNITS.

    Of ``all``, ``min_words`` holds for the sentences.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    kinds = _kinds(unit, min_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, nth, start, end, digest = [], [], [], [], []

            def made(ids: pa.Array) -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays([ids.take(pa.array(row, pa.int64())), pa.array(nth, pa.int8()), pa.array(start, pa.int64()),
                                                  pa.array(end, pa.int64()), pa.array(digest, pa.binary())], names=["id", "unit", "start", "end", "digest"])
                for x in (row, nth, start, end, digest):
                    x.clear()
                return out

            for i, text in enumerate(batch.column(1).to_pylist()):
                for u, least in kinds.items():
                    k = UNITS.index(u)
                    for a, b, words in units(text or "", u):
                        if len(words) >= max(1, least):
                            row.append(i)
                            nth.append(k)
                            start.append(a)
                            end.append(b)
                            # Seeded, so that equal words of different kinds don't meet.
                            digest.append(xxhash.xxh3_128_digest(b" ".join(words), k))
                if len(row) >= _FLUSH:
                    yield made(batch.column(0))
            yield made(batch.column(0))

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, unit byte, start long, end long, digest binary")


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, unit, start, end, kept_id, kept_start``: every unit to remove, in offsets of the original text, and the one that stays."""
    found = unit_table(docs, unit, min_words, id_col, text_col)
    # The least occurrence by (id, start), null ids last; pre-aggregated before the shuffle.
    order = F.struct(F.col("id").isNull().alias("none"), "id", "start")
    first = found.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    # Written, so that the join deals both sides itself and AQE can split the rows of a very common line.
    first = written(first, "repeated-units")
    return found.join(first, "digest").where(order != F.col("first")).select(
        "id", F.element_at(F.array(*[F.lit(u) for u in UNITS]), F.col("unit") + 1).alias("unit"), "start", "end", F.col("first.id").alias("kept_id"), F.col("first.start").alias("kept_start"))


def removed_ranges(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ranges``: the (start, end) ranges to remove, in order, for each document that has any; those of ``all`` may overlap."""
    again = repeated_units(docs, unit, min_words, id_col, text_col)
    return again.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("ranges"))


def _union(spans: list[dict]) -> list[dict]:
    """Sorted ranges with overlapping ones as one; ranges that only touch stay apart."""
    out: list[dict] = []
    for s in spans:
        if out and s["start"] < out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], s["end"])}
        else:
            out.append(s)
    return out


def drop_repeats(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated units removed from ``text_col`` and ``removed``: their (start, end) ranges,
    overlapping ones as one.

    Every row stays, if need be with an empty text. Null texts stay null and have no units; rows
    that share an id are one document: equal units at equal offsets of them stay or go together.
    A column named ``removed`` is replaced; an empty table gives an empty result.
    """
    docs = docs.drop("removed")
    ranges = removed_ranges(docs, unit, min_words, id_col, text_col).select(F.col("id").alias("_removed_id"), F.col("ranges").alias("removed"))
    joined = docs.join(ranges, F.col(id_col).eqNullSafe(F.col("_removed_id")), "left").drop("_removed_id")
    at, last = joined.columns.index(text_col), len(joined.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(last).to_pylist()
            for i, found in enumerate(spans):
                if found and texts[i] is not None:
                    # Rows that share an id may be of different lengths: a range beyond the text is another row's.
                    own = {(a, b) for u in _kinds(unit, min_words) for a, b, _ in units(texts[i], u)}
                    spans[i] = _union([s for s in found if (s["start"], s["end"]) in own])
                    out, end = [], 0
                    for s in spans[i]:
                        out.append(texts[i][end:s["start"]])
                        end = s["end"]
                    texts[i] = "".join([*out, texts[i][end:]])
                else:
                    spans[i] = []
            cols = [*batch.columns]
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            cols[last] = pa.array(spans, batch.schema.field(last).type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return joined.mapInArrow(run, joined.schema)
