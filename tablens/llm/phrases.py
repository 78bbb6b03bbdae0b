"""Phrase collocation mining: n-gram counts by HAT-tries, then cohesion scores per language.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words
``[^\\x20\\x09]+``; a phrase is one to four neighbouring words of a piece. A phrase is counted in
every place, overlaps included, by a HAT-trie in each task (``hattrie.py``), whose sorted runs are
merged by Spark per prefix partition: a phrase's leading words decide its partition.

All parts of a phrase occur at least as often as it does, so words are counted first, then pairs of
frequent words, then triples and fours of frequent pairs, each exactly and by text. What is frequent is
told to the next pass by a Bloom filter of fixed size: it lets some rare phrases pass, which their
counts then drop, and never holds back a frequent one.

Null and empty texts have no words; a null language is ``und``; repeated rows count each; ties in
the score go by count, then phrase (UTF-8 bytes); an empty table gives an empty result; other
columns are not read. Texts of any length are read in slices of bounded size. Words are known to
a task by 64-bit hashes (about n²/2⁶⁵ collisions among its n distinct words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .hattrie import HatTrie, Run, word_at
from .textbatch import PAD, SLICE_BYTES, HashIndex, cut, hash_spans, mix, runs, slices, text_column

# The characters that end a piece, and those that end a word.
ENDS_PIECE = np.zeros(256, dtype=bool)
ENDS_PIECE[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 0x0A, 0x0B, 0x0C, 0x0D]] = True
ENDS_WORD = ENDS_PIECE.copy()
ENDS_WORD[[0x20, 0x09]] = True

MAX_WORDS = 4
BLOOM_BITS = 1 << 26
DICTIONARY = 1 << 20
PART_WORDS = 2_000_000
TOP_SALTS = 64
_A = np.uint64(0x9E3779B97F4A7C15)


def word_slices(buf: np.ndarray, offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(first document, end, chunk, offsets, context) of slices of about ``limit`` bytes.

    A longer document is cut behind a piece, or else behind a word; then the next slice begins
    with the last words again, ``context`` bytes in which no phrase may end.
    """
    for i, j in slices(offs, limit):
        if j > i + 1 or offs[j] - offs[i] <= limit:
            yield i, j, *cut(buf, offs, i, j, fold=True), 0
            continue
        at = begin = int(offs[i])
        stop = int(offs[j])
        while at < stop:
            end = min(at + limit, stop)
            clean = True
            if end < stop:
                pieces = np.flatnonzero(ENDS_PIECE[buf[at:end]])
                blanks = np.flatnonzero(ENDS_WORD[buf[at:end]])
                if len(pieces):
                    end = at + int(pieces[-1]) + 1
                elif len(blanks):
                    end, clean = at + int(blanks[-1]) + 1, False
                else:  # a word that is longer than a slice
                    rest = np.flatnonzero(ENDS_WORD[buf[end:stop]])
                    end, clean = end + int(rest[0]) if len(rest) else stop, False
            part = np.array([begin, end], dtype=np.int64)
            yield i, j, *cut(buf, part, 0, 1, fold=True), at - begin
            at = begin = end
            if not clean:
                first = int(part[0])
                starts, _ = runs(~ENDS_WORD[buf[first:end]], np.array([0, end - first]))
                begin = first + int(starts[1 - MAX_WORDS]) if len(starts) >= MAX_WORDS - 1 else first


def tokens(chunk: np.ndarray, offs: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, document and hash of all words, and whether the next word continues the piece."""
    n = int(offs[-1])
    starts, ends = runs(~ENDS_WORD[chunk[:n]], offs)
    doc = np.searchsorted(offs, starts, side="right") - 1
    piece = np.cumsum(ENDS_PIECE[chunk[:n]], dtype=np.int32)[starts]
    goes_on = np.zeros(len(starts), dtype=bool)
    goes_on[:-1] = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
    h = mix(hash_spans(chunk, starts, ends, 11) + salt[doc]) | np.uint64(1)
    return starts, ends, doc, h, goes_on


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring words, or of a pair and the next word."""
    return mix(first * _A + second) | np.uint64(1)


def language_salts(names: list[str]) -> np.ndarray:
    raw = "".join(names).encode()
    offs = np.cumsum([0, *[len(n.encode()) for n in names]])
    chunk = np.zeros(len(raw) + PAD, dtype=np.uint8)
    chunk[:len(raw)] = np.frombuffer(raw, np.uint8)
    return hash_spans(chunk, offs[:-1], offs[1:], 12)


class Bloom:
    """A fixed number of bits, two set for each hash."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
        return [mix(h ^ np.uint64(seed)) & np.uint64(bits - 1) for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), dtype=bool)
        for p in self.places(h, len(self.words) * 64):
            out &= (self.words[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def bloom_words(phrases: DataFrame, bits: int = BLOOM_BITS) -> np.ndarray:
    """The words of a filter of ``bits`` bits, whatever the corpus, over a table ``lang, phrase`` of words or pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(bits // 64, dtype=np.uint64)
        for batch in batches:
            lang, names = _languages(batch.column(0))
            buf, offs = text_column(batch.column(1))
            for i, j in slices(offs):
                chunk, cuts = cut(buf, offs, i, j)
                _, _, _, h, goes_on = tokens(chunk, cuts, language_salts(names)[lang[i:j]])
                # The last word's hash, joined with the one before it if there is one.
                joined = np.concatenate([[False], goes_on[:-1]])
                h = np.where(joined, pair_hash(np.roll(h, 1), h), h)[~goes_on]
                for p in Bloom.places(h, bits):
                    np.bitwise_or.at(found, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at].view(np.int64))], names=["at", "bits"])

    rows = phrases.select("lang", "phrase").mapInArrow(run, "at int, bits long").groupBy("at").agg(F.expr("bit_or(bits)").alias("bits"))
    got = rows.toArrow()  # at most bits / 64 rows
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[got["at"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return words


def _languages(col) -> tuple[np.ndarray, list[str]]:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    coded = col.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


class Words:
    """A task's word ids (from 1) with text, language and hash of each."""

    def __init__(self) -> None:
        self.index = HashIndex()
        self.texts: list[bytes] = []
        self.langs: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []

    def ids(self, chunk: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, lang: np.ndarray) -> np.ndarray:
        known = self.index.get(h)
        if (known < 0).any():
            new, at = np.unique(h[known < 0], return_index=True)
            at = np.flatnonzero(known < 0)[at]
            raw = chunk.tobytes()
            self.texts += [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            self.langs.append(lang[at])
            self.hashes.append(new)
            self.index.add(new)
            known = self.index.get(h)
        return known.astype(np.uint64) + np.uint64(1)

    def packed(self, found: list[Run], names: list[str], parts: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs as rows ``part, size, run``: for each prefix partition the run's words and phrases, packed."""
        if not found:
            return
        texts = np.array(self.texts, dtype=object)
        langs, hashes = np.concatenate(self.langs), np.concatenate(self.hashes)
        named = [n.encode() for n in names]
        for high, low, count in found:
            ids = np.stack([word_at(high, low, d).astype(np.int64) - 1 for d in range(MAX_WORDS)])
            size = (ids >= 0).sum(axis=0)
            rows: list[tuple[int, int, bytes]] = []
            for m in np.unique(size).tolist():
                at = np.flatnonzero(size == m)
                mine = ids[:m, at]
                # The leading words: one or two, or all but the last.
                prefix = hashes[mine[0]]
                for d in range(1, min(m, max(2, m - 1))):
                    prefix = pair_hash(prefix, hashes[mine[d]])
                part = (prefix >> np.uint64(8)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1))
                for i, j in zip(cuts, cuts[1:], strict=False):
                    sel = order[i:j]
                    used, local = np.unique(mine[:, sel], return_inverse=True)
                    shown = [named[x] + b" " + w for x, w in zip(langs[used].tolist(), texts[used].tolist(), strict=True)]
                    raw = b"".join([
                        np.array([m, len(sel), len(used)], "<u4").tobytes(), np.array([len(w) for w in shown], "<u4").tobytes(),
                        local.astype("<u4").tobytes(), count[at[sel]].astype("<i8").tobytes(), *shown])
                    rows.append((int(part[sel[0]]), len(raw), pa.compress(raw, codec="zstd", asbytes=True)))
            part, size, run = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(size, pa.int64()), pa.array(run, pa.binary())], names=["part", "size", "run"])


def unpack_run(raw: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """A packed run's words (language, blank, word), word numbers (a row per place in the phrase) and counts."""
    m, n, words = np.frombuffer(raw, "<u4", 3).tolist()
    at = 12
    offs = np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<u4", words, at), dtype=np.int64)])
    at += 4 * words
    ids = np.frombuffer(raw, "<u4", m * n, at).reshape(m, n)
    at += 4 * m * n
    count = np.frombuffer(raw, "<i8", n, at)
    texts = pa.Array.from_buffers(pa.large_binary(), words, [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(raw[at + 8 * n:])])
    return texts, ids, count


def merge_runs(table: pa.Table, least: int) -> pa.Table:
    """Merges the runs of a prefix partition: ``lang, words, phrase, c`` of the phrases that occur ``least`` times or more.

    Rows of no words hold the number of all words of a language there.
    """
    by_size: dict[int, list] = {}
    for size, run in zip(table["size"].to_pylist(), table["run"], strict=True):
        got = unpack_run(pa.decompress(run.as_buffer(), size, codec="zstd", asbytes=True))
        by_size.setdefault(len(got[1]), []).append(got)
    out = [pa.table({"lang": pa.array([], pa.string()), "words": pa.array([], pa.int32()), "phrase": pa.array([], pa.string()), "c": pa.array([], pa.int64())})]
    for m, found in by_size.items():
        words = pa.concat_arrays([f[0] for f in found]).dictionary_encode()
        number = words.indices.to_numpy()
        first = np.cumsum([0, *[len(f[0]) for f in found]])
        ids = np.concatenate([number[f[1].astype(np.int64) + k] for f, k in zip(found, first, strict=False)], axis=1)
        count = np.concatenate([f[2] for f in found])
        order = np.lexsort(ids[::-1])
        ids = ids[:, order]
        new = np.flatnonzero(np.concatenate([[True], (ids[:, 1:] != ids[:, :-1]).any(axis=0)]))
        total = np.add.reduceat(count[order], new)
        ids = ids[:, new]
        named = [w.rsplit(b" ", 1) for w in words.dictionary.to_pylist()]
        lang = pa.array([n[0].decode() for n in named], pa.string())
        text = pa.array([n[1].decode() for n in named], pa.string())
        if m == 1:
            sums = pa.table({"lang": lang.take(pa.array(ids[0])), "c": pa.array(total)}).group_by("lang").aggregate([("c", "sum")])
            out.append(pa.table({"lang": sums["lang"], "words": pa.array(np.zeros(len(sums), np.int32)), "phrase": pa.nulls(len(sums), pa.string()), "c": sums["c_sum"]}))
        keep = total >= least
        ids, total = ids[:, keep], total[keep]
        parts = [text.take(pa.array(x)) for x in ids]
        phrase = pc.binary_join_element_wise(*parts, " ") if m > 1 else parts[0]
        out.append(pa.table({"lang": lang.take(pa.array(ids[0])), "words": pa.array(np.full(len(total), m, np.int32)), "phrase": phrase, "c": pa.array(total)}))
    return pa.concat_tables(out)


def _occurrences(ids: np.ndarray, goes_on: np.ndarray, ready: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Packed phrases of ``sizes`` words in all places where ``goes_on`` joins a word with the next."""
    shift = np.uint64(32)
    begins = ids > 0
    for m in range(1, max(sizes) + 1):
        if m > 1:
            begins = begins[:-1] & goes_on[m - 2:-1] & (ids[m - 1:] > 0)
        if m not in sizes:
            continue
        at = np.flatnonzero(begins & ready[m - 1:])
        high = ids[at] << shift
        if m > 1:
            high |= ids[at + 1]
        low = ids[at + 2] << shift if m > 2 else np.zeros(len(at), np.uint64)
        if m > 3:
            low |= ids[at + 3]
        yield high, low


def count_phrases(docs: DataFrame, sizes: tuple[int, ...], least: int, parts: int, words: np.ndarray | None = None) -> DataFrame:
    """``lang, words, phrase, c``: exact counts of the phrases of ``sizes`` words that occur ``least`` times or more.

    ``docs`` has ``lang`` and ``text``. ``words`` is a filter that may hold back phrases: of two words by either word, of
    more by any pair of neighbours. Sizes are (1,), (2,) or (3, 4); with (1,) rows of no words hold the languages' totals.
    Runs are dealt over ``parts`` prefix partitions, each merged at once.
    """
    held = docs.sparkSession.sparkContext.broadcast(words) if words is not None else None  # BLOOM_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = Bloom(held.value) if held else None
        trie, known, names, code = HatTrie(), Words(), [], {}
        for batch in batches:
            lang, present = _languages(batch.column(0))
            for name in present:
                if name not in code:
                    code[name] = len(names)
                    names.append(name)
            lang = np.array([code[n] for n in present] or [0], dtype=np.int64)[lang]
            salt = language_salts(names)[lang] if names else np.zeros(0, np.uint64)
            buf, offs = text_column(batch.column(1))
            for i, j, chunk, cuts, context in word_slices(buf, offs):
                starts, ends, doc, h, goes_on = tokens(chunk, cuts, salt[i:j])
                if not len(h):
                    continue
                use = np.ones(len(h), dtype=bool)
                if allowed and sizes == (2,):
                    use = allowed.may_hold(h)
                elif allowed:
                    at = np.flatnonzero(goes_on)
                    goes_on[at] = allowed.may_hold(pair_hash(h[at], h[at + 1]))
                    use = goes_on.copy()
                    use[1:] |= goes_on[:-1]
                ids = np.zeros(len(h), dtype=np.uint64)
                ids[use] = known.ids(chunk, starts[use], ends[use], h[use], lang[i:j][doc[use]])
                for high, low in _occurrences(ids, goes_on, starts >= context, sizes):
                    yield from known.packed(trie.add(high, low), names, parts)
                if known.index.size > DICTIONARY:
                    yield from known.packed(trie.drain(), names, parts)
                    known = Words()
        yield from known.packed(trie.drain(), names, parts)

    runs_ = docs.select("lang", "text").mapInArrow(run, "part int, size long, run binary")
    return runs_.groupBy("part").applyInArrow(lambda t: merge_runs(t, least), "lang string, words int, phrase string, c long")


def _join(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, contained_percent: int = 80,
                 top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two to four words of each language.

    A phrase occurs ``a >= min_count`` times; ``score`` is floor(2000000 a / (l + r)) for the cut into a first part (``l``
    times) and a rest (``r`` times) that makes it least, the shortest first part among equals. Phrases inside a longer one
    that occurs at least ``contained_percent`` as often go; ``n`` is the number of all words of the language.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = written(count_phrases(texts, (1,), min_count, parts), "phrase-words")
    total = words.where("words = 0").groupBy("lang").agg(F.sum("c").alias("n"))
    words = words.where("words = 1")
    # There are no more phrases in a partition's runs than words in the corpus over the number of partitions.
    parts = max(parts, (total.agg(F.sum("n")).first()[0] or 0) // PART_WORDS)
    pairs = written(count_phrases(texts, (2,), min_count, parts, bloom_words(words)), "phrase-pairs")
    longer = written(count_phrases(texts, (3, 4), min_count, parts, bloom_words(pairs)), "phrase-longer")
    return rank_collocations(words.unionByName(pairs).unionByName(longer), total, contained_percent, top)


def rank_collocations(known: DataFrame, total: DataFrame, contained_percent: int, top: int) -> DataFrame:
    """Cuts, containment and ranks of a table ``lang, words, phrase, c`` that holds every part of its phrases."""
    phrases = known.where("words > 1").withColumn("w", F.split("phrase", " ", -1))
    cuts = phrases.select("lang", "phrase", F.col("c").alias("a"), "w", "words", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.withColumns({"first": _join(F.col("w"), F.lit(1), F.col("k")), "rest": _join(F.col("w"), F.col("k") + 1, F.col("words") - F.col("k"))})
    part = lambda name, n: known.select("lang", F.col("phrase").alias(name), F.col("c").alias(n))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    # Decimals: the product may pass 64 bits.
    score = F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = (known.where("words > 2").withColumn("w", F.split("phrase", " ", -1))
             .select("lang", "c", "w", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
             .select("lang", "c", "w", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at"))
             .select("lang", _join(F.col("w"), F.col("at"), F.col("size")).alias("phrase"), "c")
             .groupBy("lang", "phrase").agg(F.max("c").alias("longer")))
    inside = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {int(contained_percent)}")
    left = best.join(inner, ["lang", "phrase"], "left").where(~F.coalesce(inside, F.lit(False)))
    left = left.select("lang", "phrase", "a", "cut.*", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS)).alias("salt"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's best are among the best of its salted shares, so that no window takes a whole language.
    share = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = share.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
