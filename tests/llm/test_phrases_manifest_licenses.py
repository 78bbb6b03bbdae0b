"""Phrase mining, Merkle manifest and licence scan against brute force and edge rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablens.llm import hattrie, licenses, manifest, phrases
from tablens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute_phrases(rows, least, percent, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] = f.get((lang, tuple(w[i:i + m])), 0) + 1
    out = []
    many = {k: c for k, c in f.items() if c >= least}
    for lang in n:
        found = []
        for (g, p), a in many.items():
            if g != lang or len(p) < 2:
                continue
            if any(h == lang and len(q) > len(p) and 100 * c >= percent * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for (h, q), c in many.items()):
                continue
            score, k = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (s, a, p, lft, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, lft, r, n[lang], -s))
    return sorted(out)


def random_text(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", " ! "]) for _ in range(n))


def test_collocations_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["the", "The", "a", "straße", "x y", "漢字", "cat", "'s", "d-e", "x/y", "q\x1cz"]
    rows = [(rng.choice(["en", "de", None, "und", ""]), random_text(rng, words, rng.randrange(60))) for _ in range(150)]
    rows += [("en", None), (None, None), ("fr", ""), ("fr", " \t\n.,;"), ("en", "the cat the cat the cat " * 200), ("fr", "one"), ("en", rows[0][1]), ("en", rows[0][1])]
    df = spark.createDataFrame([(lg, t, 1, "z") for lg, t in rows], "lang string, text string, c long, phrase string").repartition(5)
    got = phrases.collocations(df, min_count=5, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_phrases(rows, 5, 80, 40)
    assert phrases.collocations(df.limit(0), min_count=5).collect() == []


def test_collocations_of_sliced_texts_equal_brute_force(spark, monkeypatch):
    """Long texts are cut behind pieces, or behind words with the last words again."""
    rng = random.Random(4)
    texts = [random_text(rng, ["a", "b", "cc", "dd"], 400), " ".join(rng.choice(["a", "b", "long" * 30]) for _ in range(300)), "w" * 900 + " a b " * 30]
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        for limit in (64, 200, 1 << 20):
            counted = Counter()
            for i, j, chunk, offs, context in phrases.word_slices(raw, np.array([0, len(raw)]), limit):
                s, e, _, _, goes_on = phrases.tokens(chunk, offs, np.zeros(j - i, np.uint64))
                w = [chunk[a:b].tobytes() for a, b in zip(s, e, strict=True)]
                for m in range(1, 5):
                    for k in range(len(w) - m + 1):
                        if goes_on[k:k + m - 1].all() and s[k + m - 1] >= context:
                            counted[b" ".join(w[k:k + m])] += 1
            want = Counter()
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
                w = re.findall(r"[^\x20\x09]+", piece)
                for m in range(1, 5):
                    want.update(" ".join(w[i:i + m]).encode() for i in range(len(w) - m + 1))
            assert counted == want, limit


@pytest.mark.parametrize("room", [200, 5000, 1 << 20])
def test_hat_trie_counts_and_spills_sorted_runs(monkeypatch, room):
    monkeypatch.setattr(hattrie, "BURST", 32)
    rng = np.random.default_rng(5)
    trie, want, got = hattrie.HatTrie(room), Counter(), Counter()
    runs = []
    for _ in range(30):
        ids = np.minimum(rng.geometric(0.05, (300, 4)), 200).astype(np.uint64)
        ids[np.arange(4) >= rng.integers(1, 5, (300, 1))] = 0
        high, low = ids[:, 0] << np.uint64(32) | ids[:, 1], ids[:, 2] << np.uint64(32) | ids[:, 3]
        want.update(zip(high.tolist(), low.tolist(), strict=True))
        runs += trie.add(high, low)
        assert trie.root.size <= room
    deep = any(isinstance(c, hattrie.Node) for c in trie.root.children)
    assert deep or room < 5000
    for high, low, count in runs + trie.drain():
        keys = list(zip(high.tolist(), low.tolist(), strict=True))
        assert keys == sorted(set(keys))
        for k, c in zip(keys, count.tolist(), strict=True):
            got[k] += c
    assert got == want and trie.root.size == 0
    assert (len(runs) > 0) == (room < 1 << 20)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000_000_001
    known = spark.createDataFrame([("en", 1, "a", big + 3), ("en", 1, "b", big + 8), ("en", 2, "a b", big)], "lang string, words int, phrase string, c long")
    total = spark.createDataFrame([("en", 9)], "lang string, n long")
    row = phrases.rank_collocations(known, total, 80, 10).first()
    assert row.score == 2000000 * big // (2 * big + 11) and (row.l, row.r) == (big + 3, big + 8)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """rows: (doc_id, text, lang, source, n_chars); sources and ids ascend, null first."""
    def leaf(doc, text, lang, source, n):
        return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc, source, lang, n, text)])

    first = lambda x: (x is not None, x.encode() if isinstance(x, str) else x if x is not None else 0)
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r[0], leaf(*r), r))
    out = []

    def levels(nodes):
        all_levels = [nodes]
        while len(nodes) > 1:
            nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
            all_levels.append(nodes)
        return all_levels

    sources = sorted(by_source, key=first)
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda x: (first(x[0]), x[1]))
        trees[s] = levels([x[1] for x in by_source[s]])
    top = levels([trees[s][-1][0] for s in sources])

    def climb(tree, i, digest):
        sibs = []
        for nodes in tree[:-1]:
            lo = i - i % 3
            run = nodes[lo:lo + 3]
            sibs += run[:i - lo] + run[i - lo + 1:]
            digest = h(*run[:i - lo], digest, *run[i - lo + 1:])
            i //= 3
        return digest, sibs

    for k, s in enumerate(sources):
        for i, (doc, lf, r) in enumerate(by_source[s]):
            bad = doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 and r[1] is not None
            start = leaf(doc, r[1].replace("\n", ""), *r[2:]) if bad else lf
            d, a = climb(trees[s], i, start)
            d, b = climb(top, k, d)
            out.append((doc, lf, trees[s][-1][0], top[-1][0], h(*a, *b), d, d == top[-1][0]))
    return sorted(out, key=str)


def run_op12(spark, df, monkeypatch, height=6):
    from functools import partial

    from tablens.llm import queries

    monkeypatch.setattr(queries, "read_table", lambda *a: df)
    monkeypatch.setattr(queries.manifest, "verify", partial(manifest.verify, height=height))
    return sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, "").collect()), key=str)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_brute_force(spark, monkeypatch, height):
    """Builders of 3 and 9 leaves make several tiers, also over the sources."""
    rng = random.Random(height)
    rows = [(i, rng.choice(["a\nb", "c", "\n", "", None, "é\n漢"]) , rng.choice(["en", None]), rng.choice(["s1", "s1", "s1", None, "", "ÿ", "lone" + str(i % 13)]),
             rng.choice([3, None])) for i in range(140)]
    rows += [(7, "x\n", "en", "s1", 1), (7, "x\n", "en", "s1", 1), (7, "y", "en", "s1", 1), (None, "n\n", None, None, None), (None, "n\n", None, "solo", None), (9, "long\n" * 50000, "en", "s1", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("tree", F.lit("clash")).withColumn("index", F.lit(1))
    assert run_op12(spark, df.repartition(4), monkeypatch, height) == brute_manifest(rows)


def test_manifest_of_few_rows(spark, monkeypatch):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    assert run_op12(spark, spark.createDataFrame([], schema), monkeypatch) == []
    for rows in ([(2, "a\nb", "en", "s", 3)], [(2, "a", "en", "s", 3), (1, None, None, None, None)]):
        assert run_op12(spark, spark.createDataFrame(rows, schema), monkeypatch) == brute_manifest(rows)


def test_log_positions_in_closed_form():
    for n in (1, 2, 3, 4, 9, 10, 26, 27, 28, 80):
        for height in {manifest.height_of(n), manifest.height_of(n) + 1, 5}:
            leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
            log, nodes = manifest.build_log(leaves, height), leaves
            for level in range(height + 1):
                assert [log[manifest.log_position(level, i, n, height)] for i in range(len(nodes))] == nodes
                nodes = [manifest.node_hash(nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
            assert len(log) == 1 + manifest.log_position(height, 0, n, height)
            packed = b"".join(log)
            path = [manifest.siblings(packed, i, n, height) for i in range(n)]
            assert all(manifest.fold(x, p) == log[-1] for x, p in zip(leaves, path, strict=True))
            assert all(manifest.unpack_path(manifest.pack_path(p)) == p for p in path)


BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))
    hits = [(i, BASE[p]) for p in BASE for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in hits]
    return len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


EDGE = [None, "", " \n\t--", "MIT", "the MIT License, the Apache-License and GNU General Public License", "mit licenses mit license mit license apache license",
        "MIT\nLicense MIT License mitlicense general public public license GENERAL*PUBLIC_LICENSE", "é mit licensé ſ mit  license", "x" * 100000 + " mit license " * 5000,
        "SPDX-License-Identifier: MIT OR (Apache-2.0 AND GPL-2.0-only WITH Classpath-exception-2.0)\nnext", "spdx license identifier without colon MIT"]


def test_licenses_base_equals_brute_force(spark):
    rng = random.Random(6)
    pool = ["mit", "license", "apache", "general", "public", "License", "x", "gnu", "lesser", "cc", "by", "all", "rights", "reserved"]
    texts = EDGE + ["".join(rng.choice(pool) + rng.choice([" ", "-", "\n", "_", ". ", "\x7f", "é"]) for _ in range(rng.randrange(80))) for _ in range(200)]
    rows = [(i, t, 1, "s") for i, t in enumerate(texts)] + [(None, "mit license", 1, "s"), (3, "MIT", 1, "s"), (3, "MIT", 1, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, labels string")
    got = licenses.scan(df).collect()
    want = [(r[0], *brute_base(r[1])) for r in rows]
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert (r.score > 0) == (r.labels != "") and r.labels == ",".join(sorted(set(r.labels.split(","))))
    assert licenses.scan(df.limit(0)).collect() == []


def test_notice_places_equal_a_plain_search():
    rng = random.Random(8)
    phrases_of = [p for p, _, _ in licenses.NOTICES]
    for _ in range(100):
        text = " ".join(rng.choice(phrases_of + ["gnu", "by", "license the"]) for _ in range(12))
        words = text.split()
        spans = [(i, i + len(p.split()), label) for p, label, _ in licenses.NOTICES for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        want = sorted((a, label) for a, b, label in spans if not any(c <= a and b <= d and d - c > b - a for c, d, _ in spans))
        assert sorted((x["word"], x["label"]) for x in licenses.scan_text(text)["places"] if x["use"] == "notice") == want


@pytest.mark.parametrize("text, postfix, labels, free", [
    ("mit", ["mit"], {"mit"}, True),
    ("mit or gpl-3.0-only and bsd-3-clause", ["mit", "gpl-3.0-only", "bsd-3-clause", "and", "or"], {"mit", "gpl", "bsd"}, True),
    ("(mit or gpl-3.0-only) and lgpl-2.1", ["mit", "gpl-3.0-only", "or", "lgpl-2.1", "and"], {"mit", "gpl", "lgpl"}, False),
    ("gpl-2.0 with classpath-exception-2.0 and apache-2.0", ["gpl-2.0", "classpath-exception-2.0", "with", "apache-2.0", "and"], {"gpl", "apache"}, True),
    ("cc-by-nc-4.0. more words", ["cc-by-nc-4.0"], {"cc-by-nc"}, False),
    ("((mit)) */", ["mit"], {"mit"}, True),
    ("licenseref-own", ["licenseref-own"], {"other"}, False),
    ("mit or", None, None, None), ("(mit or bsd", None, None, None), ("or mit", None, None, None), (") mit", None, None, None), ("", None, None, None),
])
def test_expressions(text, postfix, labels, free):
    got = licenses.parse(text.encode())
    assert got == postfix
    if postfix:
        assert licenses.evaluate(got) == (labels, free)
        found = licenses.scan_text("// SPDX-License-Identifier: " + text.upper())
        assert set(found["labels"].split(",")) == labels and found["expressions"].endswith("permissive" if free else "restrictive")


def test_queries_take_whole_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op13_license_scan"](spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(d.text)
    rows = sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, SMALL).collect()), key=str)
    assert rows == brute_manifest([(d.doc_id, d.text, d.lang, d.source, d.n_chars) for d in docs])
    assert any(not r[-1] for r in rows) and any(r[-1] for r in rows)
