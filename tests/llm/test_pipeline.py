"""The corpus pipeline, stage by stage."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tablens.llm import secrets, simhash
from tablens.llm.common import written

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(written(stage(spark, steps[-1], SMALL), "test-" + name.replace(" ", "-")))
        if stage is not corpus_pipeline.pack:
            assert steps[-1].columns == columns, name
    given, good, single, clean, mixed, packed = steps
    assert 0.5 * given.count() < good.count() < given.count()
    classes = {r.doc_id: r.component_id for r in simhash.simhash_classes(good).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(classes.values()))
    assert clean.count() == single.count()
    assert not any(secrets.base_spans(r.text) for r in clean.collect())
    assert all(len(r.text) == r.n_chars for r in clean.collect())
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= {r.doc_id for r in clean.collect()} and max(copies.values()) <= 2
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == copies
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_run_equals_the_stages(spark):
    a = corpus_pipeline.run(spark, SMALL).agg(F.count("*"), F.sum("length"), F.countDistinct("sequence_id")).first()
    b = corpus_pipeline.run(spark, SMALL).agg(F.count("*"), F.sum("length"), F.countDistinct("sequence_id")).first()
    assert tuple(a) == tuple(b) and a[0] > 0


def test_edge_rows_pass_all_stages(spark):
    rows = [(0, None, None, None, None, 1), (1, "", "en", "a", 0, 1), (2, "word " * 30000, "en", "a", 150000, 2), (3, "same text of some words", "en", None, 23, 3),
            (3, "same text of some words", "en", None, 23, 3), (3, "another text", "en", "b", 12, 3), (None, "no id here", "en", "b", 10, 4),
            (5, "token = 'abcdefghijklmnop' in here", "en", "b", 34, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, mix_size int")
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.redact, corpus_pipeline.mix_sources, corpus_pipeline.pack):
        assert stage(spark, docs, SMALL).count() > 0
        assert stage(spark, docs.limit(0), SMALL).count() == 0
    kept = corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect()
    # Unlike texts under one id are classes of their own.
    assert Counter(r.doc_id for r in kept) == Counter([None, 0, 2, 3, 3, 5]) and len(kept[0]) == 6
    assert sorted(r.text for r in kept if r.doc_id == 3) == ["another text", "same text of some words"]
    assert corpus_pipeline.keep_quality(spark, docs, SMALL).columns == docs.columns


def test_classes_without_ids_and_with_foreign_ids_keep_a_row(spark):
    texts = [" ".join(f"{w}{k}{i}" for i in range(30)) for k, w in enumerate(("alpha", "brown", "cedar", "delta", "eager"))]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[2]), (1, texts[3]), (3, texts[3]), (3, texts[4]), (9, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect()
    # Row (3, texts[3]) is a copy of document 1 and must not take the place of (3, texts[4]).
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(None, texts[0]), (None, texts[1]), (7, texts[2]), (1, texts[3]), (3, texts[4])])


def test_extra_columns_of_any_name_and_type_are_carried(spark):
    rows = [(i, f"text number {i} " + " ".join(f"w{i}{k}" for k in range(20)), "en", "a", 9, {"k": i}, i, float(i), f"c{i}", i, f"x{i}") for i in range(6)]
    rows += [(9, rows[0][1], "en", "b", 9, {"k": 9}, 9, 9.0, "c9", 9, "x9"), (0, rows[0][1], "en", "a", 9, {"k": -1}, -1, -1.0, "", -1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, tags map<string,int>, mix_size int, "
                                       "`_quality` double, `_class` string, extra_1 int, kept_fp string")
    for stage in (corpus_pipeline.keep_quality, corpus_pipeline.drop_near_copies, corpus_pipeline.redact, corpus_pipeline.mix_sources):
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns
        given = {str(r[5:]) for r in docs.collect()}
        assert all(str(tuple(r)[5:]) in given for r in (x for x in got.collect()))
    kept = corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect()
    assert sorted(r.doc_id for r in kept) == [0, 1, 2, 3, 4, 5]
    assert [r.tags for r in kept if r.doc_id == 0] == [{"k": -1}]
