"""The corpus pipeline: five stages over ``documents``, each calling one training-data operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and reread as the next stage's ``docs``. All but the last
return the columns of ``documents``. ``run`` applies them to the whole table.

Nulls and repeated rows: a null text is an empty one (rejected only if the classifier says so);
near-dedup keeps one row of each class, that with the least id (a null id last), then the least
content, also where unlike texts share an id; an empty table passes through as an empty table; extra columns
of ``docs``, of any type and name, are carried along unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablens.llm import mixing, packing, quality, secrets, simhash
from tablens.llm.common import fold_of, read_table, word_count, written
from tablens.llm.queries import tokenizer_file


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
READ = ("doc_id", "text", "source", "n_chars")


def carries_extras(stage: Stage) -> Stage:
    """Columns that no stage reads have plain names inside ``stage``, so that none clashes with its own."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = [c if c in READ else f"extra_{i}" for i, c in enumerate(docs.columns)]
        out = stage(spark, docs.toDF(*plain), sf_dir)
        return out.toDF(*docs.columns) if out.columns == plain else out

    return run


@carries_extras
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored under one half go."""
    labels = read_table(spark, sf_dir, "labels").where(fold_of("doc_id", 3) != 1)
    weights = quality.train(docs, labels, "quality")
    return quality.score(docs, weights, score_col="quality_score").where("quality_score >= 0.5").drop("quality_score")


@carries_extras
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each class stays, the one with the smallest id.

    A class is known by its fingerprints, not by its ids, which may be null or repeat: the least id of
    a class and the least fingerprint under which it occurs there name the rows of which one stays.
    """
    fps = written(simhash.fingerprints(docs), "fingerprints")
    least = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "fp")).alias("least")
    chosen = written(simhash.fp_classes(fps).groupBy("root").agg(least).select(F.col("least.fp").alias("kept_fp"), F.col("least.rep").alias("kept_id")), "chosen")
    same = lambda fp: (F.col(fp) == F.col("kept_fp")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    # Only rows that share a class' fingerprint and id are compared with one another.
    several = fps.join(chosen, same("fp")).groupBy("kept_fp").agg((F.count("*") > 1).alias("several"))
    chosen = written(chosen.join(several, "kept_fp"), "chosen")
    rows = simhash.with_fingerprints(docs, fp_col="own_fp").join(chosen, same("own_fp"))
    rows = written(rows.select(*docs.columns, "kept_fp", "several"), "candidates")
    every = F.struct(*docs.columns)
    first = rows.where("several").groupBy("kept_fp").agg(F.min_by(every, F.struct("text", F.to_json(every))).alias("kept"))
    return rows.where("not several").select(*docs.columns).unionByName(first.select("kept.*"))


@carries_extras
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every found secret is replaced by a mark; no document goes."""
    return secrets.redact_secrets(docs, n_chars_col="n_chars" if "n_chars" in docs.columns else None)


@carries_extras
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: every document as often (0 to 2 times) as the mix takes it."""
    mixed, _, _ = mixing.mix(docs, F.array("source"), word_count(F.col("text")), mixing.rotating_quotas)
    taken = mixed.where("mix_copies > 0")
    return taken.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all that is left into sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", drop_near_copies),
    ("secret scan", redact),
    ("source mixing", mix_sources),
    ("best-fit packing", pack),
]

#: The trained classifier, the fingerprints and the tokeniser can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; the packed pieces are returned."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
