"""Driver contract and the Spark-vs-DuckDB oracle on the smallest scale factor."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

OWN_NAME = re.compile(r"op\d+_|pipeline$")
HEAVY = {"summary_report_events", "elbow_choice_embeddings", "kmeans_embeddings", "elbow_curve_embeddings", "random_forest_imputed_lineitem",
         "random_forest_label_imputed_events"}


def test_entry_runs_in_a_fresh_process():
    """The driver may call entry() before queries(): run it in a new interpreter."""
    import subprocess
    code = ("import sys; sys.path.insert(0, %r); from pyspark.sql import SparkSession; "
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); "
            "import __spark_entry__ as E; print(len(E.entry(s).collect())); "
            "print(E.queries()['isolation_forest_events'](s, %r).count())") % (os.path.dirname(E.__file__), SF_SMALL)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, cwd="/")
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().splitlines()[-2:] == ["5", "1000"]


def test_library_works_without_the_training_data_folders(tmp_path):
    """Without both folders the queries that are left are listed, whether the pipeline's file is there or not."""
    import shutil
    import subprocess
    root = os.path.dirname(os.path.abspath(E.__file__))
    left = {n for n in E.queries() if not OWN_NAME.match(n)}
    for files in (["__spark_entry__.py", "corpus_pipeline.py"], ["__spark_entry__.py"]):
        copy = tmp_path / str(len(files))
        shutil.copytree(os.path.join(root, "tablens"), copy / "tablens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for f in files:
            if os.path.exists(os.path.join(root, f)):
                shutil.copy(os.path.join(root, f), copy)
        code = "import __spark_entry__ as E; print(','.join(sorted(E.queries()))); print(len(set(E.oracle_sql()) - set(E.queries())))"
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=copy,
                             env=os.environ | {"PYTHONPATH": str(copy)})
        assert out.returncode == 0, out.stderr[-2000:]
        names, odd = out.stdout.strip().splitlines()
        assert set(names.split(",")) == left and odd == "0"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and {"event_type", "outlier_count", "lower", "upper"} <= set(df.columns)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as make
    return make(SF_SMALL)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql())))
def test_oracle_matches(spark, duck, name):
    from oracle_check import compare
    r = compare(spark, duck, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["cols"] and r["values"] and r["rows"] == r["oracle_rows"] and not r.get("type_diff"), r


#: The training-data queries have tests of their own.
OWN = {n for n in E.queries() if OWN_NAME.match(n)}


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql()) - HEAVY - OWN))
def test_rows_only_queries_give_rows(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and not any(all(v is None for v in r) for r in rows)
