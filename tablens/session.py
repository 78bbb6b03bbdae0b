"""Session helpers: one place for the settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. Oracles compare wall-clock timestamps, so the
# session time zone is pinned; AQE re-plans shuffles (coalescing, skew joins).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tablens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library's settings applied."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Runtime-settable options also applied to an already running session.
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, DEFAULT_CONF[k])
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; without it
    RuntimeError is raised there, since a folder of the driver's machine is no place for
    checkpoints. Only in local mode (tests) a private folder is created where it is unset.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="tablens-ckpt-")
    if sc.getCheckpointDir() is None:
        if d.startswith("/"):
            os.makedirs(d, exist_ok=True)
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss).

    Used for small intermediate tables that are read more than once (bounds,
    brackets, fitted statistics) so they are computed exactly once.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tablens`` importable in Python workers (``applyInPandas`` / ``mapInPandas``).

    The package is zipped once per application and added with ``addPyFile``, which
    Spark distributes to every executor (the same mechanism as ``--py-files``).
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="tablens-pyfiles-"), "tablens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


# Row limit under which a fitted table is pulled into a local relation (one bounded job)
# instead of being checkpointed (a write plus a read-back).
LOCAL_FITTED_ROWS = 10_000


def compact(df: DataFrame, max_rows: int = LOCAL_FITTED_ROWS) -> tuple[DataFrame, int]:
    """Materialise a fitted table once; returns ``(table, rows)``.

    At most ``max_rows`` rows (checked with a ``limit`` job) become a local relation;
    anything larger is cut with a reliable checkpoint and counted.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return df.sparkSession.createDataFrame(rows, df.schema), len(rows)
    out = materialize(df)
    return out, out.count()
