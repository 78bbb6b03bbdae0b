"""tablens — tabular profiling, data-quality, outlier and pattern operators on Spark.

Every operator takes DataFrames plus column names and returns a tidy DataFrame.
Work runs as Spark SQL aggregates, windows and joins (or Spark ML estimators);
Python-side code only appears inside Arrow-batched ``applyInPandas`` /
``mapInPandas`` for the isolation forest and long-series FFT.
"""

from tablens.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
