"""Apply fitted (batch) state to a streaming DataFrame.

The reference is batch-only; what carries over is the split between the fitted
half (bounds, scaler statistics, codes: small static tables) and the row-local
half, which runs unchanged on ``readStream`` input as a stream–static join.
Windowed counts of flagged rows use an event-time watermark so state is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablens.functions.frames import as_list, long_form
from tablens.operators.outliers import _meta, _outside, _score
from tablens.session import checkpoint_dir


def flag_stream(stream: DataFrame, bounds: DataFrame, key: Sequence[str] | str,
                group: Sequence[str] | str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Outlier flags ``(key..., keep..., group..., column_name, method, value, score)`` for a stream.

    ``bounds`` comes from ``fit_bounds`` on historical data; each micro-batch is scored
    row-locally against it (no state).
    """
    key, group, keep = as_list(key), as_list(group), as_list(keep)
    m = _meta(bounds)
    ids = list(dict.fromkeys(key + keep + group))
    lf = long_form(stream, m["columns"], ids=ids, variable="column_name")
    # A stream joins a static table of any size; Catalyst broadcasts it when its bytes allow.
    j = lf.join(bounds.filter(~F.col("skipped")), group + ["column_name"])
    return j.filter(_outside()).select(*ids, "column_name", "method", "value", _score().alias("score"))


def windowed_flag_counts(flags: DataFrame, ts: str, window: str = "1 hour", watermark: str = "10 minutes",
                         group: Sequence[str] | str | None = None) -> DataFrame:
    """Flag counts per event-time window (tumbling), per group and column, with a watermark.

    Event time must be a TIMESTAMP: an NTZ column is cast (session time zone UTC).
    """
    group = as_list(group)
    t = flags.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", watermark)
    return t.groupBy(F.window("_event_time", window).alias("window"), *group, "column_name") \
        .agg(F.count(F.lit(1)).alias("flags"))


def start_to_parquet(df: DataFrame, name: str, path: str, output_mode: str = "append", once: bool = True):
    """Start a streaming write to parquet with its checkpoint under the shared checkpoint folder."""
    ck = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/streams/{name}"
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck) \
        .outputMode(output_mode)
    if once:
        w = w.trigger(availableNow=True)
    return w.start()
