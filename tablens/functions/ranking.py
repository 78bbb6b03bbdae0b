"""Exact global ranks of values within groups, without one-task windows.

``rank_distinct`` turns a long table ``(by..., value)`` into its distinct values
with multiplicity ``c``, the 1-based rank of their first occurrence in sorted
order (``start_rank``) and the previous distinct value (``prev_value``).

A window ``partitionBy(group).orderBy(value)`` would put a whole group into one
task. Instead:

1. distinct ``(by, value) → c`` (map-side combined, so hot values collapse); when
   there are at most ``rows_per_slice`` distinct rows in total, one window per group
   is already bounded and used directly;
2. ``repartitionByRange(by, value)`` splits every group over balanced range
   partitions (sampled bounds), tagged with their partition id and checkpointed
   so the tag is stable under recomputation;
3. per (partition, group) totals and last values form a small table; a window
   over it (≤ #partitions rows per group) gives each slice's rank offset and the
   value that precedes it;
4. a window per (partition, group) slice — bounded by the partition size —
   adds the local running count and lag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablens.functions.frames import as_list
from tablens.functions.joins import attach, bounded_count
from tablens.session import materialize

ROWS_PER_SLICE = 1_000_000


def rank_distinct(long: DataFrame, by: Sequence[str] | None, value: str = "value",
                  rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``(by..., value, c, start_rank, prev_value)`` for every distinct non-null value."""
    by = as_list(by)
    d = long.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("c"))
    spark = long.sparkSession
    if bounded_count(d, rows_per_slice) <= rows_per_slice:
        # every group fits one bounded window task: no range partitioning needed
        w = Window.partitionBy(*by).orderBy(value)
        return d.select(*by, value, "c",
                        (F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("c") + 1)
                        .alias("start_rank"),
                        F.lag(value).over(w).alias("prev_value"))
    d = materialize(d)
    n_distinct = d.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_distinct // rows_per_slice))
    sliced = materialize(d.repartitionByRange(parts, *[F.col(b) for b in by], F.col(value))
                         .withColumn("_pid", F.spark_partition_id()))
    tot = sliced.groupBy("_pid", *by).agg(F.sum("c").alias("_t"), F.max(value).alias("_last"))
    wg = Window.partitionBy(*by).orderBy("_pid")
    tot = tot.withColumn("_off", F.sum("_t").over(wg.rowsBetween(Window.unboundedPreceding, -1))) \
             .withColumn("_prev_last", F.lag("_last").over(wg)) \
             .select("_pid", *by, F.coalesce("_off", F.lit(0)).alias("_off"), "_prev_last")
    tot = materialize(tot)
    ws = Window.partitionBy("_pid", *by).orderBy(value)
    local = sliced.withColumn("_cum", F.sum("c").over(ws.rowsBetween(Window.unboundedPreceding, 0))) \
                  .withColumn("_lag", F.lag(value).over(ws))
    j = attach(local, tot, ["_pid", *by], known_rows=None)
    return j.select(*by, value, "c",
                    (F.col("_off") + F.col("_cum") - F.col("c") + 1).alias("start_rank"),
                    F.coalesce(F.col("_lag"), F.col("_prev_last")).alias("prev_value"))
