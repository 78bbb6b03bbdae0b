"""Queries over stand-ins with planted NaN, nulls and extreme cells: missing is missing everywhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablens.operators import cleaning as C
from tablens.operators import features as FE
from tablens.operators import ml as M
from tablens.operators import outliers as O
from tablens.operators import plotdata as V
from tablens.operators import quality as Q
from tablens.operators import stats as S
from tablens.operators import timeseries as TS
from tablens.plans.profile_queries import _EVENTS_NULLS_SQL, events_with_nulls
from tablens.plans.registry import load, r6, register, rounded


def events_with_nan(spark, sf):
    """Stand-in input: events whose value is NaN in every 13th row."""
    nan = F.lit(float("nan"))
    return load(spark, sf, "events").withColumn("value", F.when(F.col("event_id") % 13 == 0, nan).otherwise(F.col("value")))


_NAN = "e as (select * replace (case when event_id % 13 = 0 then null else value end as value) from events)"


@register("group_means_nan_events", f"""
with {_NAN} select event_type, round(avg(value), 6) as value from e where event_type is not null group by 1
""")
def group_means_nan_events(spark, sf):
    """Group means with NaN cells left out."""
    return rounded(S.group_means(events_with_nan(spark, sf), "event_type", ["value"]))


@register("radar_nan_events", f"""
with {_NAN} select event_type, 'value' as column_name, round(avg(value), 6) as mean from e where event_type is not null group by 1
""")
def radar_nan_events(spark, sf):
    """Long group means with NaN cells left out."""
    return rounded(V.radar(events_with_nan(spark, sf), "event_type", ["value"]))


@register("correlation_nan_events", f"""
with {_NAN}, c as (select corr(value, user_id) as c from e where value is not null)
select 'value' as col1, 'user_id' as col2, round(c, 6) as corr from c
union all select 'user_id', 'value', round(c, 6) from c
""")
def correlation_nan_events(spark, sf):
    """Pearson correlation over the rows where both measures are present."""
    return rounded(S.correlation_long(events_with_nan(spark, sf), ["value", "user_id"], include_diagonal=False))


@register("monthly_means_nan_events", f"""
with {_NAN} select cast(month(ts) as integer) as month, 'value' as column_name, round(avg(value), 6) as mean
from e where ts is not null group by 1 having avg(value) is not null
""")
def monthly_means_nan_events(spark, sf):
    """Monthly means with NaN cells left out."""
    return rounded(TS.monthly_means(events_with_nan(spark, sf), "ts", ["value"]))


@register("ols_nan_events", f"""
with {_NAN}
select event_type, round(regr_slope(value, user_id), 6) as slope, round(regr_intercept(value, user_id), 6) as intercept,
       round(regr_r2(value, user_id), 6) as r2, cast(regr_count(value, user_id) as bigint) as n
from e where event_type is not null group by 1
""")
def ols_nan_events(spark, sf):
    """Least-squares lines over the rows where both variables are present."""
    return rounded(M.ols_by_group(events_with_nan(spark, sf), "value", "user_id", "event_type"))


@register("positive_nan_events", f"""
with {_NAN} select 'all_positive' as "check", count_if(not coalesce(value > 0, false)) = 0 as passed,
       cast(count_if(not coalesce(value > 0, false)) as bigint) as violations from e
""")
def positive_nan_events(spark, sf):
    """A missing measure isn't positive."""
    return Q.positive_check(events_with_nan(spark, sf), ["value"])


@register("positive_rows_nan_events", f"""
with {_NAN} select event_id, value from e where value > 0
""")
def positive_rows_nan_events(spark, sf):
    """Rows with a positive measure; missing ones go."""
    return C.filter_positive(events_with_nan(spark, sf), ["value"]).select("event_id", "value")


@register("clipped_nan_events", f"""
with {_NAN} select event_id, case when value < 20 then 20.0 when value > 100 then 100.0 else value end as value from e
""")
def clipped_nan_events(spark, sf):
    """Clipping leaves a missing cell missing."""
    return FE.clip_columns(events_with_nan(spark, sf).select("event_id", "value"), {"value": (20.0, 100.0)})


@register("iqr_capped_nan_events", f"""
with {_NAN}, b as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from e where value is not null group by 1)
select e.event_id, e.event_type,
       round(case when value < q1 - 1.5 * (q3 - q1) then q1 - 1.5 * (q3 - q1) when value > q3 + 1.5 * (q3 - q1) then q3 + 1.5 * (q3 - q1)
                  else value end, 6) as value
from e join b on e.event_type = b.event_type
""")
def iqr_capped_nan_events(spark, sf):
    """Caps per group leave a missing cell missing."""
    ev = events_with_nan(spark, sf).select("event_id", "event_type", "value")
    return O.cap_outliers(ev, ["value"], "iqr", "event_type").select("event_id", "event_type", r6("value").alias("value"))


@register("group_stats_events_with_nulls", f"""
with e as ({_EVENTS_NULLS_SQL})
select 'event_type' as group_column, event_type as level, 'value' as column_name, round(avg(value), 6) as mean,
       round(quantile_cont(value, 0.5), 6) as median, cast(count(*) as bigint) as count, round(stddev_samp(value), 6) as std
from e where event_type is not null group by 2
""")
def group_stats_events_with_nulls(spark, sf):
    """Statistics per level; the count is the level's rows, missing cells included."""
    return rounded(S.group_stats(events_with_nulls(spark, sf), ["event_type"], ["value"]))


@register("zscore_capped_planted_orders", """
with o as (select o_orderkey, case when o_orderkey % 500 = 0 then o_totalprice * 100 else o_totalprice end as o_totalprice from orders),
b as (select avg(o_totalprice) as m, stddev_samp(o_totalprice) as s from o)
select o_orderkey, round(least(greatest(o_totalprice, m - 3 * s), m + 3 * s), 4) as o_totalprice from o, b
""")
def zscore_capped_planted_orders(spark, sf):
    """Cap to mean ± 3 sample std where extreme cells are planted, so that the cap fires."""
    price = F.when(F.col("o_orderkey") % 500 == 0, F.col("o_totalprice") * 100).otherwise(F.col("o_totalprice"))
    out = O.cap_outliers(load(spark, sf, "orders").select("o_orderkey", price.alias("o_totalprice")), ["o_totalprice"], "zscore")
    return out.select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


_TWO = """o as (select o_orderkey, case when o_orderkey % 7 = 0 then null when o_orderkey % 400 = 1 then o_totalprice * 50 else o_totalprice end as a,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 300 = 2 then -100.0 * o_custkey else cast(o_custkey as double) end as b from orders)"""


def _two_measures(spark, sf):
    """Stand-in input: two measures of orders with planted nulls and extreme cells."""
    k, a, b = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_custkey").cast("double")
    return load(spark, sf, "orders").select(
        "o_orderkey", F.when(k % 7 == 0, None).when(k % 400 == 1, a * 50).otherwise(a).alias("a"),
        F.when(k % 11 == 0, None).when(k % 300 == 2, b * -100.0).otherwise(b).alias("b"))


@register("removed_two_columns_orders", f"""
with {_TWO}, q as (select quantile_cont(a, 0.25) as a1, quantile_cont(a, 0.75) as a3, quantile_cont(b, 0.25) as b1, quantile_cont(b, 0.75) as b3 from o)
select o_orderkey, a, b from o, q
where not coalesce(a < a1 - 1.5 * (a3 - a1) or a > a3 + 1.5 * (a3 - a1), false)
  and not coalesce(b < b1 - 1.5 * (b3 - b1) or b > b3 + 1.5 * (b3 - b1), false)
""")
def removed_two_columns_orders(spark, sf):
    """IQR removal over two measures with nulls in either: a row-local filter, no key."""
    return O.handle(_two_measures(spark, sf), "remove", "iqr", ["a", "b"])


@register("imputed_modified_zscore_orders", f"""
with {_TWO}, m as (select quantile_cont(a, 0.5) as med from o), d as (select quantile_cont(abs(a - med), 0.5) as mad from o, m),
k as (select o_orderkey, case when abs(0.6745 * (a - med) / mad) > 3.5 then null else a end as a from o, m, d)
select o_orderkey, round(coalesce(a, (select quantile_cont(a, 0.5) from k)), 6) as a from k
""")
def imputed_modified_zscore_orders(spark, sf):
    """Cells flagged by the modified z-score, and missing ones, become the median of the others."""
    out = O.handle(_two_measures(spark, sf).select("o_orderkey", "a"), "impute", "modified_zscore", ["a"])
    return out.select("o_orderkey", r6("a").alias("a"))


@register("distinct_counts_nan_events", f"""
with {_NAN}, z as (select event_type, case when event_id % 2 = 0 then 0.0 else -0.0 end as zero, value from e)
select 'event_type' as column_name, cast(count(distinct event_type) as bigint) as n_unique from z
union all select 'zero', cast(1 as bigint)
union all select 'value', cast(count(distinct value) as bigint) from z
""")
def distinct_counts_nan_events(spark, sf):
    """Distinct values per column: NaN is none, 0.0 and -0.0 are one."""
    ev = events_with_nan(spark, sf)
    zero = F.when(F.col("event_id") % 2 == 0, F.lit(0.0)).otherwise(F.lit(-0.0))
    return Q.distinct_counts(ev.select("event_type", zero.alias("zero"), "value"))
