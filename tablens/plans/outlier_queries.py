"""Registered outlier queries (bounds, counts, flags, treatment) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablens.operators import outliers as O
from tablens.plans.registry import load, r6, register


def _counts_out(c, group):
    return c.select(*group, "column_name", F.col("n").cast("long").alias("n"),
                    r6("center").alias("center"), r6("spread").alias("spread"),
                    r6("lower").alias("lower"), r6("upper").alias("upper"),
                    F.col("outlier_count").cast("long").alias("outlier_count"))


@register("iqr_outliers_by_event_type", """
with b as (
  select event_type, 'value' as column_name, count(value) as n,
         quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
  from events where event_type is not null and value is not null group by event_type)
select b.event_type, b.column_name, cast(b.n as bigint) as n, round(b.q1, 6) as center,
       round(b.q3 - b.q1, 6) as spread,
       round(b.q1 - 1.5 * (b.q3 - b.q1), 6) as lower, round(b.q3 + 1.5 * (b.q3 - b.q1), 6) as upper,
       cast(count(e.value) filter (where e.value < b.q1 - 1.5 * (b.q3 - b.q1)
                                 or e.value > b.q3 + 1.5 * (b.q3 - b.q1)) as bigint) as outlier_count
from b join events e on e.event_type = b.event_type
group by all
""")
def iqr_outliers_by_event_type(spark, sf):
    """Flagship: grouped IQR bounds of events.value per event_type and outlier counts."""
    ev = load(spark, sf, "events")
    b = O.fit_bounds(ev, ["value"], "iqr", "event_type")
    return _counts_out(O.outlier_counts(ev, b, "event_type"), ["event_type"])


@register("iqr_outliers_lineitem_by_returnflag", """
with l as (
  select l_returnflag, column_name, value from lineitem
  unpivot (value for column_name in (l_quantity, l_extendedprice, l_discount, l_tax))),
b as (
  select l_returnflag, column_name, count(value) as n,
         quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
  from l where value is not null group by all)
select b.l_returnflag, b.column_name, cast(b.n as bigint) as n, round(b.q1, 6) as center,
       round(b.q3 - b.q1, 6) as spread,
       round(b.q1 - 1.5 * (b.q3 - b.q1), 6) as lower, round(b.q3 + 1.5 * (b.q3 - b.q1), 6) as upper,
       cast(count(l.value) filter (where l.value < b.q1 - 1.5 * (b.q3 - b.q1)
                                 or l.value > b.q3 + 1.5 * (b.q3 - b.q1)) as bigint) as outlier_count
from b join l on l.l_returnflag = b.l_returnflag and l.column_name = b.column_name
group by all
""")
def iqr_outliers_lineitem_by_returnflag(spark, sf):
    """Grouped IQR over four lineitem measures (unpivot → grouped percentile → broadcast join)."""
    li = load(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    b = O.fit_bounds(li, cols, "iqr", "l_returnflag")
    return _counts_out(O.outlier_counts(li, b, "l_returnflag"), ["l_returnflag"])


@register("zscore_outliers_events", """
with b as (select count(value) as n, avg(value) as m, stddev_pop(value) as s from events)
select 'value' as column_name, cast(b.n as bigint) as n, round(b.m, 6) as center, round(b.s, 6) as spread,
       round(b.m - 3 * b.s, 6) as lower, round(b.m + 3 * b.s, 6) as upper,
       cast((select count(*) from events e where abs((e.value - b.m) / b.s) > 3) as bigint) as outlier_count
from b
""")
def zscore_outliers_events(spark, sf):
    """Global z-score (population std, |z| > 3) on events.value."""
    ev = load(spark, sf, "events")
    b = O.fit_bounds(ev, ["value"], "zscore")
    return _counts_out(O.outlier_counts(ev, b), [])


@register("zscore_sample_outliers_by_event_type", """
with b as (select event_type, count(value) as n, avg(value) as m, stddev_samp(value) as s
           from events where event_type is not null group by event_type)
select b.event_type, 'value' as column_name, cast(b.n as bigint) as n, round(b.m, 6) as center,
       round(b.s, 6) as spread, round(b.m - 3 * b.s, 6) as lower, round(b.m + 3 * b.s, 6) as upper,
       cast(count(*) filter (where abs((e.value - b.m) / b.s) > 3) as bigint) as outlier_count
from b join events e on e.event_type = b.event_type group by all
""")
def zscore_sample_outliers_by_event_type(spark, sf):
    """Grouped z-score with sample std (missing skipped, n ≥ 2)."""
    ev = load(spark, sf, "events")
    b = O.fit_bounds(ev, ["value"], "zscore_sample", "event_type")
    return _counts_out(O.outlier_counts(ev, b, "event_type"), ["event_type"])


@register("modified_zscore_outliers_events", """
with m as (select count(value) as n, quantile_cont(value, 0.5) as med from events),
d as (select quantile_cont(abs(e.value - m.med), 0.5) as mad from events e, m)
select 'value' as column_name, cast(m.n as bigint) as n, round(m.med, 6) as center, round(d.mad, 6) as spread,
       round(m.med - 3.5 * d.mad / 0.6745, 6) as lower, round(m.med + 3.5 * d.mad / 0.6745, 6) as upper,
       cast((select count(*) from events e where abs(0.6745 * (e.value - m.med) / d.mad) > 3.5) as bigint)
         as outlier_count
from m, d
""")
def modified_zscore_outliers_events(spark, sf):
    """Modified z-score 0.6745·(x − median)/MAD with |·| > 3.5 (two-pass exact median)."""
    ev = load(spark, sf, "events")
    b = O.fit_bounds(ev, ["value"], "modified_zscore")
    return _counts_out(O.outlier_counts(ev, b), [])


@register("iqr_outlier_rows_events", """
with b as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
           from events where event_type is not null group by 1)
select e.event_id, e.event_type, 'value' as column_name, e.value
from events e join b on e.event_type = b.event_type
where e.value < b.q1 - 1.5 * (b.q3 - b.q1) or e.value > b.q3 + 1.5 * (b.q3 - b.q1)
""")
def iqr_outlier_rows_events(spark, sf):
    """Row-level grouped IQR flags: keys and values of outlying events per event_type."""
    ev = load(spark, sf, "events")
    b = O.fit_bounds(ev, ["value"], "iqr", "event_type")
    return O.flag_rows(ev, b, "event_id", "event_type").select(
        "event_id", "event_type", "column_name", "value")


@register("zscore_outlier_rows_events", """
with b as (select avg(value) as m, stddev_samp(value) as s from events)
select e.event_id, 'value' as column_name, e.value, round((e.value - b.m) / b.s, 6) as score
from events e, b where abs((e.value - b.m) / b.s) > 3
""")
def zscore_outlier_rows_events(spark, sf):
    """Row flags of the sample z-score with their scores (outlier indices and values)."""
    ev = load(spark, sf, "events")
    b = O.fit_bounds(ev, ["value"], "zscore_sample")
    return O.flag_rows(ev, b, "event_id").select("event_id", "column_name", "value", r6("score").alias("score"))


@register("iqr_capped_events", """
with b as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
           from events group by 1)
select e.event_id, e.event_type,
       case when e.value < b.q1 - 1.5 * (b.q3 - b.q1) then round(b.q1 - 1.5 * (b.q3 - b.q1), 6)
            when e.value > b.q3 + 1.5 * (b.q3 - b.q1) then round(b.q3 + 1.5 * (b.q3 - b.q1), 6)
            else e.value end as value
from events e join b on e.event_type = b.event_type
""")
def iqr_capped_events(spark, sf):
    """Cap values to their group's IQR bounds (clip, NULL stays NULL)."""
    ev = load(spark, sf, "events").select("event_id", "event_type", "value")
    out = O.cap_outliers(ev, ["value"], "iqr", "event_type")
    return out.select("event_id", "event_type", r6("value").alias("value"))


@register("zscore_capped_orders", """
with b as (select avg(o_totalprice) as m, stddev_samp(o_totalprice) as s from orders)
select o.o_orderkey,
       round(least(greatest(o.o_totalprice, b.m - 3 * b.s), b.m + 3 * b.s), 6) as o_totalprice
from orders o, b
""")
def zscore_capped_orders(spark, sf):
    """Cap to mean ± 3·sample std."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = O.cap_outliers(o, ["o_totalprice"], "zscore")
    return out.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"))


@register("outliers_removed_report_events", """
with b as (select event_type, avg(value) as m, stddev_pop(value) as s from events group by 1),
kept as (select e.* from events e join b on e.event_type = b.event_type
         where not (abs((e.value - b.m) / b.s) > 3))
select cast((select count(*) from events) as bigint) as rows_before,
       cast((select count(*) from kept) as bigint) as rows_after,
       cast((select count(*) from events) - (select count(*) from kept) as bigint) as rows_removed,
       cast(6 as bigint) as n_columns
""")
def outliers_removed_report_events(spark, sf):
    """Remove rows flagged by a grouped population z-score (row-local filter); rows before/after."""
    ev = load(spark, sf, "events")
    kept = O.handle(ev, "remove", "zscore", ["value"], "event_type", key="event_id")
    return O.removal_report(ev, kept)


@register("outlier_votes_events", """
with iq as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events),
zs as (select avg(value) as m, stddev_samp(value) as s from events),
md as (select quantile_cont(value, 0.5) as med from events),
mad as (select quantile_cont(abs(value - md.med), 0.5) as mad from events, md),
f as (
  select event_id, 'iqr' as method from events, iq
    where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)
  union all
  select event_id, 'zscore_sample' from events, zs where abs((value - m) / s) > 3
  union all
  select event_id, 'modified_zscore' from events, md, mad where abs(0.6745 * (value - med) / mad) > 3.5)
select event_id, cast(count(*) as bigint) as votes, cast(count(distinct method) as bigint) as n_methods
from f group by event_id
""")
def outlier_votes_events(spark, sf):
    """Multi-method front: IQR, sample z and modified z flags unioned, votes per row."""
    ev = load(spark, sf, "events")
    bl = [O.fit_bounds(ev, ["value"], m) for m in ("iqr", "zscore_sample", "modified_zscore")]
    return O.flag_union(ev, bl, "event_id")


@register("iqr_imputed_events", """
with b as (select event_type, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
           from events group by 1),
m as (select e.event_id, e.event_type,
             case when e.value < b.q1 - 1.5 * (b.q3 - b.q1) or e.value > b.q3 + 1.5 * (b.q3 - b.q1)
                  then null else e.value end as value
      from events e join b on e.event_type = b.event_type),
med as (select event_type, quantile_cont(value, 0.5) as md from m group by 1)
select m.event_id, m.event_type, round(coalesce(m.value, med.md), 6) as value
from m join med on m.event_type = med.event_type
""")
def iqr_imputed_events(spark, sf):
    """Outlier imputation: flagged cells → NULL → group median of the rest."""
    ev = load(spark, sf, "events").select("event_id", "event_type", "value")
    b = O.fit_bounds(ev, ["value"], "iqr", "event_type")
    out = O.impute_outliers(ev, b, "event_type", ["value"])
    return out.select("event_id", "event_type", r6("value").alias("value"))


@register("outlier_analysis_orders", """
with l as (select column_name, value from orders unpivot (value for column_name in (o_totalprice, o_custkey))),
b as (select column_name, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from l group by 1
      having quantile_cont(value, 0.75) - quantile_cont(value, 0.25) >= 1e-6),
n as (select count(*) as n from orders)
select b.column_name,
       cast(count(*) filter (where l.value < q1 - 0.1 * (q3 - q1) or l.value > q3 + 0.1 * (q3 - q1)) as bigint)
         as outlier_count,
       round_even(100.0 * count(*) filter (where l.value < q1 - 0.1 * (q3 - q1) or l.value > q3 + 0.1 * (q3 - q1))
                  / any_value(n.n), 2) as outlier_pct,
       round_even(any_value(q1 - 0.1 * (q3 - q1)), 2) as lower, round_even(any_value(q3 + 0.1 * (q3 - q1)), 2) as upper
from b join l on l.column_name = b.column_name cross join n
group by b.column_name
""")
def outlier_analysis_orders(spark, sf):
    """IQR outlier summary: count, percentage of rows, rounded bounds (factor 0.1)."""
    o = load(spark, sf, "orders").withColumn("o_custkey", F.col("o_custkey").cast("double"))
    return O.outlier_analysis(o, ["o_totalprice", "o_custkey"], factor=0.1)
