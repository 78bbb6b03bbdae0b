"""Registered report queries: integrity, insights, combined quality issues, top-N cuts, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablens.operators import outliers as O
from tablens.operators import quality as Q
from tablens.operators import stats as S
from tablens.plans.profile_queries import _EVENTS_NULLS_SQL, events_with_nulls
from tablens.functions.numeric import kolmogorov_sf_sql, norm_cdf_sql
from tablens.plans.registry import load, register, rounded
from tablens.plans.reports import top_features

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE5 = "select l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag from lineitem"


@register("integrity_report_lineitem", f"""
with li as ({_LINE5}),
mi as (select column_name, cast(v as double) as value from (
         select count_if(l_quantity is null or isnan(l_quantity)) as l_quantity,
                count_if(l_extendedprice is null or isnan(l_extendedprice)) as l_extendedprice,
                count_if(l_discount is null or isnan(l_discount)) as l_discount,
                count_if(l_tax is null or isnan(l_tax)) as l_tax, count_if(l_returnflag is null) as l_returnflag
         from li) unpivot (v for column_name in (l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag))),
du as (select cast(coalesce(sum(c - 1), 0) as double) as value from (
         select count(*) as c from li group by l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag)),
ck as (select count_if(not coalesce(l_quantity > 0 and l_extendedprice > 0 and l_discount > 0 and l_tax > 0, false))
                as pos_v,
              count_if(not (case when l_extendedprice is null or l_quantity is null or isnan(l_extendedprice)
                                      or isnan(l_quantity) then false
                                 when l_quantity = 0 then l_extendedprice < 0
                                 else l_extendedprice / l_quantity < 10 end)) as ratio_v,
              count_if(not coalesce(l_returnflag in ('A', 'N', 'R'), false)) as dom_v from li),
l as (select column_name, value from li unpivot (value for column_name in (l_quantity, l_extendedprice, l_discount, l_tax))),
ms as (select column_name, round_even(min(value), 2) as min, round_even(max(value), 2) as max,
              round_even(avg(value), 2) as mean, round_even(stddev_samp(value), 2) as std,
              round_even(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 2) as iqr from l group by 1)
select 'missing' as section, column_name, 'missing' as metric, value, cast(null as varchar) as detail from mi
union all select 'duplicates', null, 'duplicates', value, null from du
union all select 'dtypes', column_name, 'dtype', null, case when column_name = 'l_returnflag' then 'string' else 'double' end
  from mi
union all select 'constraints', null, 'all_positive', cast(pos_v as double), case when pos_v = 0 then 'true' else 'false' end
  from ck
union all select 'constraints', null, 'l_extendedprice/l_quantity<10', cast(ratio_v as double),
  case when ratio_v = 0 then 'true' else 'false' end from ck
union all select 'constraints', null, 'l_returnflag_in_domain', cast(dom_v as double),
  case when dom_v = 0 then 'true' else 'false' end from ck
union all select 'measurements', column_name, metric, value, null from ms
  unpivot (value for metric in (min, max, mean, std, iqr))
""")
def integrity_report_lineitem(spark, sf):
    """Integrity report: missing, duplicates, dtypes, constraint checks, measurement statistics."""
    li = load(spark, sf, "lineitem").select(*LINE_MEASURES, "l_returnflag")
    return Q.integrity_report(li, LINE_MEASURES, "l_returnflag", ["A", "N", "R"],
                              ratios=[("l_extendedprice", "l_quantity")])


@register("insights_lineitem", f"""
with li as ({_LINE5}),
l as (select column_name, value from li unpivot (value for column_name in (l_quantity, l_extendedprice, l_discount, l_tax))),
c as (select corr(l_quantity, l_extendedprice) as qe, corr(l_quantity, l_discount) as qd, corr(l_quantity, l_tax) as qt,
             corr(l_extendedprice, l_discount) as ed, corr(l_extendedprice, l_tax) as et, corr(l_discount, l_tax) as dt
      from li),
p as (select 'l_quantity' as a, 'l_extendedprice' as b, qe as r from c union all
      select 'l_quantity', 'l_discount', qd from c union all select 'l_quantity', 'l_tax', qt from c union all
      select 'l_extendedprice', 'l_discount', ed from c union all select 'l_extendedprice', 'l_tax', et from c union all
      select 'l_discount', 'l_tax', dt from c),
tc as (select a || '~' || b as item, round_even(abs(r), 2) as value from p where r is not null
       order by value desc, a, b limit 3),
v as (select column_name, var_samp(value) as variance from l group by 1),
q as (select column_name, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from l group by 1)
select 'validity' as section, 'all_positive' as item,
       case when bool_and(coalesce(l_quantity > 0 and l_extendedprice > 0 and l_discount > 0 and l_tax > 0, false))
            then 1.0 else 0.0 end as value from li
union all select 'label_counts', l_returnflag, cast(count(*) as double) from li where l_returnflag is not null
  group by l_returnflag
union all select 'variance_rank', column_name, cast(row_number() over (order by variance desc nulls last, column_name)
                                                    as double) from v
union all select 'top_correlation', item, value from tc
union all select 'iqr_outliers', q.column_name,
  cast(count(*) filter (where l.value < q1 - 1.5 * (q3 - q1) or l.value > q3 + 1.5 * (q3 - q1)) as double)
  from q join l on q.column_name = l.column_name where q3 - q1 >= 1e-6 group by q.column_name
""")
def insights_lineitem(spark, sf):
    """Insights: validity, label counts, variance ranking, top correlations, IQR outlier counts."""
    li = load(spark, sf, "lineitem").select(*LINE_MEASURES, "l_returnflag")
    return S.insights(li, LINE_MEASURES, "l_returnflag")


@register("quality_issues_events", f"""
with e as ({_EVENTS_NULLS_SQL}),
mi as (select column_name, cast(v as double) as value from (
         select count_if(event_id is null) as event_id, count_if(ts is null) as ts,
                count_if(user_id is null) as user_id, count_if(event_type is null) as event_type,
                count_if(value is null or isnan(value)) as value from e)
       unpivot (v for column_name in (event_id, ts, user_id, event_type, value))),
nu as (select column_name, cast(v as double) as value from (
         select count(distinct event_id) as event_id, count(distinct ts) as ts, count(distinct user_id) as user_id,
                count(distinct event_type) as event_type, count(distinct value) as value from e)
       unpivot (v for column_name in (event_id, ts, user_id, event_type, value))),
hc as (select 'event_type' as column_name, count(distinct event_type) / count(*) as value from e),
mx as (select 'event_type' as column_name,
              count_if(regexp_matches(event_type, '^\\s*[+-]?((\\d+\\.?\\d*)|(\\.\\d+))([eE][+-]?\\d+)?\\s*$')
                       and lower(trim(event_type)) <> 'nan') as k, count(*) as n from e),
mo as (select column_name, skewness(v) * (count(v) - 2) / sqrt(count(v) * (count(v) - 1)) as skew, var_samp(v) as var
       from (select column_name, v from (select cast(event_id as double) as event_id, cast(user_id as double) as user_id,
                                                value from e)
             unpivot (v for column_name in (event_id, user_id, value))) group by 1),
du as (select coalesce(sum(c - 1), 0) as d from (select count(*) as c from e group by ts, user_id, event_type, value))
select 'missing' as issue, column_name, value from mi where value > 0
union all select 'constant', column_name, value from nu where value <= 1
union all select 'high_cardinality', column_name, round(value, 6) from hc where value > 0.9
union all select 'mixed_types', column_name, cast(k as double) from mx where k > 0 and k < n
union all select 'skewed', column_name, round(skew, 6) from mo where abs(skew) > 3
union all select 'near_zero_variance', column_name, round(var, 6) from mo where var < 1e-6
union all select 'duplicates', null, cast(d as double) from du where d > 0
""")
def quality_issues_events(spark, sf):
    """All issue detectors at once: missing, constant, high cardinality, mixed types, skew,
    near-zero variance, duplicates."""
    return rounded(Q.quality_issues(events_with_nulls(spark, sf), key="event_id"))


@register("top_missing_events", f"""
with e as ({_EVENTS_NULLS_SQL})
select column_name, cast(missing as bigint) as missing, round_even(100.0 * missing / n, 2) as missing_pct
from (select count(*) as n,
             count_if(event_id is null) as event_id, count_if(ts is null) as ts,
             count_if(user_id is null) as user_id, count_if(event_type is null) as event_type,
             count_if(value is null or isnan(value)) as value from e)
unpivot (missing for column_name in (event_id, ts, user_id, event_type, value))
where missing > 0 order by missing desc, column_name limit 5
""")
def top_missing_events(spark, sf):
    """Top columns by missing count (report cut)."""
    return S.top_missing(events_with_nulls(spark, sf), 5)


@register("top_features_lineitem", """
with c as (select corr(l_quantity, l_extendedprice) as qe, corr(l_quantity, l_discount) as qd,
                  corr(l_quantity, l_tax) as qt, corr(l_extendedprice, l_discount) as ed,
                  corr(l_extendedprice, l_tax) as et, corr(l_discount, l_tax) as dt from lineitem),
cs as (select 'l_quantity' as column_name, 1 + abs(qe) + abs(qd) + abs(qt) as s from c union all
       select 'l_extendedprice', 1 + abs(qe) + abs(ed) + abs(et) from c union all
       select 'l_discount', 1 + abs(qd) + abs(ed) + abs(dt) from c union all
       select 'l_tax', 1 + abs(qt) + abs(et) + abs(dt) from c),
l as (select column_name, value from lineitem unpivot (value for column_name in (l_quantity, l_extendedprice, l_discount, l_tax))),
m as (select column_name, case when abs(avg(value)) > 1e-10 then stddev_samp(value) / abs(avg(value)) else 0 end as cv
      from l group by 1),
raw as (select m.column_name, 0.7 * coalesce(cv / nullif(max(cv) over (), 0), 0) + 0.3 * s / 3 as raw
        from m join cs on m.column_name = cs.column_name)
select column_name, round_even(raw / sum(raw) over (), 4) as importance from raw
order by importance desc, column_name limit 5
""")
def top_features_lineitem(spark, sf):
    """Top features by importance score (report cut)."""
    return top_features(load(spark, sf, "lineitem"), LINE_MEASURES)


@register("complex_patterns_events")
def complex_patterns_events(spark, sf):
    """Step choice → resampling → first three dominant bins of every measure (rows-only check)."""
    from tablens.plans.reports import complex_patterns
    ev = load(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("double"))
    return rounded(complex_patterns(ev, "ts", ["value", "user_id"]))


@register("outlier_rows_semi_events", """
with b as (select avg(value) as m, stddev_samp(value) as s from events)
select e.* from events e where exists (select 1 from b where abs((e.value - b.m) / b.s) > 3)
""")
def outlier_rows_semi_events(spark, sf):
    """Full rows with a cell outside its bounds (a row-local filter)."""
    ev = load(spark, sf, "events")
    return O.keep_outside(ev, O.fit_bounds(ev, ["value"], "zscore_sample"))


@register("flagged_keys_orders", """
with b as (select o_orderpriority, quantile_cont(o_totalprice, 0.25) as q1, quantile_cont(o_totalprice, 0.75) as q3,
                  quantile_cont(o_custkey, 0.25) as c1, quantile_cont(o_custkey, 0.75) as c3
           from orders where o_orderpriority is not null group by 1)
select distinct o.o_orderkey from orders o join b on o.o_orderpriority = b.o_orderpriority
where o.o_totalprice < q1 - 0.5 * (q3 - q1) or o.o_totalprice > q3 + 0.5 * (q3 - q1)
   or o.o_custkey < c1 - 0.5 * (c3 - c1) or o.o_custkey > c3 + 0.5 * (c3 - c1)
""")
def flagged_keys_orders(spark, sf):
    """Union-distinct of the keys flagged in any column (grouped IQR, factor 0.5)."""
    o = load(spark, sf, "orders")
    b = O.fit_bounds(o, ["o_totalprice", "o_custkey"], "iqr", "o_orderpriority", factor=0.5)
    return O.flagged_keys(O.flag_rows(o, b, "o_orderkey", "o_orderpriority"), "o_orderkey")


@register("anomaly_methods_events", """
with iq as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3, count(value) as n from events),
zs as (select avg(value) as m, stddev_samp(value) as s, count(value) as n from events),
md as (select quantile_cont(value, 0.5) as med, count(value) as n from events),
mad as (select quantile_cont(abs(value - md.med), 0.5) as mad from events, md)
select 'iqr' as method, 'value' as column_name, cast(n as bigint) as n,
       cast((select count(*) from events where value < q1 - 1.5 * (q3 - q1) or value > q3 + 1.5 * (q3 - q1)) as bigint)
         as outlier_count from iq
union all select 'zscore_sample', 'value', cast(n as bigint),
       cast((select count(*) from events where abs((value - m) / s) > 3) as bigint) from zs
union all select 'modified_zscore', 'value', cast(md.n as bigint),
       cast((select count(*) from events where abs(0.6745 * (value - med) / mad) > 3.5) as bigint) from md, mad
""")
def anomaly_methods_events(spark, sf):
    """Multi-method front (unknown method names ignored): counts per method."""
    ev = load(spark, sf, "events")
    d = O.detect_many(ev, ["value"], ["iqr", "zscore_sample", "modified_zscore", "not_a_method"])
    return d.select("method", "column_name", F.col("n").cast("long").alias("n"),
                    F.col("outlier_count").cast("long").alias("outlier_count"))


@register("ks_test_events", f"""
with s as (select count(value) as n, avg(value) as m, stddev_samp(value) as s from events),
c as (select value, count(*) as c from events where value is not null group by value),
r as (select value, sum(c) over (order by value) as upto, sum(c) over (order by value) - c as below from c),
z as (select (value - m) / s as z, upto * 1.0 / n as upto, below * 1.0 / n as below, n from r, s),
d as (select max(greatest(upto - {norm_cdf_sql('z')}, {norm_cdf_sql('z')} - below)) as statistic, any_value(n) as n from z),
x as (select n, statistic, sqrt(n) * statistic as x from d)
select 'value' as column_name, cast(n as bigint) as n, round(statistic, 6) as statistic, round({kolmogorov_sf_sql('x')}, 6) as "pValue" from x
""")
def ks_test_events(spark, sf):
    """Kolmogorov–Smirnov test of events.value against a normal with its mean and deviation."""
    return rounded(S.ks_normal(load(spark, sf, "events"), "value"))


@register("find_anomalies_events")
def find_anomalies_events(spark, sf):
    """Multi-method anomaly front incl. the isolation forest: flagged rows per method (rows-only)."""
    ev = load(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("double"))
    return O.find_anomalies(ev, ["value", "user_id"], "event_id",
                            ["iqr", "zscore_sample", "modified_zscore", "isolation_forest", "unknown"])


@register("summary_report_events")
def summary_report_events(spark, sf):
    """The full report of events in one table: info, missing, statistics, correlation, clusters, forest, time patterns, issues (rows-only check)."""
    from tablens.plans.reports import report_rows, summary_report
    ev = load(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("double"))
    return report_rows(summary_report(ev, ["value", "user_id"], label="event_type", key="event_id", ts="ts"))
