"""Registered profiling and data-quality queries (missing, duplicates, checks, statistics)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablens.operators import quality as Q
from tablens.operators import stats as S
from tablens.plans.registry import load, register, rounded

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_UNPIVOT_LINE = ("select column_name, value from lineitem unpivot (value for column_name in "
                 "(l_quantity, l_extendedprice, l_discount, l_tax))")


def events_with_nulls(spark, sf):
    """Stand-in input: events with missing cells planted by key (value, user_id, event_type)."""
    ev = load(spark, sf, "events")
    return ev.select(
        "event_id", "ts",
        F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 13 == 0, None).otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 11 == 0, None).otherwise(F.col("value")).alias("value"))


_EVENTS_NULLS_SQL = """
  select event_id, ts,
         case when event_id % 7 = 0 then null else user_id end as user_id,
         case when event_id % 13 = 0 then null else event_type end as event_type,
         case when event_id % 11 = 0 then null else value end as value
  from events"""


def events_with_repeats(spark, sf):
    """Stand-in input: events plus a second copy of every row whose key is divisible by 13."""
    ev = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    extra = ev.filter(F.col("event_id") % 13 == 0).withColumn("event_id", F.col("event_id") + 100_000_000)
    return ev.unionByName(extra)


_EVENTS_REPEATS_SQL = """
  select event_id, user_id, event_type, value from events
  union all
  select event_id + 100000000, user_id, event_type, value from events where event_id % 13 = 0"""


@register("missing_report_events", f"""
with e as ({_EVENTS_NULLS_SQL})
select column_name, cast(missing as bigint) as missing, round_even(100.0 * missing / n, 2) as missing_pct
from (select count(*) as n,
             count_if(event_id is null) as event_id, count_if(ts is null) as ts,
             count_if(user_id is null) as user_id, count_if(event_type is null) as event_type,
             count_if(value is null or isnan(value)) as value from e)
unpivot (missing for column_name in (event_id, ts, user_id, event_type, value))
""")
def missing_report_events(spark, sf):
    """Missing counts and percentages per column (one aggregate, unpivoted)."""
    return Q.missing_report(events_with_nulls(spark, sf))


@register("rows_with_missing_events", f"""
with e as ({_EVENTS_NULLS_SQL})
select cast(count(*) as bigint) as n_rows,
       cast(count_if(event_id is null or ts is null or user_id is null or event_type is null
                     or value is null or isnan(value)) as bigint) as rows_with_missing
from e
""")
def rows_with_missing_events(spark, sf):
    """Rows with any missing value."""
    return Q.rows_with_missing(events_with_nulls(spark, sf))


@register("dataset_summary_orders", """
with m as (
  select count(*) as n_rows,
         count_if(o_orderkey is null) as o_orderkey, count_if(o_custkey is null) as o_custkey,
         count_if(o_orderstatus is null) as o_orderstatus,
         count_if(o_totalprice is null or isnan(o_totalprice)) as o_totalprice,
         count_if(o_orderdate is null) as o_orderdate, count_if(o_orderpriority is null) as o_orderpriority
  from orders),
t as (select typeof(o_orderkey) as o_orderkey, typeof(o_custkey) as o_custkey, typeof(o_orderstatus) as o_orderstatus,
             typeof(o_totalprice) as o_totalprice, typeof(o_orderdate) as o_orderdate,
             typeof(o_orderpriority) as o_orderpriority from orders limit 1),
ml as (select n_rows, column_name, missing from m
       unpivot (missing for column_name in (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                                            o_orderpriority))),
tl as (select column_name, t from t
       unpivot (t for column_name in (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                                      o_orderpriority)))
select ml.column_name,
       case tl.t when 'VARCHAR' then 'string' when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
                 when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp_ntz' else lower(tl.t) end as dtype,
       cast(n_rows as bigint) as n_rows, cast(missing as bigint) as missing
from ml join tl on ml.column_name = tl.column_name
""")
def dataset_summary_orders(spark, sf):
    """Shape, dtypes and missing counts per column."""
    return Q.dataset_summary(load(spark, sf, "orders"))


@register("duplicate_report_events", f"""
with e as ({_EVENTS_REPEATS_SQL}),
g as (select user_id, event_type, value, count(*) as c from e group by all)
select cast(sum(c) as bigint) as n_rows, cast(sum(c - 1) as bigint) as duplicates,
       round_even(100.0 * sum(c - 1) / sum(c), 2) as duplicate_pct from g
""")
def duplicate_report_events(spark, sf):
    """Duplicate rows (ignoring the key) count and percentage."""
    return Q.duplicate_report(events_with_repeats(spark, sf).drop("event_id"))


@register("duplicate_rows_events", f"""
with e as ({_EVENTS_REPEATS_SQL}),
r as (select event_id, min(event_id) over (partition by user_id, event_type, value) as first_key from e)
select event_id, first_key from r where event_id <> first_key
""")
def duplicate_rows_events(spark, sf):
    """Keys of rows that repeat an earlier row (all but the first by key)."""
    return Q.duplicate_rows(events_with_repeats(spark, sf), "event_id")


@register("constraint_checks_lineitem", """
select 'l_extendedprice/l_quantity<1000' as "check",
       coalesce(bool_and(coalesce(l_extendedprice / l_quantity < 1000, false)), true) as passed,
       cast(count_if(not coalesce(l_extendedprice / l_quantity < 1000, false)) as bigint) as violations
from lineitem
union all
select 'all_positive', coalesce(bool_and(coalesce(l_quantity > 0 and l_extendedprice > 0 and l_discount > 0
                                                    and l_tax > 0, false)), true),
       cast(count_if(not coalesce(l_quantity > 0 and l_extendedprice > 0 and l_discount > 0 and l_tax > 0, false))
            as bigint)
from lineitem
union all
select 'l_returnflag_in_domain', coalesce(bool_and(coalesce(l_returnflag in ('A', 'N'), false)), true),
       cast(count_if(not coalesce(l_returnflag in ('A', 'N'), false)) as bigint)
from lineitem
""")
def constraint_checks_lineitem(spark, sf):
    """Table-level ratio, positivity and domain checks with violation counts."""
    li = load(spark, sf, "lineitem")
    return Q.ratio_check(li, "l_extendedprice", "l_quantity", 1000.0) \
        .unionByName(Q.positive_check(li, LINE_MEASURES)) \
        .unionByName(Q.domain_check(li, "l_returnflag", ["A", "N"]))


@register("profile_lineitem", f"""
with l as ({_UNPIVOT_LINE})
select column_name, cast(count(value) as bigint) as count, cast(0 as bigint) as missing,
       round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std, round(var_samp(value), 6) as variance,
       min(value) as min, round(quantile_cont(value, 0.05), 6) as p05, round(quantile_cont(value, 0.25), 6) as p25,
       round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.75), 6) as p75,
       round(quantile_cont(value, 0.95), 6) as p95, max(value) as max,
       cast(count(distinct value) as bigint) as n_unique, 'double' as dtype
from l group by column_name
""")
def profile_lineitem(spark, sf):
    """Descriptive profile of the lineitem measures (moments, exact percentiles, distinct counts)."""
    return rounded(S.profile(load(spark, sf, "lineitem"), LINE_MEASURES))


@register("profile_events_by_type", f"""
with e as ({_EVENTS_NULLS_SQL})
select event_type, 'value' as column_name, cast(count(value) as bigint) as count,
       cast(count(*) - count(value) as bigint) as missing,
       round(avg(value), 6) as mean, round(stddev_samp(value), 6) as std, round(var_samp(value), 6) as variance,
       min(value) as min, round(quantile_cont(value, 0.05), 6) as p05, round(quantile_cont(value, 0.25), 6) as p25,
       round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.75), 6) as p75,
       round(quantile_cont(value, 0.95), 6) as p95, max(value) as max,
       cast(count(distinct value) as bigint) as n_unique, 'double' as dtype
from e where event_type is not null group by event_type
""")
def profile_events_by_type(spark, sf):
    """Grouped profile with missing values (null group keys dropped)."""
    return rounded(S.profile(events_with_nulls(spark, sf), ["value"], group="event_type"))


@register("describe_orders", """
select 'o_totalprice' as column_name, cast(count(o_totalprice) as bigint) as count,
       round_even(avg(o_totalprice), 2) as mean, round_even(stddev_samp(o_totalprice), 2) as std,
       round_even(min(o_totalprice), 2) as min, round_even(quantile_cont(o_totalprice, 0.25), 2) as p25,
       round_even(quantile_cont(o_totalprice, 0.5), 2) as p50, round_even(quantile_cont(o_totalprice, 0.75), 2) as p75,
       round_even(max(o_totalprice), 2) as max
from orders
""")
def describe_orders(spark, sf):
    """``describe`` rounded half-even to 2 decimals."""
    return S.describe(load(spark, sf, "orders"), ["o_totalprice"], digits=2)


@register("measurement_stats_lineitem", f"""
with l as ({_UNPIVOT_LINE})
select column_name, round_even(min(value), 2) as min, round_even(max(value), 2) as max,
       round_even(avg(value), 2) as mean, round_even(stddev_samp(value), 2) as std,
       round_even(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 2) as iqr
from l group by column_name
""")
def measurement_stats_lineitem(spark, sf):
    """min / max / mean / std / IQR per measure, half-even to 2 dp."""
    return S.measurement_stats(load(spark, sf, "lineitem"), LINE_MEASURES)


@register("shape_stats_events", """
select 'value' as column_name, cast(count(value) as bigint) as n,
       round(skewness(value) * (count(value) - 2) / sqrt(count(value) * (count(value) - 1)), 6) as skewness,
       round(kurtosis_pop(value), 6) as kurtosis
from events having count(value) > 8
""")
def shape_stats_events(spark, sf):
    """Skewness (biased g1) and excess kurtosis when n > 8."""
    return rounded(S.shape_stats(load(spark, sf, "events"), ["value"]))


@register("value_counts_returnflag", """
select l_returnflag as value, cast(count(*) as bigint) as count from lineitem
where l_returnflag is not null group by 1
""")
def value_counts_returnflag(spark, sf):
    """Label distribution."""
    return S.value_counts(load(spark, sf, "lineitem"), "l_returnflag")


@register("most_least_common_mktsegment", """
with vc as (select c_mktsegment as value, count(*) as count from customer where c_mktsegment is not null group by 1)
(select 'most_common' as kind, value, cast(count as bigint) as count from vc order by count desc, value limit 1)
union all
(select 'least_common', value, cast(count as bigint) from vc order by count, value limit 1)
""")
def most_least_common_mktsegment(spark, sf):
    """Most and least common label (ties → smallest value)."""
    return S.most_least_common(load(spark, sf, "customer"), "c_mktsegment")


@register("group_means_lineitem", """
select l_returnflag, round(avg(l_quantity), 6) as l_quantity, round(avg(l_extendedprice), 6) as l_extendedprice,
       round(avg(l_discount), 6) as l_discount, round(avg(l_tax), 6) as l_tax
from lineitem where l_returnflag is not null group by 1
""")
def group_means_lineitem(spark, sf):
    """Mean of every measure per label."""
    return rounded(S.group_means(load(spark, sf, "lineitem"), "l_returnflag", LINE_MEASURES))


@register("group_stats_lineitem", """
with l as (select l_returnflag, l_linestatus, column_name, value from lineitem
           unpivot (value for column_name in (l_quantity, l_extendedprice, l_discount, l_tax))),
g as (select l_returnflag as level, 'l_returnflag' as group_column, column_name, value from l
      union all select l_linestatus, 'l_linestatus', column_name, value from l)
select group_column, level, column_name, round(avg(value), 6) as mean, round(quantile_cont(value, 0.5), 6) as median,
       cast(count(value) as bigint) as count, round(stddev_samp(value), 6) as std
from g where level is not null group by all
""")
def group_stats_lineitem(spark, sf):
    """Per categorical (< 30 levels) level: mean, median, count, std of each measure, one pass."""
    li = load(spark, sf, "lineitem")
    return rounded(S.group_stats(li, ["l_returnflag", "l_linestatus"], LINE_MEASURES))


@register("variance_ranking_lineitem", f"""
with l as ({_UNPIVOT_LINE}),
v as (select column_name, var_samp(value) as variance from l group by 1)
select column_name, round(variance, 6) as variance,
       cast(row_number() over (order by variance desc nulls last, column_name) as integer) as rank from v
""")
def variance_ranking_lineitem(spark, sf):
    """Variance per measure ranked highest first."""
    return rounded(S.variance_ranking(load(spark, sf, "lineitem"), LINE_MEASURES))


_CORR_PAIRS_SQL = """
with c as (select
  corr(l_quantity, l_extendedprice) as qe, corr(l_quantity, l_discount) as qd, corr(l_quantity, l_tax) as qt,
  corr(l_extendedprice, l_discount) as ed, corr(l_extendedprice, l_tax) as et, corr(l_discount, l_tax) as dt
  from lineitem),
p as (
  select 'l_quantity' as col1, 'l_extendedprice' as col2, qe as r from c union all
  select 'l_quantity', 'l_discount', qd from c union all select 'l_quantity', 'l_tax', qt from c union all
  select 'l_extendedprice', 'l_discount', ed from c union all select 'l_extendedprice', 'l_tax', et from c union all
  select 'l_discount', 'l_tax', dt from c),
full_m as (select col1, col2, r from p union all select col2, col1, r from p union all
      select x, x, 1.0 from (values ('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) v(x))"""


@register("correlation_matrix_lineitem", _CORR_PAIRS_SQL + """
select col1, col2, round_even(r, 3) as corr from full_m
""")
def correlation_matrix_lineitem(spark, sf):
    """Signed Pearson matrix (pairwise complete), half-even 3 dp, long form."""
    return S.correlation_long(load(spark, sf, "lineitem"), LINE_MEASURES, digits=3)


@register("abs_correlation_lineitem", _CORR_PAIRS_SQL + """
select col1, col2, round_even(abs(r), 2) as corr from full_m
""")
def abs_correlation_lineitem(spark, sf):
    """Absolute correlation matrix, 2 dp."""
    return S.correlation_long(load(spark, sf, "lineitem"), LINE_MEASURES, digits=2, absolute=True)


@register("top_correlations_lineitem", _CORR_PAIRS_SQL + """
select col1, col2, round_even(abs(r), 2) as corr from p where r is not null
order by corr desc, col1, col2 limit 3
""")
def top_correlations_lineitem(spark, sf):
    """Three strongest |r| pairs from the upper triangle."""
    return S.top_correlations(load(spark, sf, "lineitem"), LINE_MEASURES, n=3)


@register("strong_correlations_orders", """
with a as (select l_orderkey, sum(l_extendedprice) as line_total, cast(count(*) as double) as n_lines,
                  sum(l_quantity) as qty from lineitem group by 1),
j as (select o.o_totalprice, a.line_total, a.n_lines, a.qty from a join orders o on a.l_orderkey = o.o_orderkey),
c as (select corr(o_totalprice, line_total) as a1, corr(o_totalprice, n_lines) as a2, corr(o_totalprice, qty) as a3,
             corr(line_total, n_lines) as b1, corr(line_total, qty) as b2, corr(n_lines, qty) as c1 from j),
p as (select 'o_totalprice' as col1, 'line_total' as col2, round_even(a1, 3) as corr from c union all
      select 'o_totalprice', 'n_lines', round_even(a2, 3) from c union all
      select 'o_totalprice', 'qty', round_even(a3, 3) from c union all
      select 'line_total', 'n_lines', round_even(b1, 3) from c union all
      select 'line_total', 'qty', round_even(b2, 3) from c union all
      select 'n_lines', 'qty', round_even(c1, 3) from c)
select col1, col2, corr from p where abs(corr) > 0.7
""")
def strong_correlations_orders(spark, sf):
    """|r| > 0.7 pairs over per-order line aggregates joined to orders."""
    li = load(spark, sf, "lineitem")
    per = li.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("line_total"),
                                       F.count(F.lit(1)).cast("double").alias("n_lines"),
                                       F.sum("l_quantity").alias("qty"))
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    j = per.join(o, per.l_orderkey == o.o_orderkey)
    return S.strong_correlations(j, ["o_totalprice", "line_total", "n_lines", "qty"])


@register("feature_importance_lineitem", _CORR_PAIRS_SQL + """,
l as (""" + _UNPIVOT_LINE + """),
m as (select column_name, avg(value) as mean, stddev_samp(value) as std from l group by 1),
cv as (select column_name, case when abs(mean) > 1e-10 then std / abs(mean) else 0 end as cv from m),
cs as (select col1 as column_name, sum(abs(r)) as corr_sum from full_m group by 1),
raw as (select cv.column_name, 0.7 * coalesce(cv.cv / nullif(max(cv.cv) over (), 0), 0) + 0.3 * cs.corr_sum / 3 as raw
        from cv join cs on cv.column_name = cs.column_name)
select column_name, round_even(raw / sum(raw) over (), 4) as importance from raw
""")
def feature_importance_lineitem(spark, sf):
    """0.7·cv/max(cv) + 0.3·mean |corr| (self included), normalised, 4 dp."""
    return S.feature_importance(load(spark, sf, "lineitem"), LINE_MEASURES)


@register("top_values_part", """
with l as (select column_name, value from (select p_brand, p_type, p_name from part)
           unpivot (value for column_name in (p_brand, p_type, p_name))),
c as (select column_name, value, count(*) as count from l group by 1, 2),
r as (select column_name, value, count, row_number() over (partition by column_name order by count desc, value) as rank,
             count(*) over (partition by column_name) as n_unique from c)
select column_name, cast(rank as integer) as rank, value, cast(count as bigint) as count,
       cast(n_unique as bigint) as n_unique
from r where rank <= 5
""")
def top_values_part(spark, sf):
    """Distinct count and top-5 values per categorical column."""
    return S.top_values(load(spark, sf, "part"), ["p_brand", "p_type", "p_name"])


@register("distinct_counts_customer", """
select column_name, cast(n as bigint) as n_unique from (
  select count(distinct c_custkey) as c_custkey, count(distinct c_name) as c_name,
         count(distinct c_nationkey) as c_nationkey, count(distinct c_acctbal) as c_acctbal,
         count(distinct c_mktsegment) as c_mktsegment from customer)
unpivot (n for column_name in (c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment))
""")
def distinct_counts_customer(spark, sf):
    """Distinct non-missing values per column (long-form, no Expand)."""
    return Q.distinct_counts(load(spark, sf, "customer"))


@register("head_orders", """
select * from orders order by o_orderkey limit 5
""")
def head_orders(spark, sf):
    """First five rows by key."""
    return S.head(load(spark, sf, "orders"), "o_orderkey", 5)


@register("top_groups_events", """
select event_type as value, cast(count(*) as bigint) as count from events where event_type is not null
group by 1 order by count desc, value limit 3
""")
def top_groups_events(spark, sf):
    """Three largest groups."""
    return S.top_groups(load(spark, sf, "events"), "event_type", 3)


@register("high_cardinality_customer", """
select column_name, cast(n_unique as bigint) as n_unique, cast(n_rows as bigint) as n_rows,
       round(n_unique / n_rows, 6) as unique_ratio from (
  select 'c_name' as column_name, count(distinct c_name) as n_unique, count(*) as n_rows from customer union all
  select 'c_mktsegment', count(distinct c_mktsegment), count(*) from customer)
where n_unique / n_rows > 0.9
""")
def high_cardinality_customer(spark, sf):
    """Text columns whose distinct/rows ratio exceeds 0.9."""
    return rounded(Q.high_cardinality(load(spark, sf, "customer")))


@register("mixed_types_events", """
with e as (select case when event_id % 5 = 0 then cast(value as varchar) else event_type end as mixed,
                  event_type from events)
select column_name, cast(numeric_count as bigint) as numeric_count, cast(n_rows as bigint) as n_rows from (
  select 'mixed' as column_name,
         count_if(regexp_matches(mixed, '^\\s*[+-]?((\\d+\\.?\\d*)|(\\.\\d+))([eE][+-]?\\d+)?\\s*$')) as numeric_count,
         count(*) as n_rows from e
  union all
  select 'event_type', count_if(regexp_matches(event_type, '^\\s*[+-]?((\\d+\\.?\\d*)|(\\.\\d+))([eE][+-]?\\d+)?\\s*$')),
         count(*) from e)
where numeric_count > 0 and numeric_count < n_rows
""")
def mixed_types_events(spark, sf):
    """Text columns where some but not all values are numeric."""
    ev = load(spark, sf, "events")
    e = ev.select(F.when(F.col("event_id") % 5 == 0, F.col("value").cast("string"))
                  .otherwise(F.col("event_type")).alias("mixed"), "event_type")
    return Q.mixed_types(e)


@register("moment_issues_orders", """
select 'o_totalprice' as column_name, cast(count(o_totalprice) as bigint) as n, round(avg(o_totalprice), 6) as mean,
       round(var_samp(o_totalprice), 6) as variance,
       round(skewness(o_totalprice) * (count(o_totalprice) - 2) / sqrt(count(o_totalprice) * (count(o_totalprice) - 1)), 6)
         as skewness,
       round(kurtosis_pop(o_totalprice), 6) as kurtosis
from orders
""")
def moment_issues_orders(spark, sf):
    """Moments behind the skew (|g1| > 3) and near-zero-variance (< 1e-6) issue tests."""
    return rounded(Q.moment_stats(load(spark, sf, "orders"), ["o_totalprice"]))


@register("moment_issues_planted_orders", """
with o as (select power(cast(o_orderkey % 100 as double) / 100, 40) as tail, 1 + cast(o_orderkey % 7 as double) / 100000 as flat, o_totalprice from orders),
m as (select 'skewed' as issue, 'tail' as column_name, skewness(tail) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1)) as value from o
      union all select 'skewed', 'flat', skewness(flat) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1)) from o
      union all select 'skewed', 'o_totalprice', skewness(o_totalprice) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1)) from o
      union all select 'near_zero_variance', 'tail', var_samp(tail) from o union all select 'near_zero_variance', 'flat', var_samp(flat) from o
      union all select 'near_zero_variance', 'o_totalprice', var_samp(o_totalprice) from o)
select issue, column_name, round(value, 12) as value from m where (issue = 'skewed' and abs(value) > 3) or (issue = 'near_zero_variance' and value < 1e-6)
""")
def moment_issues_planted_orders(spark, sf):
    """Skewed and near-constant columns: a planted long tail and a planted almost flat measure are reported, the price isn't."""
    o = load(spark, sf, "orders").select(F.pow((F.col("o_orderkey") % 100).cast("double") / 100, F.lit(40.0)).alias("tail"),
                                         (1 + (F.col("o_orderkey") % 7).cast("double") / 100000).alias("flat"), "o_totalprice")
    found = [Q.skewed_columns(o).select(F.lit("skewed").alias("issue"), "column_name", F.col("skewness").alias("value")),
             Q.near_zero_variance(o).select(F.lit("near_zero_variance").alias("issue"), "column_name", F.col("variance").alias("value"))]
    return rounded(found[0].unionByName(found[1]), 12)


def _normality_sql():
    from tablens.functions.numeric import inv_norm_cdf_sql, norm_cdf_sql
    phi = inv_norm_cdf_sql("((i - 0.375) / (n + 0.25))")
    return f"""
with s as (select count(value) as n,
                  skewness(value) * (count(value) - 2) / sqrt(count(value) * (count(value) - 1)) as g1,
                  kurtosis_pop(value) as g2 from events),
r as (select value, row_number() over (order by value) as i, count(*) over () as n
      from events where value is not null),
w as (select corr(value, {phi}) as r from r),
z as (select (ln(1 - w.r * w.r) - (-1.2725 + 1.0521 * (ln(ln(s.n)) - ln(s.n)))) / (1.0308 - 0.26758 * (ln(ln(s.n)) + 2.0 / ln(s.n))) as z from s, w)
select 'value' as column_name, cast(s.n as bigint) as n, round(s.n / 6.0 * (g1 * g1 + g2 * g2 / 4.0), 6) as jarque_bera,
       round(exp(-(s.n / 6.0 * (g1 * g1 + g2 * g2 / 4.0)) / 2.0), 6) as jb_pvalue,
       round(w.r * w.r, 6) as shapiro_francia_w, round(1 - {norm_cdf_sql('z.z')}, 6) as sf_pvalue
from s, w, z
"""


@register("normality_events", _normality_sql())
def normality_events(spark, sf):
    """Jarque–Bera from moments and Shapiro–Francia W′ over all values (exact global ranks)."""
    return rounded(S.normality(load(spark, sf, "events"), ["value"]))
