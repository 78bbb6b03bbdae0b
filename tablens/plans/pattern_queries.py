"""Registered density, chart-data, clustering, projection and isolation-forest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablens.operators import density as D
from tablens.operators import iforest as IF
from tablens.operators import ml as M
from tablens.operators import plotdata as V
from tablens.plans.registry import load, r6, register, rounded

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _kde_sql(src: str, group: str | None, curve: bool = False) -> str:
    g, gsel, gjoin, gpart = ("", "", "", "") if group is None else (
        f"{group},", f"v.{group},", f"and w.{group} = s.{group}", f"partition by {group}")
    grp_by = f"{group}," if group else ""
    head = f"""
with v as ({src}),
s as (select {g} count(*) as n, min(value) as lo, max(value) as hi,
             stddev_samp(value) * pow(count(*), -0.2) as h from v {'group by ' + group if group else ''}),
w as (select {g} value, count(*) as w from v group by {grp_by} value),
gr as (select unnest(generate_series(0, 999)) as i),
d as (select {'s.' + group + ',' if group else ''} gr.i,
             case when gr.i = 999 then s.hi else s.lo + gr.i * ((s.hi - s.lo) / 999) end as x,
             sum(w.w * exp(-0.5 * pow(((s.lo + gr.i * ((s.hi - s.lo) / 999)) - w.value) / s.h, 2)))
               / (s.n * s.h * 2.5066282746310002) as density
      from s join w on true {gjoin} cross join gr
      where s.n >= 100
      group by {'s.' + group + ',' if group else ''} gr.i, s.hi, s.lo, s.n, s.h)
"""
    if curve:
        return head + f"""
select {g} 'value' as column_name, cast(i as integer) as i, round(x, 6) as x, round(density, 6) as density from d
"""
    return head + f""",
p as (select *, lag(density) over ({gpart} order by i) as pv, lead(density) over ({gpart} order by i) as nx from d),
m as (select * from p where density > pv and density > nx)
select {g} 'value' as column_name, cast(i as integer) as i, round(x, 6) as x, round(density, 6) as density,
       cast(count(*) over ({gpart}) as bigint) as mode_count
from m
"""


@register("kde_modes_events", _kde_sql("select value from events where value is not null", None))
def kde_modes_events(spark, sf):
    """Gaussian KDE on a 1000-point grid; strict local maxima (multimodality)."""
    return rounded(D.kde_modes(load(spark, sf, "events"), ["value"]))


@register("kde_modes_by_event_type", _kde_sql(
    "select event_type, value from events where value is not null and event_type is not null", "event_type"))
def kde_modes_by_event_type(spark, sf):
    """Per-group density curves and their modes (violin / pair-plot diagonal data)."""
    return rounded(D.kde_modes(load(spark, sf, "events"), ["value"], group="event_type"))


@register("histogram_auto_orders", """
with v as (select o_totalprice as value from orders where o_totalprice is not null),
s as (select count(*) as n, min(value) as lo, max(value) as hi, quantile_cont(value, 0.25) as q1,
             quantile_cont(value, 0.75) as q3 from v),
b as (select *, (hi - lo) / (log2(n) + 1) as sturges, 2 * (q3 - q1) * pow(n, -1.0 / 3.0) as fd from s),
nb as (select *, cast(case when hi - lo > 0 then greatest(1, ceil((hi - lo) / case when fd > 0 then least(sturges, fd)
                                                                             else sturges end)) else 1 end as integer)
                  as nbins from b)
select 'o_totalprice' as column_name, cast(g.bin as integer) as bin, round(lo + g.bin * ((hi - lo) / nbins), 6) as lower,
       round(lo + (g.bin + 1) * ((hi - lo) / nbins), 6) as upper, cast(count(w.bin) as bigint) as count
from nb cross join (select unnest(generate_series(0, (select nbins - 1 from nb))) as bin) g
left join (select cast(least(floor((value - lo) / (hi - lo) * nbins), nbins - 1) as integer) as bin from v, nb) w on w.bin = g.bin
group by g.bin, lo, hi, nbins
""")
def histogram_auto_orders(spark, sf):
    """Histogram with the automatic (Sturges / Freedman–Diaconis) bin count."""
    return rounded(D.histogram(load(spark, sf, "orders"), ["o_totalprice"]))


@register("histogram_fixed_lineitem", """
with l as (select column_name, value from lineitem
           unpivot (value for column_name in (l_quantity, l_extendedprice, l_discount, l_tax))),
s as (select column_name, min(value) as lo, max(value) as hi from l group by 1)
select s.column_name, cast(g.bin as integer) as bin, round(lo + g.bin * ((hi - lo) / 10), 6) as lower,
       round(lo + (g.bin + 1) * ((hi - lo) / 10), 6) as upper, cast(count(l.value) as bigint) as count
from s cross join (select unnest(generate_series(0, 9)) as bin) g
left join l on l.column_name = s.column_name and least(floor((value - lo) / (hi - lo) * 10), 9) = g.bin
group by s.column_name, g.bin, lo, hi
""")
def histogram_fixed_lineitem(spark, sf):
    """Ten equal-width bins per measure."""
    return rounded(D.histogram(load(spark, sf, "lineitem"), LINE_MEASURES, bins=10))


@register("histogram_with_gaps_orders", """
with v as (select case when o_orderkey % 3 = 0 then o_totalprice + 5000000 else o_totalprice end as value from orders),
s as (select min(value) as lo, max(value) as hi from v),
w as (select cast(least(floor((value - lo) / (hi - lo) * 40), 39) as integer) as bin from v, s)
select 'value' as column_name, cast(g.bin as integer) as bin, round(lo + g.bin * ((hi - lo) / 40), 6) as lower,
       round(lo + (g.bin + 1) * ((hi - lo) / 40), 6) as upper, cast(count(w.bin) as bigint) as count
from s cross join (select unnest(generate_series(0, 39)) as bin) g left join w on w.bin = g.bin
group by g.bin, lo, hi
""")
def histogram_with_gaps_orders(spark, sf):
    """Forty equal-width bins over two separated ranges of prices: empty bins are listed."""
    price = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 5000000).otherwise(F.col("o_totalprice"))
    return rounded(D.histogram(load(spark, sf, "orders").select(price.alias("value")), ["value"], bins=40))


@register("density_curve_by_event_type", _kde_sql(
    "select event_type, value from events where value is not null and event_type is not null", "event_type", curve=True))
def density_curve_by_event_type(spark, sf):
    """The whole density curve of every group: all 1000 grid points."""
    return rounded(D.kde_grid(load(spark, sf, "events"), ["value"], group="event_type"))


@register("box_stats_events_by_type", """
with q as (select event_type, count(value) as n, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.5) as med,
                  quantile_cont(value, 0.75) as q3 from events where event_type is not null and value is not null
           group by 1)
select q.event_type, 'value' as column_name, cast(q.n as bigint) as n, round(q1, 6) as q1, round(med, 6) as median,
       round(q3, 6) as q3,
       round(min(e.value) filter (where e.value >= q1 - 1.5 * (q3 - q1)), 6) as whisker_low,
       round(max(e.value) filter (where e.value <= q3 + 1.5 * (q3 - q1)), 6) as whisker_high,
       cast(count(*) filter (where e.value < q1 - 1.5 * (q3 - q1) or e.value > q3 + 1.5 * (q3 - q1)) as bigint)
         as n_fliers
from q join events e on e.event_type = q.event_type group by all
""")
def box_stats_events_by_type(spark, sf):
    """Box statistics per group: quartiles, whiskers, flier counts."""
    return rounded(V.box_stats(load(spark, sf, "events"), ["value"], group="event_type"))


@register("strip_points_orders", """
select o_orderkey, o_orderpriority, 'o_totalprice' as column_name, o_totalprice as value
from orders where o_totalprice is not null
""")
def strip_points_orders(spark, sf):
    """Long point table for strip/swarm plots (no cap)."""
    return V.strip_points(load(spark, sf, "orders"), "o_orderkey", ["o_totalprice"], group="o_orderpriority")


@register("strip_points_capped_orders")
def strip_points_capped_orders(spark, sf):
    """Strip points capped at 50 per group by a seeded hash rank (sampling; rows-only check)."""
    return V.strip_points(load(spark, sf, "orders"), "o_orderkey", ["o_totalprice"], group="o_orderpriority",
                          cap=50)


@register("pair_points_part", """
select p_partkey, 'p_size' as x_col, 'p_retailprice' as y_col, cast(p_size as double) as x, p_retailprice as y
from part
union all
select p_partkey, 'p_retailprice', 'p_size', p_retailprice, cast(p_size as double) from part
""")
def pair_points_part(spark, sf):
    """Scatter-matrix cells for every ordered column pair (full table)."""
    return V.pair_points(load(spark, sf, "part"), "p_partkey", ["p_size", "p_retailprice"], sample=None)


@register("pair_points_sampled_part")
def pair_points_sampled_part(spark, sf):
    """Scatter-matrix cells of a 100-row hash sample, lower half (sampling; rows-only check)."""
    return V.pair_points(load(spark, sf, "part"), "p_partkey", ["p_size", "p_retailprice"], lower_only=True)


@register("scatter_points_orders", """
select o_orderkey, o_totalprice, o_custkey, o_orderpriority from orders
""")
def scatter_points_orders(spark, sf):
    """Scatter projection with a colour column."""
    return V.scatter_points(load(spark, sf, "orders"), "o_orderkey", ["o_totalprice", "o_custkey"],
                            extra=["o_orderpriority"])


@register("parallel_coordinates_lineitem", """
with m as (select l_returnflag, cast(dense_rank() over (order by l_returnflag) - 1 as integer) as code
           from (select distinct l_returnflag from lineitem where l_returnflag is not null))
select l.l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax, coalesce(m.code, -1) as l_returnflag_code
from lineitem l left join m on l.l_returnflag = m.l_returnflag
""")
def parallel_coordinates_lineitem(spark, sf):
    """Rows with the label code for parallel coordinates."""
    return V.parallel_coordinates(load(spark, sf, "lineitem"), "l_returnflag", LINE_MEASURES)


@register("radar_lineitem", """
select l_returnflag, column_name, round(mean, 6) as mean from (
  select l_returnflag, avg(l_quantity) as l_quantity, avg(l_extendedprice) as l_extendedprice,
         avg(l_discount) as l_discount, avg(l_tax) as l_tax from lineitem where l_returnflag is not null group by 1)
unpivot (mean for column_name in (l_quantity, l_extendedprice, l_discount, l_tax))
""")
def radar_lineitem(spark, sf):
    """Group means in long form (radar chart)."""
    return rounded(V.radar(load(spark, sf, "lineitem"), "l_returnflag", LINE_MEASURES))


@register("heatmap_cells_customer", """
with c as (select corr(c_acctbal, c_nationkey) as r from customer)
select 'c_acctbal' as col1, 'c_acctbal' as col2, 1.0 as corr union all
select 'c_nationkey', 'c_nationkey', 1.0 union all
select 'c_acctbal', 'c_nationkey', round(r, 6) from c union all
select 'c_nationkey', 'c_acctbal', round(r, 6) from c
""")
def heatmap_cells_customer(spark, sf):
    """Correlation heat-map cells (full symmetric matrix)."""
    return rounded(V.heatmap_cells(load(spark, sf, "customer"), ["c_acctbal", "c_nationkey"]))


@register("time_lines_events_daily", """
select make_timestamp(floor(epoch_us(ts) / 86400000000)::bigint * 86400000000) as ts, 'value' as column_name,
       round(avg(value), 6) as value
from events where ts is not null and value is not null group by 1
""")
def time_lines_events_daily(spark, sf):
    """Time-series line data, daily bucket means, ordered by time."""
    return rounded(V.time_lines(load(spark, sf, "events"), "ts", ["value"], step_seconds=86400))


@register("category_bars_orders", """
select column_name, value, cast(count(*) as bigint) as count from (
  select 'o_orderstatus' as column_name, o_orderstatus as value from orders union all
  select 'o_orderpriority', o_orderpriority from orders) where value is not null group by 1, 2
""")
def category_bars_orders(spark, sf):
    """Bar data for text columns with fewer than 15 levels."""
    return V.category_bars(load(spark, sf, "orders"))


# ---------------------------------------------------------------- clustering / projection

def _embeddings(spark, sf, dims):
    e = load(spark, sf, "embeddings")
    return M.array_columns(e, "embedding", dims)


@register("cluster_profile_embeddings", """
with e as (select label as cluster, unnest(generate_series(0, 63)) as d, unnest(embedding) as v from embeddings),
n as (select label as cluster, count(*) as size, count(*) * 100.0 / sum(count(*)) over () as pct from embeddings group by 1)
select e.cluster, cast(size as bigint) as size, round(pct, 6) as pct, 'f' || d as column_name, round(avg(cast(v as double)), 6) as mean,
       round(stddev_samp(cast(v as double)), 6) as std
from e join n on e.cluster = n.cluster group by all
""")
def cluster_profile_embeddings(spark, sf):
    """Per-cluster size, share, mean and std (given labels as the cluster assignment)."""
    e, cols = _embeddings(spark, sf, 64)
    assign = e.select("vec_id", F.col("label").alias("cluster"))
    return rounded(M.cluster_profile(e, assign, "vec_id", cols))


@register("cluster_importance_embeddings", """
with e as (select label, unnest(generate_series(0, 63)) as d, embedding from embeddings),
c as (select label, d, avg(embedding[d + 1]) as center from e group by 1, 2),
r as (select d, max(center) - min(center) as range from c group by 1)
select 'f' || d as column_name, round(case when sum(range) over () > 0 then range / sum(range) over ()
                                      else 1.0 / count(*) over () end, 6) as importance
from r
""")
def cluster_importance_embeddings(spark, sf):
    """Feature importance from the spread of cluster centres (given labels)."""
    e, cols = _embeddings(spark, sf, 64)
    assign = e.select("vec_id", F.col("label").alias("cluster"))
    return rounded(M.cluster_feature_importance(M.cluster_centers(e, assign, "vec_id", cols)))


@register("ols_lineitem_by_returnflag", """
select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) as slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) as intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) as r2, cast(regr_count(l_extendedprice, l_quantity) as bigint) as n
from lineitem where l_returnflag is not null group by 1
""")
def ols_lineitem_by_returnflag(spark, sf):
    """OLS trend line per group (slope, intercept, r², n)."""
    return rounded(M.ols_by_group(load(spark, sf, "lineitem"), "l_extendedprice", "l_quantity", "l_returnflag")
                   .withColumn("n", F.col("n").cast("long")))


@register("second_difference_monthly_orders", """
with c as (select month(o_orderdate) as k, cast(count(*) as double) as inertia from orders group by 1)
select k, inertia, lead(inertia, 2) over (order by k) - 2 * lead(inertia, 1) over (order by k) + inertia as second_diff
from c
""")
def second_difference_monthly_orders(spark, sf):
    """Second difference of a short curve (the elbow rule's kink test) on monthly order counts."""
    o = load(spark, sf, "orders")
    c = o.groupBy(F.month("o_orderdate").cast("bigint").alias("k")) \
        .agg(F.count(F.lit(1)).cast("double").alias("inertia"))
    return M.second_difference(c)


@register("kmeans_embeddings")
def kmeans_embeddings(spark, sf):
    """k-means (k = 10, best of the default number of starts) on standardised embeddings (rows-only check)."""
    e, cols = _embeddings(spark, sf, 64)
    return M.cluster(e, cols, "vec_id", k=10)


@register("elbow_curve_embeddings")
def elbow_curve_embeddings(spark, sf):
    """Inertia curve up to the default number of clusters and its second difference (rows-only check)."""
    e, cols = _embeddings(spark, sf, 64)
    z = M.standardize(e, cols, ["vec_id"])
    return M.second_difference(M.inertia_curve(z, cols))


@register("elbow_choice_embeddings")
def elbow_choice_embeddings(spark, sf):
    """The number of clusters that the elbow rule chooses, with the inertia there (rows-only check)."""
    e, cols = _embeddings(spark, sf, 64)
    curve = M.inertia_curve(M.standardize(e, cols, ["vec_id"]), cols)
    return curve.where(F.col("k") == M.elbow_k(curve))


@register("silhouette_embeddings", """
with e as (select vec_id, label, cast(embedding as double[]) as x from embeddings),
s as (select * from e order by md5(cast(vec_id as varchar)) limit 1000),
d as (select s.vec_id, s.label, e.label as other, sum(list_distance(s.x, e.x)) as total, count(*) as n from s, e group by all),
m as (select vec_id, max(case when label = other then case when n > 1 then total / (n - 1) end end) as a, min(case when label <> other then total / n end) as b
      from d group by vec_id)
select round(avg(case when a is null then 0 else (b - a) / greatest(a, b) end), 6) as silhouette from m
""")
def silhouette_embeddings(spark, sf):
    """Mean Euclidean silhouette of the given labels as clusters, over 1000 rows against all."""
    e, cols = _embeddings(spark, sf, 64)
    s = M.silhouette(e, e.select("vec_id", F.col("label").alias("cluster")), "vec_id", cols)
    return spark.range(1).select(r6(F.lit(s).cast("double")).alias("silhouette"))


@register("pca_components_embeddings")
def pca_components_embeddings(spark, sf):
    """Two standardised principal components: loadings and explained-variance ratio (rows-only check)."""
    e, cols = _embeddings(spark, sf, 64)
    _, comps = M.pca(e, cols, "vec_id", k=2)
    return comps


@register("pca_scores_orders")
def pca_scores_orders(spark, sf):
    """Unscaled PCA with mean-filled gaps: projected scores per row (rows-only check)."""
    li = load(spark, sf, "lineitem").withColumn("row_id", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"))
    scores, _ = M.pca(li, LINE_MEASURES, "row_id", k=2, scale=False, fill_mean=True)
    return scores


@register("isolation_forest_events")
def isolation_forest_events(spark, sf):
    """Isolation forest on standardised (value, user_id): 100 trees, ψ = 256, 5 % contamination."""
    ev = load(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("double"))
    return IF.isolation_forest(ev, ["value", "user_id"], "event_id")


@register("forest_record_events")
def forest_record_events(spark, sf):
    """Flagged rows and decision range of the isolation forest per event type (rows-only check)."""
    ev = load(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("double"))
    scored = IF.isolation_forest_by_group(ev, ["value", "user_id"], "event_id", "event_type")
    return rounded(IF.anomaly_record(scored, "event_type"))


@register("isolation_forest_raw_orders")
def isolation_forest_raw_orders(spark, sf):
    """Isolation forest on raw columns (no scaling), flagged keys only."""
    o = load(spark, sf, "orders").withColumn("o_custkey", F.col("o_custkey").cast("double"))
    r = IF.isolation_forest(o, ["o_totalprice", "o_custkey"], "o_orderkey", standardise=False)
    return r.filter("is_outlier").select("o_orderkey", "anomaly_score")


@register("isolation_forest_by_event_type")
def isolation_forest_by_event_type(spark, sf):
    """One isolation forest per event_type on raw (value, user_id); 5 % flagged per group (rows-only)."""
    ev = load(spark, sf, "events").withColumn("user_id", F.col("user_id").cast("double"))
    return IF.isolation_forest_by_group(ev, ["value", "user_id"], "event_id", "event_type")
