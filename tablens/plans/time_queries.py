"""Registered time-pattern queries: calendar counts, gaps, resampling, decomposition, periodicity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablens.operators import timeseries as TS
from tablens.plans.registry import load, register, rounded

HOUR_US = 3_600_000_000
DAY_US = 86_400_000_000


def _resampled_sql(src: str, step_us: int, series_filter: str = "") -> str:
    """DuckDB text of the reference semantics: bucket mean, full grid, linear interpolation."""
    return f"""
b as (select floor(epoch_us(ts) / {step_us})::bigint as bk, avg(v) as y from ({src}) x
      where ts is not null and v is not null {series_filter} group by 1),
g as (select unnest(generate_series((select min(bk) from b), (select max(bk) from b))) as bk),
j as (select g.bk, b.y from g left join b on g.bk = b.bk),
f as (select bk, y,
        last_value(case when y is not null then bk end ignore nulls)
          over (order by bk rows between unbounded preceding and current row) as pbk,
        last_value(y ignore nulls) over (order by bk rows between unbounded preceding and current row) as py,
        first_value(case when y is not null then bk end ignore nulls)
          over (order by bk rows between current row and unbounded following) as nbk,
        first_value(y ignore nulls) over (order by bk rows between current row and unbounded following) as ny
      from j),
r as (select bk - (select min(bk) from b) as t, make_timestamp(bk * {step_us}) as bucket_ts,
             case when y is not null then y else py + (bk - pbk) * (ny - py) / (nbk - pbk) end as y,
             y is not null as populated
      from f)"""


def click_hourly(spark, sf):
    ev = load(spark, sf, "events").filter(F.col("event_type") == "click")
    return TS.resample(ev, "ts", "value", 3600)


def orders_daily(spark, sf):
    return TS.resample(load(spark, sf, "orders"), "o_orderdate", "o_totalprice", 86400)


_CLICK_SRC = "select ts, value as v from events where event_type = 'click'"
_ORDERS_SRC = "select o_orderdate as ts, o_totalprice as v from orders"


@register("calendar_counts_events", """
select unit, value, cast(count(*) as bigint) as count from (
  select 'hour' as unit, hour(ts) as value from events union all
  select 'day', day(ts) from events union all
  select 'weekday', isodow(ts) - 1 from events union all
  select 'month', month(ts) from events union all
  select 'year', year(ts) from events) where value is not null
group by 1, 2
""")
def calendar_counts_events(spark, sf):
    """Row counts by hour / day / weekday (Monday = 0) / month / year, one scan."""
    return TS.calendar_counts(load(spark, sf, "events"), "ts").select(
        "unit", F.col("value").cast("bigint").alias("value"), "count")


@register("monthly_means_orders", """
select month(o_orderdate) as month, 'o_totalprice' as column_name, round(avg(o_totalprice), 6) as mean
from orders where o_orderdate is not null group by 1
""")
def monthly_means_orders(spark, sf):
    """Mean of a measure per calendar month."""
    return rounded(TS.monthly_means(load(spark, sf, "orders"), "o_orderdate", ["o_totalprice"])
                   .select(F.col("month").cast("bigint").alias("month"), "column_name", "mean"))


_GAPS_SQL = """
with g as (select {key} (epoch_us({ts}) - lag(epoch_us({ts})) over (partition by {part} order by {ts})) / 1e6 as gap
           from {src} where {ts} is not null),
s as (select {key} cast(count(gap) as bigint) as n_gaps, avg(gap) as m, stddev_pop(gap) as sd,
             cast(count(distinct gap) as bigint) as distinct_gaps, max(gap) as mx
      from g where gap is not null group by {grp})
select {key} n_gaps, round(m, 6) as mean_interval_seconds, round(sd, 6) as std_interval_seconds,
       round(1 - least(1, sd / (m + 1e-10)), 6) as regularity, distinct_gaps,
       round(case when distinct_gaps = 1 then mx end, 6) as step_seconds, cast(null as varchar) as calendar
from s
"""


@register("gap_stats_events", _GAPS_SQL.format(key="", ts="ts", part="1", src="events", grp="()"))
def gap_stats_events(spark, sf):
    """Mean / population std of consecutive gaps and regularity over the whole table."""
    return rounded(TS.gap_stats(load(spark, sf, "events"), "ts"))


@register("gap_stats_orders_by_status", _GAPS_SQL.format(key="o_orderstatus,", ts="o_orderdate",
                                                         part="o_orderstatus", src="orders", grp="o_orderstatus"))
def gap_stats_orders_by_status(spark, sf):
    """Per-series gap statistics with repeated timestamps (zero gaps)."""
    return rounded(TS.gap_stats(load(spark, sf, "orders"), "o_orderdate", "o_orderstatus"))


@register("regularity_click_hourly", "with " + _resampled_sql(_CLICK_SRC, HOUR_US)[1:] + """,
gp as (select (epoch_us(bucket_ts) - lag(epoch_us(bucket_ts)) over (order by bucket_ts)) / 1e6 as gap from r)
select cast(count(gap) as bigint) as n_gaps, round(avg(gap), 6) as mean_interval_seconds,
       round(stddev_pop(gap), 6) as std_interval_seconds,
       round(1 - least(1, stddev_pop(gap) / (avg(gap) + 1e-10)), 6) as regularity,
       cast(count(distinct gap) as bigint) as distinct_gaps,
       round(case when count(distinct gap) = 1 then max(gap) end, 6) as step_seconds, cast(null as varchar) as calendar
from gp where gap is not null
""")
def regularity_click_hourly(spark, sf):
    """A resampled series is regular: one distinct gap, step 3600 s."""
    return rounded(TS.gap_stats(click_hourly(spark, sf), "bucket_ts"))


# Stand-in input: the month, quarter and month-end dates, the weekdays and all days on which orders were placed, each a series of its own.
_CALENDAR_SQL = """
with d as (select distinct cast(o_orderdate as date) as d from orders where o_orderdate is not null),
t as (select distinct 'month' as kind, cast(date_trunc('month', d) as date) as d from d
      union all select distinct 'quarter', cast(date_trunc('quarter', d) as date) from d
      union all select distinct 'month end', last_day(d) from d
      union all select 'weekday', d from d where isodow(d) < 6 union all select 'day', d from d),
g as (select kind, d, datediff('day', lag(d) over (partition by kind order by d), d) * 86400.0::double as gap from t),
o as (select kind, d, case kind when 'month' then year(d) * 12 + month(d) when 'month end' then year(d) * 12 + month(d) when 'quarter' then year(d) * 4 + quarter(d)
             else datediff('day', date '1969-12-29', d) // 7 * 5 + isodow(d) end as pos from t),
c as (select kind, case when kind <> 'day' and max(pos) - min(pos) + 1 = count(*) then
             case kind when 'month' then 'month start' when 'month end' then 'month end' when 'quarter' then 'quarter start' else 'business day' end end as calendar from o group by kind)
select kind, cast(count(gap) as bigint) as n_gaps, round(avg(gap), 6) as mean_interval_seconds, round(stddev_pop(gap), 6) as std_interval_seconds,
       round(case when count(distinct gap) > 1 and any_value(calendar) is not null then 1.0 else 1 - least(1, stddev_pop(gap) / (avg(gap) + 1e-10)) end, 6) as regularity,
       cast(count(distinct gap) as bigint) as distinct_gaps, round(case when count(distinct gap) = 1 then max(gap) end, 6) as step_seconds,
       case when count(distinct gap) > 1 then any_value(calendar) end as calendar
from g join c using (kind) where gap is not null group by kind
"""


@register("calendar_regularity_orders", _CALENDAR_SQL)
def calendar_regularity_orders(spark, sf):
    """Month starts, quarter starts, month ends and weekdays are calendar steps although their gaps differ."""
    d = load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d")).where(F.col("d").isNotNull()).distinct()
    kind = lambda name, x: d.select(F.lit(name).alias("kind"), x.alias("d")).distinct()
    t = kind("month", F.trunc("d", "month")).unionByName(kind("quarter", F.trunc("d", "quarter"))).unionByName(kind("month end", F.last_day("d")))
    t = t.unionByName(kind("weekday", F.col("d")).where(F.weekday("d") < 5)).unionByName(kind("day", F.col("d")))
    return rounded(TS.gap_stats(t.select("kind", F.col("d").cast("timestamp").alias("ts")), "ts", "kind"))


@register("resample_step_events", """
with a as (select event_type, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 as range_seconds,
                  count(*) as n from events where ts is not null group by 1)
select event_type, round(range_seconds, 6) as range_seconds, cast(n as bigint) as n,
       round(range_seconds / n, 6) as avg_interval_seconds,
       case when range_seconds / n < 60 then 1 when range_seconds / n < 3600 then 60
            when range_seconds / n < 86400 then 3600 else 86400 end as step_seconds,
       case when range_seconds / n < 60 then '1s' when range_seconds / n < 3600 then '1min'
            when range_seconds / n < 86400 then '1h' else '1d' end as freq
from a
""")
def resample_step_events(spark, sf):
    """Resampling step chosen from the average spacing, per series."""
    return rounded(TS.choose_step(load(spark, sf, "events"), "ts", "event_type"))


@register("resample_click_hourly", "with " + _resampled_sql(_CLICK_SRC, HOUR_US)[1:] + """
select t, bucket_ts, round(y, 6) as value, populated from r
""")
def resample_click_hourly(spark, sf):
    """Hourly mean of click values, empty hours linearly interpolated."""
    return rounded(click_hourly(spark, sf))


@register("decompose_orders_daily", "with " + _resampled_sql(_ORDERS_SRC, DAY_US)[1:] + """,
tr as (select t, y, case when count(*) over w = 7 then avg(y) over w end as trend
       from r window w as (order by t rows between 3 preceding and 3 following)),
ph as (select t % 7 as phase, avg(y - trend) as pm from tr group by 1),
s as (select phase, pm - avg(pm) over () as seasonal from ph)
select t, round(y, 6) as observed, round(trend, 6) as trend, round(seasonal, 6) as seasonal,
       round(y - trend - seasonal, 6) as resid
from tr join s on tr.t % 7 = s.phase
""")
def decompose_orders_daily(spark, sf):
    """Additive decomposition (period 7) of the daily order-value series."""
    return rounded(TS.decompose(orders_daily(spark, sf), 7))


@register("decompose_click_hourly_even", "with " + _resampled_sql(_CLICK_SRC, HOUR_US)[1:] + """,
tr as (select t, y, case when count(*) over w = 25
                         then (sum(y) over w - 0.5 * first_value(y) over w - 0.5 * last_value(y) over w) / 24 end
                    as trend
       from r window w as (order by t rows between 12 preceding and 12 following)),
ph as (select t % 24 as phase, avg(y - trend) as pm from tr group by 1),
s as (select phase, pm - avg(pm) over () as seasonal from ph)
select t, round(y, 6) as observed, round(trend, 6) as trend, round(seasonal, 6) as seasonal,
       round(y - trend - seasonal, 6) as resid
from tr join s on tr.t % 24 = s.phase
""")
def decompose_click_hourly_even(spark, sf):
    """Additive decomposition with an even period (24, 2×MA trend)."""
    return rounded(TS.decompose(click_hourly(spark, sf), 24))


@register("dominant_periods_click_hourly", "with " + _resampled_sql(_CLICK_SRC, HOUR_US)[1:] + """,
s as (select count(*) as n, avg(y) as m from r),
k as (select unnest(generate_series(1, (select n // 2 - 1 from s))) as k),
p as (select k.k, sum((r.y - s.m) * cos(2 * pi() * k.k * r.t / s.n)) as re,
             sum((r.y - s.m) * sin(2 * pi() * k.k * r.t / s.n)) as im
      from r, s, k group by k.k),
pw as (select k, re * re + im * im as power from p),
th as (select quantile_cont(power, 0.95) as threshold from pw)
select k, round(k / n, 6) as frequency, round(n / k, 6) as period, round(power, 2) as power,
       round(threshold, 2) as threshold
from pw, th, s where power > threshold
""")
def dominant_periods_click_hourly(spark, sf):
    """DFT power of the hourly series; bins above the 95th percentile of bins 1 … n/2 − 1."""
    d = TS.dominant_periods(click_hourly(spark, sf))
    return d.select("k", F.round("frequency", 6).alias("frequency"), F.round("period", 6).alias("period"),
                    F.round("power", 2).alias("power"), F.round("threshold", 2).alias("threshold"))


@register("dominant_periods_click_minutely")
def dominant_periods_click_minutely(spark, sf):
    """Per-minute click series (≈43 k buckets) through the distributed four-step FFT
    (rows-only: an O(n²) SQL DFT is too slow here; tests compare FFT with the exact DFT)."""
    ev = load(spark, sf, "events").filter(F.col("event_type") == "click")
    d = TS.dominant_periods(TS.resample(ev, "ts", "value", 60), top=3, order="power")
    return d.select("k", F.round("period", 6).alias("period"), F.round("power", 2).alias("power"))


_SERIES_SQL = f"""with b as (select event_type, floor(epoch_us(ts) / {HOUR_US})::bigint as bk, avg(value) as y from events
  where ts is not null and value is not null and event_type is not null group by 1, 2),
m as (select event_type, min(bk) as lo, max(bk) as hi from b group by 1),
g as (select event_type, lo, unnest(generate_series(lo, hi)) as bk from m),
j as (select g.*, b.y from g left join b on g.event_type = b.event_type and g.bk = b.bk),
f as (select *, last_value(case when y is not null then bk end ignore nulls) over p as pbk, last_value(y ignore nulls) over p as py,
             first_value(case when y is not null then bk end ignore nulls) over n as nbk, first_value(y ignore nulls) over n as ny
      from j window p as (partition by event_type order by bk rows between unbounded preceding and current row),
                    n as (partition by event_type order by bk rows between current row and unbounded following)),
r as (select event_type, bk - lo as t, make_timestamp(bk * {HOUR_US}) as bucket_ts, y is not null as populated,
             case when y is not null then y else py + (bk - pbk) * (ny - py) / (nbk - pbk) end as y from f)"""


def hourly_by_type(spark, sf):
    return TS.resample(load(spark, sf, "events"), "ts", "value", 3600, series="event_type")


@register("resample_hourly_by_event_type", _SERIES_SQL + """
select event_type, t, bucket_ts, round(y, 6) as value, populated from r
""")
def resample_hourly_by_event_type(spark, sf):
    """Hourly means of every event type on its own complete grid, gaps interpolated."""
    return rounded(hourly_by_type(spark, sf)).select("event_type", "t", "bucket_ts", "value", "populated")


@register("decompose_hourly_by_event_type", _SERIES_SQL + """,
tr as (select event_type, t, y, case when count(*) over w = 25
         then (sum(y) over w - 0.5 * first_value(y) over w - 0.5 * last_value(y) over w) / 24 end as trend
       from r window w as (partition by event_type order by t rows between 12 preceding and 12 following)),
ph as (select event_type, t % 24 as phase, avg(y - trend) as pm from tr group by 1, 2),
s as (select event_type, phase, pm - avg(pm) over (partition by event_type) as seasonal from ph)
select tr.event_type, t, round(y, 6) as observed, round(trend, 6) as trend, round(seasonal, 6) as seasonal,
       round(y - trend - seasonal, 6) as resid
from tr join s on tr.event_type = s.event_type and tr.t % 24 = s.phase
""")
def decompose_hourly_by_event_type(spark, sf):
    """Additive decomposition (period 24) of every event type's hourly series."""
    return rounded(TS.decompose(hourly_by_type(spark, sf), 24, series="event_type"))


@register("dominant_periods_hourly_by_event_type", _SERIES_SQL + """,
s as (select event_type, count(*) as n, avg(y) as m from r group by 1),
k as (select event_type, n, m, unnest(generate_series(1, n // 2 - 1)) as k from s),
p as (select k.event_type, k.n, k.k, sum((r.y - k.m) * cos(2 * pi() * k.k * r.t / k.n)) as re,
             sum((r.y - k.m) * sin(2 * pi() * k.k * r.t / k.n)) as im
      from k join r on r.event_type = k.event_type group by all),
pw as (select event_type, n, k, re * re + im * im as power from p),
th as (select event_type, quantile_cont(power, 0.95) as threshold from pw group by 1)
select pw.event_type, k, round(k / n, 6) as frequency, round(n / k, 6) as period, round(power, 2) as power
from pw join th on pw.event_type = th.event_type where power > threshold
""")
def dominant_periods_hourly_by_event_type(spark, sf):
    """Dominant frequency bins of every event type's hourly series, by FFT."""
    d = TS.dominant_periods(hourly_by_type(spark, sf), series="event_type")
    return d.select("event_type", "k", F.round("frequency", 6).alias("frequency"), F.round("period", 6).alias("period"),
                    F.round("power", 2).alias("power"))


@register("regularity_hourly_by_event_type", _SERIES_SQL + """,
gp as (select event_type, (epoch_us(bucket_ts) - lag(epoch_us(bucket_ts)) over (partition by event_type order by bucket_ts)) / 1e6 as gap from r)
select event_type, cast(count(gap) as bigint) as n_gaps, round(avg(gap), 6) as mean_interval_seconds,
       round(stddev_pop(gap), 6) as std_interval_seconds,
       round(1 - least(1, stddev_pop(gap) / (avg(gap) + 1e-10)), 6) as regularity,
       cast(count(distinct gap) as bigint) as distinct_gaps,
       round(case when count(distinct gap) = 1 then max(gap) end, 6) as step_seconds, cast(null as varchar) as calendar
from gp where gap is not null group by event_type
""")
def regularity_hourly_by_event_type(spark, sf):
    """Every event type's resampled series is regular: one distinct gap, step 3600 s."""
    return rounded(TS.gap_stats(hourly_by_type(spark, sf), "bucket_ts", "event_type"))


@register("dominant_periods_minutely_by_event_type")
def dominant_periods_minutely_by_event_type(spark, sf):
    """Every event type's per-minute series (about 43,000 buckets each) through the distributed four-step FFT
    (rows-only: an O(n²) SQL DFT is too slow here; tests compare FFT with the exact DFT)."""
    d = TS.dominant_periods(TS.resample(load(spark, sf, "events"), "ts", "value", 60, series="event_type"), series="event_type", top=3, order="power")
    return d.select("event_type", "k", F.round("period", 6).alias("period"), F.round("power", 2).alias("power"))
