"""Registered queries for sources, column selection, derived features, encoding, scaling and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablens.operators import cleaning as C
from tablens.operators import features as FE
from tablens.operators import roles as R
from tablens.plans.profile_queries import (_EVENTS_NULLS_SQL, _EVENTS_REPEATS_SQL, events_with_nulls,
                                           events_with_repeats)
from tablens.plans.registry import load, register, rounded
from tablens.sources import io as IO

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ---------------------------------------------------------------- sources

@register("load_validated_customer", "select * from customer")
def load_validated_customer(spark, sf):
    """Parquet load through the validating loader (required columns, non-empty)."""
    return IO.load_table(spark, f"{sf}/customer.parquet", "parquet",
                         required=["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])


@register("contract_report_customer", """
select 'required_columns' as "check", true as passed, '' as detail
union all
select 'non_empty', count(*) > 0, case when count(*) > 0 then '' else 'no rows' end from customer
""")
def contract_report_customer(spark, sf):
    """Schema contract as a table: required columns and non-emptiness."""
    return IO.contract_report(load(spark, sf, "customer"), ["c_custkey", "c_acctbal"])


@register("sample_orders")
def sample_orders(spark, sf):
    """Deterministic 100-row hash sample of orders (sampling is the feature; rows-only check)."""
    return IO.sample_rows(load(spark, sf, "orders"), 100, key=["o_orderkey"], seed=42)


# ---------------------------------------------------------------- projections

@register("select_features_orders", "select * exclude (o_custkey) from orders")
def select_features_orders(spark, sf):
    """Drop an exclude list (unknown names only warn)."""
    return FE.select_features(load(spark, sf, "orders"), exclude=["o_custkey", "not_a_column"])


@register("ratio_features_lineitem", """
select l_orderkey, l_linenumber,
       round(l_extendedprice / (l_quantity + 1e-9), 6) as price_ratio,
       round(l_quantity * l_discount, 6) as price_area,
       round(case when l_discount = 0 then null else l_tax / l_discount end, 6) as tax_discount_ratio
from lineitem
""")
def ratio_features_lineitem(spark, sf):
    """Ratio with epsilon, product feature, plain ratio with zero divisor → NULL."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_MEASURES)
    out = FE.engineer_features(li, [("price", "l_extendedprice", "l_quantity")], products=False)
    out = FE.add_product(out, "l_quantity", "l_discount", "price_area")
    out = FE.add_ratio(out, "l_tax", "l_discount", "tax_discount_ratio", epsilon=None)
    return rounded(out.select("l_orderkey", "l_linenumber", "price_ratio", "price_area", "tax_discount_ratio"))


@register("label_encoding_part", """
select p_partkey, p_brand, cast(dense_rank() over (order by p_brand) - 1 as integer) as p_brand_encoded from part
""")
def label_encoding_part(spark, sf):
    """Sorted distinct labels → 0..k−1, applied by broadcast join."""
    p = load(spark, sf, "part").select("p_partkey", "p_brand")
    return FE.encode_labels(p, FE.fit_label_encoder(p, "p_brand"), "p_brand")


@register("label_decode_part", """
with m as (select distinct p_type as label, cast(dense_rank() over (order by p_type) - 1 as integer) as code from part)
select p.p_partkey, m.code as code, m.label as label from part p join m on p.p_type = m.label
""")
def label_decode_part(spark, sf):
    """Encode then decode through the fitted mapping (inverse lookup join)."""
    p = load(spark, sf, "part").select("p_partkey", "p_type")
    m = FE.fit_label_encoder(p, "p_type")
    enc = FE.encode_labels(p, m, "p_type", "code")
    return FE.decode_labels(enc.select("p_partkey", "code"), m, "code").select("p_partkey", "code", "label")


@register("category_codes_events", f"""
with e as ({_EVENTS_NULLS_SQL}),
m as (select event_type, cast(dense_rank() over (order by event_type) - 1 as integer) as code
      from (select distinct event_type from e where event_type is not null))
select e.event_id, e.event_type, coalesce(m.code, -1) as event_type_encoded
from e left join m on e.event_type = m.event_type
""")
def category_codes_events(spark, sf):
    """Categorical codes with missing → −1."""
    e = events_with_nulls(spark, sf).select("event_id", "event_type")
    return FE.category_codes(e, "event_type")


@register("standard_scaled_lineitem", """
with s as (select avg(l_quantity) as mq, stddev_pop(l_quantity) as sq, avg(l_extendedprice) as me,
                  stddev_pop(l_extendedprice) as se, avg(l_discount) as md, stddev_pop(l_discount) as sd,
                  avg(l_tax) as mt, stddev_pop(l_tax) as st from lineitem)
select l_orderkey, l_linenumber,
       round((l_quantity - mq) / case when sq = 0 then 1 else sq end, 6) as l_quantity,
       round((l_extendedprice - me) / case when se = 0 then 1 else se end, 6) as l_extendedprice,
       round((l_discount - md) / case when sd = 0 then 1 else sd end, 6) as l_discount,
       round((l_tax - mt) / case when st = 0 then 1 else st end, 6) as l_tax
from lineitem, s
""")
def standard_scaled_lineitem(spark, sf):
    """Standard scaling with population std (zero std → divisor 1); one-row stats broadcast."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_MEASURES)
    scaled, _ = FE.scale_features(li, "standard", LINE_MEASURES)
    return rounded(scaled)


@register("minmax_scaled_part", """
with s as (select min(p_retailprice) as a, max(p_retailprice) - min(p_retailprice) as r,
                  min(p_size) as b, max(p_size) - min(p_size) as q from part)
select p_partkey, round((p_retailprice - a) / case when r = 0 then 1 else r end, 6) as p_retailprice,
       round((p_size - b) / case when q = 0 then 1 else q end, 6) as p_size
from part, s
""")
def minmax_scaled_part(spark, sf):
    """Min-max scaling to [0, 1] (constant column → 0)."""
    p = load(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")
    scaled, _ = FE.scale_features(p, "minmax", ["p_retailprice", "p_size"])
    return rounded(scaled)


@register("inverse_scaled_part", """
select p_partkey, round(p_retailprice, 6) as p_retailprice from part
""")
def inverse_scaled_part(spark, sf):
    """Scale then invert with the kept statistics (round trip)."""
    p = load(spark, sf, "part").select("p_partkey", "p_retailprice")
    scaled, stats = FE.scale_features(p, "standard", ["p_retailprice"])
    return rounded(FE.inverse_scale(scaled, stats, ["p_retailprice"]))


@register("rounded_measures_events", """
select event_id, round_even(value, 1) as value from events
""")
def rounded_measures_events(spark, sf):
    """Half-even rounding of measures to 1 decimal."""
    return FE.round_columns(load(spark, sf, "events").select("event_id", "value"), ["value"], 1)


@register("coerce_numeric_events", """
select event_id,
       case when regexp_matches(mixed, '^\\s*[+-]?((\\d+\\.?\\d*)|(\\.\\d+))([eE][+-]?\\d+)?\\s*$')
            then try_cast(mixed as double) end as mixed
from (select event_id, case when event_id % 5 = 0 then cast(value as varchar) else event_type end as mixed
      from events)
""")
def coerce_numeric_events(spark, sf):
    """Text → number with junk → NULL."""
    ev = load(spark, sf, "events")
    e = ev.select("event_id", F.when(F.col("event_id") % 5 == 0, F.col("value").cast("string"))
                  .otherwise(F.col("event_type")).alias("mixed"))
    return FE.coerce_numeric(e, ["mixed"])


@register("clipped_orders", """
select o_orderkey, case when o_totalprice < 1000 then 1000.0 when o_totalprice > 300000 then 300000.0
                        else o_totalprice end as o_totalprice
from orders
""")
def clipped_orders(spark, sf):
    """Clip to fixed bounds."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return FE.clip_columns(o, {"o_totalprice": (1000.0, 300000.0)})


@register("melted_lineitem", """
select l_orderkey, l_linenumber, variable, value from lineitem
unpivot include nulls (value for variable in (l_quantity, l_extendedprice, l_discount, l_tax))
""")
def melted_lineitem(spark, sf):
    """Wide → long over the numeric measures."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_MEASURES)
    return FE.melt(li, ["l_orderkey", "l_linenumber"], LINE_MEASURES)


@register("column_roles_orders", """
with o as (select *, cast(o_orderdate as varchar) as o_orderdate_text from orders),
p as (select count_if(o_orderstatus is not null and try_cast(o_orderstatus as timestamp) is null) as s1,
             count_if(o_orderpriority is not null and try_cast(o_orderpriority as timestamp) is null) as s2,
             count_if(o_orderdate_text is not null and try_cast(o_orderdate_text as timestamp) is null) as s3 from o)
select * from (values
  ('o_orderkey', 'bigint', 'numeric', false, false),
  ('o_custkey', 'bigint', 'numeric', false, false),
  ('o_totalprice', 'double', 'numeric', false, false),
  ('o_orderdate', 'timestamp_ntz', 'datetime', false, false)) v(column_name, dtype, role, is_label, is_id)
union all select 'o_orderstatus', 'string', case when s1 = 0 then 'datetime' else 'categorical' end, false, false from p
union all select 'o_orderpriority', 'string', case when s2 = 0 then 'datetime' else 'categorical' end, true, false from p
union all select 'o_orderdate_text', 'string', case when s3 = 0 then 'datetime' else 'categorical' end, false, false
from p
""")
def column_roles_orders(spark, sf):
    """Numeric / datetime (incl. all-parsable text) / categorical roles; label by name pattern."""
    o = load(spark, sf, "orders").withColumn("o_orderdate_text", F.col("o_orderdate").cast("string"))
    return R.column_roles(o, label_pattern="priority")


# ---------------------------------------------------------------- filters and cleaning

@register("plausibility_filter_lineitem", """
select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax from lineitem
where l_discount <= 1.5 * l_quantity and l_tax <= 1.5 * l_extendedprice
  and l_quantity > 0 and l_extendedprice > 0 and l_discount > 0 and l_tax > 0
""")
def plausibility_filter_lineitem(spark, sf):
    """Declarative row rules (NULL fails), pushed into the scan filter."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_MEASURES)
    return C.filter_rules(li, C.plausibility_rules("l_quantity", "l_extendedprice", "l_discount", "l_tax"))


@register("allowed_labels_lineitem", """
select l_returnflag, cast(count(*) as bigint) as n from lineitem where l_returnflag in ('A', 'R') group by 1
""")
def allowed_labels_lineitem(spark, sf):
    """Rows with a label in the allowed list (counted per label)."""
    li = C.filter_allowed(load(spark, sf, "lineitem"), "l_returnflag", ["A", "R"])
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register("positive_rows_lineitem", """
select cast(count(*) as bigint) as n from lineitem
where l_quantity > 0 and l_extendedprice > 0 and l_discount > 0 and l_tax > 0
""")
def positive_rows_lineitem(spark, sf):
    """Rows whose measures are all positive."""
    return C.filter_positive(load(spark, sf, "lineitem"), LINE_MEASURES).agg(F.count(F.lit(1)).alias("n"))


@register("deduplicated_events", f"""
select distinct user_id, event_type, value from ({_EVENTS_REPEATS_SQL})
""")
def deduplicated_events(spark, sf):
    """Exact duplicate removal (ignoring the key)."""
    return C.drop_duplicates(events_with_repeats(spark, sf).drop("event_id"))


@register("complete_cases_events", f"""
select * from ({_EVENTS_NULLS_SQL}) where user_id is not null and event_type is not null
  and value is not null and not isnan(value)
""")
def complete_cases_events(spark, sf):
    """Complete-case filter."""
    return C.complete_cases(events_with_nulls(spark, sf))


@register("median_imputed_events", f"""
with e as ({_EVENTS_NULLS_SQL}),
m as (select quantile_cont(value, 0.5) as mv, quantile_cont(user_id, 0.5) as mu from e)
select event_id, round(coalesce(value, mv), 6) as value, round(coalesce(cast(user_id as double), mu), 6) as user_id
from e, m
""")
def median_imputed_events(spark, sf):
    """Missing → exact column median."""
    e = events_with_nulls(spark, sf).select("event_id", "value", F.col("user_id").cast("double"))
    return rounded(C.impute_median(e, ["value", "user_id"]))


@register("group_median_imputed_events", f"""
with e as ({_EVENTS_NULLS_SQL}),
m as (select event_type, quantile_cont(value, 0.5) as mv from e where event_type is not null group by 1)
select e.event_id, e.event_type, round(coalesce(e.value, m.mv), 6) as value
from e left join m on e.event_type = m.event_type
""")
def group_median_imputed_events(spark, sf):
    """Missing → median of the row's group."""
    e = events_with_nulls(spark, sf).select("event_id", "event_type", "value")
    return rounded(C.impute_median(e, ["value"], group="event_type"))


@register("mean_imputed_events", f"""
with e as ({_EVENTS_NULLS_SQL}), m as (select avg(value) as mv from e)
select event_id, round(coalesce(value, mv), 6) as value from e, m
""")
def mean_imputed_events(spark, sf):
    """Missing → column mean."""
    return rounded(C.impute_mean(events_with_nulls(spark, sf).select("event_id", "value"), ["value"]))


@register("cleaned_events", f"""
with e as (select distinct user_id, event_type, value from (
             select case when event_id % 7 = 0 then null else user_id end as user_id, event_type,
                    case when event_id % 11 = 0 then null else value end as value from ({_EVENTS_REPEATS_SQL}))),
m as (select quantile_cont(value, 0.5) as mv from e),
f as (select user_id, event_type, coalesce(value, mv) as value from e, m)
select user_id, event_type, round_even(value, 1) as value from f where value > 0 and value < 400
""")
def cleaned_events(spark, sf):
    """Clean composition: de-duplicate → median impute → rule filter → half-even rounding."""
    ev = events_with_repeats(spark, sf)
    ev = ev.select(F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("user_id")).alias("user_id"),
                   "event_type",
                   F.when(F.col("event_id") % 11 == 0, None).otherwise(F.col("value")).alias("value"))
    return C.clean(ev, ["value"], rules=["value > 0", "value < 400"], handle_missing="median")


@register("consistent_events", """
with e as (select event_type, cast(value as varchar) as v from events where event_type in ('click', 'view', 'purchase')),
c as (select event_type, case when regexp_matches(v, '^\\s*[+-]?((\\d+\\.?\\d*)|(\\.\\d+))([eE][+-]?\\d+)?\\s*$')
                              then try_cast(v as double) end as x from e),
p as (select event_type, round_even(x, 1) as v from c where x > 0)
select distinct event_type, v from p where v < 300
""")
def consistent_events(spark, sf):
    """Consistency composition: allowed labels → positive → coerce + round → rules → de-duplicate."""
    ev = load(spark, sf, "events").select("event_type", F.col("value").cast("string").alias("v"))
    return C.ensure_consistency(ev, ["v"], label="event_type", allowed=["click", "view", "purchase"],
                                rules=["v < 300"])


@register("random_forest_imputed_lineitem")
def random_forest_imputed_lineitem(spark, sf):
    """Model-based imputation: per-column distributed random forest (rows-only check)."""
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *LINE_MEASURES)
    li = li.withColumn("row_id", F.xxhash64("l_orderkey", "l_linenumber", *LINE_MEASURES))
    li = li.withColumn("l_discount", F.when(F.col("l_orderkey") % 17 == 0, None).otherwise(F.col("l_discount")))
    out = C.impute_random_forest(li, ["l_quantity", "l_extendedprice", "l_discount"], predictors=LINE_MEASURES)
    return out.filter(F.col("l_orderkey") % 17 == 0).select("row_id", "l_discount")


@register("random_forest_label_imputed_events")
def random_forest_label_imputed_events(spark, sf):
    """Label imputation with a distributed random-forest classifier (rows-only check)."""
    ev = events_with_nulls(spark, sf).select("event_id", "event_type", "value",
                                             F.col("user_id").cast("double").alias("user_id"))
    out = C.impute_label(ev, "event_type", ["value", "user_id"])
    return out.select("event_id", "event_type")
