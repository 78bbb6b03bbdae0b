"""Nearest neighbours and k-NN imputation, held against brute force in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablens.operators import neighbors as N
from tablens.plans.registry import load, r6, register

# Stand-in input: orders whose measures are missing by key, one or two in a row.
_GAPS = {"o_totalprice": (0, 1), "o_custkey": (1, 2), "day": (2, 3)}
_ORDERS_SQL = """t as (select o_orderkey as k, case when o_orderkey % 53 not in (0, 1) then o_totalprice end as a,
  case when o_orderkey % 53 not in (1, 2) then cast(o_custkey as double) end as b,
  case when o_orderkey % 53 not in (2, 3) then cast(dayofyear(o_orderdate) as double) end as c from orders)"""


def orders_with_gaps(spark, sf):
    """Orders with price, customer number and day of the year as doubles, some of them missing."""
    days = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"),
                                            F.dayofyear("o_orderdate").cast("double").alias("day"))
    return days.select("o_orderkey", *[F.when(~(F.col("o_orderkey") % 53).isin(*rest), F.col(c)).alias(c) for c, rest in _GAPS.items()])


def _fill(c: str) -> str:
    return f"""(select k, avg({c}) as v from (select k, {c} from p where n{c} and {c} is not null
  qualify row_number() over (partition by k order by d2, tk) <= 5) group by k)"""


@register("knn_imputed_orders", f"""
with {_ORDERS_SQL},
q as (select * from t where a is null or b is null or c is null),
p as (select q.k, q.a is null as na, q.b is null as nb, q.c is null as nc, t.k as tk, t.a, t.b, t.c,
  (coalesce((q.a - t.a) * (q.a - t.a), 0) + coalesce((q.b - t.b) * (q.b - t.b), 0) + coalesce((q.c - t.c) * (q.c - t.c), 0))
  * (3.0::double / (cast(q.a + t.a is not null as int) + cast(q.b + t.b is not null as int) + cast(q.c + t.c is not null as int))) as d2
  from q, t where q.a + t.a is not null or q.b + t.b is not null or q.c + t.c is not null)
select t.k as o_orderkey, round(coalesce(t.a, fa.v), 6) as o_totalprice, round(coalesce(t.b, fb.v), 6) as o_custkey, round(coalesce(t.c, fc.v), 6) as day
from t left join {_fill('a')} fa on fa.k = t.k left join {_fill('b')} fb on fb.k = t.k left join {_fill('c')} fc on fc.k = t.k
""")
def knn_imputed_orders(spark, sf):
    """Missing measures filled with the mean of the five nearest orders (nan-Euclidean distance)."""
    filled = N.impute_knn(orders_with_gaps(spark, sf), list(_GAPS), "o_orderkey")
    return filled.select("o_orderkey", *[r6(c).alias(c) for c in _GAPS])


@register("nearest_suppliers_customer", """
with d as (select c_custkey, s_suppkey, (c_acctbal - s_acctbal) * (c_acctbal - s_acctbal) + (c_nationkey - s_nationkey) * (c_nationkey - s_nationkey) as d2
           from customer, supplier)
select c_custkey, cast(row_number() over (partition by c_custkey order by d2, s_suppkey) as integer) as rank, s_suppkey as neighbor_s_suppkey,
       round(sqrt(d2), 6) as distance
from d qualify rank <= 3
""")
def nearest_suppliers_customer(spark, sf):
    """The three suppliers nearest to each customer by account balance and nation number."""
    plane = lambda t, p: load(spark, sf, t).select(f"{p}_{'cust' if p == 'c' else 'supp'}key", F.col(f"{p}_acctbal").alias("balance"), F.col(f"{p}_nationkey").alias("nation"))
    found = N.nearest_neighbors(plane("customer", "c"), plane("supplier", "s"), ["balance", "nation"], "c_custkey", "s_suppkey", 3)
    return found.select("c_custkey", "rank", "neighbor_s_suppkey", r6("distance").alias("distance"))
