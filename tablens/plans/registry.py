"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` plus,
where the operator is SQL-expressible, the equivalent DuckDB SQL text.

Conventions shared by both sides: every computed column is aliased; computed
floats are rounded to 6 decimals (summation order differs between engines);
counts are BIGINT; long reports name the measured column ``column_name``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablens.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
DOCS: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: add a query (and its oracle SQL, if any) under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        DOCS[name] = (fn.__doc__ or "").strip()
        return fn
    return deco


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Read a driver table; pins the session time zone the time operators assume."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def r6(c) -> F.Column:
    """Output rounding of computed floats (same rule as the SQL side's ``round(x, 6)``)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (output convention shared with the oracle SQL)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])
