"""Table loading, contract validation, sampling and writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablens.functions.frames import as_list
from tablens.functions.numeric import is_numeric_text

FORMATS = ("csv", "json", "parquet", "orc")
# Text tokens read as missing in CSV input.
CSV_NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                   "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
INTEGER_TEXT_PATTERN = r"^\s*[+-]?\d{1,18}\s*$"


def load_table(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | str | None = None,
               required: Sequence[str] | None = None, validate: bool = True, **options) -> DataFrame:
    """Read ``path`` (any Hadoop-FS URI) as ``fmt``; check required columns and non-emptiness.

    csv: header + inferred types unless a schema is given (inference costs a pass, after the
    missing-value tokens became NULL, so a number column with some of them stays numeric). json: one record per line, or
    ``multiLine=True`` for an array file.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file type {fmt!r}; use one of {FORMATS}")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", options.pop("header", True))
        infer = schema is None and bool(options.pop("inferSchema", True))
        r = r.option("inferSchema", False).option("nanValue", "NaN")
    for k, v in options.items():
        r = r.option(k, v)
    try:
        df = r.format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise
    if fmt == "csv":
        df = normalise_null_tokens(df)
        if infer:
            df = infer_types(df)
    if validate:
        check_contract(df, required)
    return df


def normalise_null_tokens(df: DataFrame, tokens: Sequence[str] = CSV_NULL_TOKENS) -> DataFrame:
    """Text cells equal to a missing-value token → NULL (row-local projection)."""
    toks = list(tokens)
    return df.select(*[F.when(F.col(f.name).isin(toks), None).otherwise(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])


def infer_types(df: DataFrame) -> DataFrame:
    """Text columns cast to the narrowest of int, long, double, boolean and timestamp all their values fit.

    One aggregate over the text columns; a column without values stays text.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return df
    tests = {"long": lambda c: c.rlike(INTEGER_TEXT_PATTERN), "double": is_numeric_text,
             "boolean": lambda c: F.lower(c).isin("true", "false"), "timestamp": lambda c: F.try_to_timestamp(c).isNotNull()}
    aggs = [F.count(F.col(c)).alias(f"{i}_n") for i, c in enumerate(text)]
    for i, c in enumerate(text):
        aggs += [F.count_if(ok(F.col(c))).alias(f"{i}_{kind}") for kind, ok in tests.items()]
        whole = F.when(F.col(c).rlike(INTEGER_TEXT_PATTERN), F.abs(F.trim(F.col(c)).try_cast("long")))
        aggs.append(F.max(whole).alias(f"{i}_most"))
    seen = df.agg(*aggs).first()

    def cast(i: int, c: str):
        x, n = F.col(c), seen[f"{i}_n"]
        kind = next((k for k in tests if n and seen[f"{i}_{k}"] == n), None)
        if kind is None:
            return x
        if kind == "long" and seen[f"{i}_most"] < 2**31:
            kind = "int"
        return (x if kind == "timestamp" else F.trim(x)).cast(kind).alias(c)

    return df.select(*[cast(text.index(c), c) if c in text else F.col(c) for c in df.columns])


def contract_report(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """``(check, passed, detail)``: required columns present; table non-empty (a ``limit 1`` job)."""
    req = as_list(required)
    missing = [c for c in req if c not in df.columns]
    non_empty = not df.isEmpty()
    rows = [("required_columns", not missing, ",".join(missing)),
            ("non_empty", non_empty, "" if non_empty else "no rows")]
    return df.sparkSession.createDataFrame(rows, "check string, passed boolean, detail string")


def check_contract(df: DataFrame, required: Sequence[str] | None = None) -> None:
    req = as_list(required)
    missing = [c for c in req if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if df.isEmpty():
        raise ValueError("dataset is empty")


def sample_rows(df: DataFrame, n: int = 5, key: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Deterministic n-row sample: the n smallest ``xxhash64(key, seed)`` (per-partition top-n, merged)."""
    cols = as_list(key) or df.columns
    return df.withColumn("_h", F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])) \
        .orderBy("_h", *cols).limit(n).drop("_h")


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def save_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
               partition_by: Sequence[str] | None = None, **options) -> None:
    """Write a partitioned directory (no index column); csv gets a header."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file type {fmt!r}; use one of {FORMATS}")
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*as_list(partition_by))
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
