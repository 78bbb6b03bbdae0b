"""Exact nearest neighbours and k-NN imputation without comparing all pairs.

Donors are dealt to the nearest of a bounded number of pivots (cells), and each cell is cut into
rings of about ``BLOCK`` donors by distance to its pivot. A query first searches one block near
it, whose k-th distance (or what pivots and ring radii promise, if that is less) bounds the k-th
distance overall. In a second round it goes to exactly those blocks that the triangle inequality and the
bisecting planes between pivots can't exclude. Within a block the distances are one vectorised
NumPy pass. Equal donors count only ``k`` times, a ring above ``BLOCK`` donors is dealt by hash, a block with
many queries is copied for each ``QUERY_BLOCK`` of them: no task holds a group of unbounded size.

For imputation a row's missing pattern matters: between one pattern of rows that lack cells and one of
donors the nan-Euclidean distance is a plain Euclidean distance over the cells both have, times a
constant. Such a pair is a ``space`` of its own; the neighbours in all spaces are merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablens.functions.frames import as_list
from tablens.functions.numeric import nan_to_null
from tablens.session import materialize, ship_package

BLOCK = 2048
QUERY_BLOCK = 4096
PIVOTS = 4096
RINGS = 32
CELLS_AT_ONCE = 1 << 21
# Bounds are compared with this relative slack, far above the rounding of a sum of squares.
SLACK = 1e-9
# Fixed value: neighbours of the reference's imputer.
KNN = 5


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(a - b)² summed in column order, so that equal inputs round like the SQL sum."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        out += d * d
    return out


def _matrix(col, dims: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


class _Index:
    """Pivots and rings of all spaces, as arrays; at most ``PIVOTS`` pivots and ``PIVOTS * RINGS`` rings."""

    def __init__(self, pivots: dict[int, np.ndarray]):
        self.pivots = pivots
        self.edges: dict[int, list[np.ndarray]] = {}
        self.rings: dict[int, dict[str, np.ndarray]] = {}
        self.between = {s: np.sqrt(squared_distances(p, p)) for s, p in pivots.items()}

    def nearest(self, space: int, vecs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell, dist = np.zeros(len(vecs), np.int64), np.zeros(len(vecs))
        pivots = self.pivots[space]
        step = max(1, CELLS_AT_ONCE // len(pivots))
        for i in range(0, len(vecs), step):
            d = squared_distances(vecs[i:i + step], pivots)
            cell[i:i + step] = d.argmin(axis=1)
            dist[i:i + step] = np.sqrt(d.min(axis=1))
        return cell, dist

    def ring_of(self, space: int, cell: np.ndarray, dist: np.ndarray) -> np.ndarray:
        """The number of each donor's ring among all rings of the space."""
        edges = self.edges[space]
        first = np.cumsum([0, *[len(e) + 1 for e in edges]])
        out = np.zeros(len(cell), np.int64)
        for c in np.unique(cell):
            at = cell == c
            out[at] = first[c] + np.searchsorted(edges[c], dist[at], side="right")
        return out

    def bounds(self, space: int, vecs: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """For slices of queries: least and greatest distance to the donors of every ring that holds any."""
        rings, pivots = self.rings[space], self.pivots[space]
        step = max(1, CELLS_AT_ONCE // max(len(rings["cell"]), len(pivots)))
        for i in range(0, len(vecs), step):
            d = np.sqrt(squared_distances(vecs[i:i + step], pivots))
            near = d.argmin(axis=1)
            own = d[np.arange(len(d)), near]
            # Half-planes: a donor of cell c is no nearer to the query's pivot than to its own.
            gap = self.between[space][near]
            plane = np.where(gap > 0, (d * d - (own * own)[:, None]) / np.where(gap > 0, 2 * gap, 1.0), 0.0)
            at = rings["cell"]
            least = np.maximum(np.maximum(d[:, at] - rings["far"], rings["near"] - d[:, at]), np.maximum(plane[:, at], 0.0))
            yield slice(i, i + step), least, d[:, at] + rings["far"]


def _by_space(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    space = batch.column("space").to_numpy()
    vecs = _matrix(batch.column("vec"), dims)
    for s in np.unique(space):
        at = np.flatnonzero(space == s)
        yield int(s), at, vecs[at]


def _fields(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in names)


def _build(donors: DataFrame, dims: int, k: int) -> tuple[DataFrame, object]:
    """Donors ``space, block, vec, key, payload`` and the broadcast index over them."""
    spark = donors.sparkSession
    same = Window.partitionBy("space", "vec").orderBy("key")
    donors = materialize(donors.withColumn("_nth", F.row_number().over(same)).where(F.col("_nth") <= k).drop("_nth"))
    sizes = {r["space"]: r["n"] for r in donors.groupBy("space").agg(F.count("*").alias("n")).collect()}
    share = max(1, PIVOTS // max(1, len(sizes)))
    draw = Window.partitionBy("space").orderBy(F.xxhash64("vec"), "vec")
    drawn = donors.select("space", "vec").distinct().withColumn("_nth", F.row_number().over(draw)).where(F.col("_nth") <= share).orderBy("space", "_nth")
    pivots: dict[int, list] = {}
    for r in drawn.collect():  # at most PIVOTS rows, or one per space
        if len(pivots.setdefault(r["space"], [])) < max(1, int(sizes[r["space"]] ** 0.5)):
            pivots[r["space"]].append(r["vec"])
    index = _Index({s: np.array(p, dtype=np.float64).reshape(-1, dims) for s, p in pivots.items()})
    held = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, dist = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for s, at, vecs in _by_space(batch, dims):
                cell[at], dist[at] = held.value.nearest(s, vecs)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(dist)], names=[*batch.schema.names, "cell", "dist"])

    names = ["space", "vec", "key", "payload"]
    placed = materialize(donors.select(*names).mapInArrow(assign, f"{_fields(donors, names)}, cell int, dist double"))
    cuts = F.percentile_approx("dist", F.array(*[F.lit(i / RINGS) for i in range(1, RINGS)]), 1000)
    cells = placed.groupBy("space", "cell").agg(F.count("*").alias("n"), cuts.alias("cuts")).collect()  # one row per pivot
    for s, p in index.pivots.items():
        index.edges[s] = [np.zeros(0)] * len(p)
    for r in cells:
        rings = min(RINGS, -(-r["n"] // BLOCK))
        index.edges[r["space"]][r["cell"]] = np.unique([r["cuts"][RINGS * i // rings - 1] for i in range(1, rings)])
    edged = spark.sparkContext.broadcast(index)

    def ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, cell, dist = np.zeros(batch.num_rows, np.int32), batch.column("cell").to_numpy(), batch.column("dist").to_numpy()
            space = batch.column("space").to_numpy()
            for s in np.unique(space):
                at = np.flatnonzero(space == s)
                out[at] = edged.value.ring_of(int(s), cell[at], dist[at])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "ring"])

    ringed = placed.mapInArrow(ring, f"{_fields(placed, placed.columns)}, ring int")
    stats = ringed.groupBy("space", "ring").agg(F.count("*").alias("n"), F.min("dist").alias("near"), F.max("dist").alias("far"),
                                               F.first("cell").alias("cell")).orderBy("space", "ring").toArrow()  # one row per ring
    rows = {c: stats[c].to_numpy() for c in stats.column_names}
    first = 0
    blocks = []
    for s in index.pivots:
        at = np.flatnonzero(rows["space"] == s)
        parts = -(-rows["n"][at] // BLOCK)
        starts = first + np.cumsum(parts) - parts
        index.rings[s] = {"cell": rows["cell"][at], "near": rows["near"][at], "far": rows["far"][at], "n": rows["n"][at], "block": starts, "parts": parts}
        blocks += zip([s] * len(at), rows["ring"][at].tolist(), starts.tolist(), parts.tolist(), strict=True)
        first += int(parts.sum())
    # One row per ring, at most PIVOTS * RINGS.
    numbered = F.broadcast(spark.createDataFrame(blocks, "space int, ring int, first long, parts long"))
    part = F.pmod(F.xxhash64("vec", "key"), F.col("parts"))
    return (ringed.join(numbered, ["space", "ring"]).select("space", (F.col("first") + part).alias("block"), "vec", "key", "payload"),
            spark.sparkContext.broadcast(index))


def _first_blocks(queries: DataFrame, index, dims: int, k: int) -> DataFrame:
    """Queries with the block to search first and an upper ``bound`` of their k-th distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bound = np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, np.inf)
            qid = batch.column("qid").to_numpy()
            for s, at, vecs in _by_space(batch, dims):
                rings = index.value.rings[s]
                most = min(k, len(rings["n"]))
                for part, least, far in index.value.bounds(s, vecs):
                    rows = np.arange(len(least))
                    here = (least + far * 1e-6).argmin(axis=1)
                    block[at[part]] = rings["block"][here] + qid[at[part]] % rings["parts"][here]
                    near = np.argpartition(far, most - 1, axis=1)[:, :most]
                    near = np.take_along_axis(near, np.take_along_axis(far, near, 1).argsort(axis=1), 1)
                    enough = rings["n"][near].cumsum(axis=1) >= k
                    col = enough.argmax(axis=1)
                    bound[at[part]] = np.where(enough.any(axis=1), far[rows, near[rows, col]], np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block), pa.array(bound)], names=[*batch.schema.names, "block", "bound"])

    return queries.mapInArrow(run, f"{_fields(queries, queries.columns)}, block long, bound double")


def _other_blocks(queries: DataFrame, index, dims: int) -> DataFrame:
    """A row for each further block that may hold one of a query's neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bound, done = batch.column("bound").to_numpy(), batch.column("block").to_numpy()
            for s, at, vecs in _by_space(batch, dims):
                rings = index.value.rings[s]
                for part, least, _ in index.value.bounds(s, vecs):
                    mine = at[part]
                    row, ring = np.nonzero(least <= bound[mine][:, None] * (1 + SLACK) + SLACK * np.abs(vecs[part]).max(axis=1, initial=0)[:, None])
                    parts = rings["parts"][ring]
                    row = np.repeat(mine[row], parts)
                    block = np.repeat(rings["block"][ring] - (np.cumsum(parts) - parts), parts) + np.arange(parts.sum())
                    new = block != done[row]
                    rows = batch.take(pa.array(row[new]))
                    yield rows.set_column(batch.schema.get_field_index("block"), "block", pa.array(block[new]))

    return queries.mapInArrow(run, _fields(queries, queries.columns))


def _search(asked: DataFrame, donors: DataFrame, dims: int, k: int, report: dict | None) -> DataFrame:
    """``qid, space, tag, d2, key, payload``: each query's k nearest donors of its block within its bound, ties included."""
    per_block = asked.groupBy("block").agg(F.count("*").alias("asked"))
    if report is not None:
        pairs = donors.groupBy("block").agg(F.count("*").alias("n")).join(per_block, "block").agg(F.sum(F.col("n") * F.col("asked"))).first()[0]
        report["pairs"] = report.get("pairs", 0) + (pairs or 0)
    copies = per_block.select("block", F.ceil(F.col("asked") / QUERY_BLOCK).cast("int").alias("copies"))
    left = asked.join(copies, "block").withColumn("copy", F.pmod(F.xxhash64("qid"), F.col("copies")).cast("int"))
    right = donors.join(copies, "block").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    def run(q: pa.Table, x: pa.Table) -> pa.Table:
        rows, cols, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if q.num_rows and x.num_rows:
            a, b = _matrix(q["vec"], dims), _matrix(x["vec"], dims)
            limit = q["bound"].to_numpy() * (1 + SLACK) + SLACK * np.abs(a).max(axis=1, initial=0)
            limit = limit * limit
            step = max(1, CELLS_AT_ONCE // len(b))
            for i in range(0, len(a), step):
                d = squared_distances(a[i:i + step], b)
                most = limit[i:i + step]
                if len(b) > k:
                    most = np.minimum(most, np.partition(d, k - 1, axis=1)[:, k - 1])
                r, c = np.nonzero(d <= most[:, None])
                rows.append(r + i)
                cols.append(c)
                found.append(d[r, c])
        r, c = pa.array(np.concatenate(rows)), pa.array(np.concatenate(cols))
        return pa.table({"qid": q["qid"].take(r), "space": q["space"].take(r), "tag": q["tag"].take(r), "d2": pa.array(np.concatenate(found)),
                         "key": x["key"].take(c), "payload": x["payload"].take(c)})

    schema = f"qid long, space int, tag long, d2 double, {_fields(donors, ['key', 'payload'])}"
    grouped = left.select("block", "copy", "qid", "space", "tag", "vec", "bound").groupBy("block", "copy")
    return grouped.cogroup(right.select("block", "copy", "vec", "key", "payload").groupBy("block", "copy")).applyInArrow(run, schema)


def k_nearest(queries: DataFrame, donors: DataFrame, dims: int, k: int, report: dict | None = None) -> DataFrame:
    """``qid, space, tag, d2, key, payload``: the k nearest donors of each query in its space, ties by key.

    ``queries``: ``space int, qid long`` (unique in a space), ``vec array<double>, tag long``; ``donors``: ``space, vec, key,
    payload``. Vectors hold ``dims`` finite numbers. ``report`` receives the number of compared pairs.
    """
    ship_package(queries.sparkSession)
    zero = lambda c: F.transform(c, lambda x: x + F.lit(0.0))  # noqa: E731  -0.0 and 0.0 are one place
    donors, index = _build(donors.withColumn("vec", zero("vec")), dims, k)
    names = ["space", "qid", "vec", "tag"]
    # Only spaces that hold donors can answer.
    known = sorted(index.value.pivots)
    asked = _first_blocks(queries.where(F.col("space").isin(known)).select(*names).withColumn("vec", zero("vec")), index, dims, k)
    asked = materialize(asked)
    first = materialize(_search(asked, donors, dims, k, report))
    order = Window.partitionBy("space", "qid").orderBy("d2", "key")
    reach = (first.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") == k)
             .select("space", "qid", F.sqrt("d2").alias("_kth")))
    closer = asked.join(reach, ["space", "qid"], "left").withColumn("bound", F.least("bound", F.coalesce("_kth", F.lit(float("inf")))))
    rest = materialize(_other_blocks(closer.select(*names, "block", "bound"), index, dims))
    both = first.unionByName(_search(rest, donors, dims, k, report))
    return both.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k).drop("_nth")


def _complete(df: DataFrame, columns: Sequence[str]):
    ok = F.lit(True)
    for c in columns:
        x = nan_to_null(c).cast("double")
        ok = ok & x.isNotNull() & (F.abs(x) < float("inf"))
    return ok


def nearest_neighbors(queries: DataFrame, donors: DataFrame, columns: Sequence[str], query_key, donor_key, k: int = KNN,
                      prefix: str = "neighbor_", report: dict | None = None) -> DataFrame:
    """``(query_key..., rank, prefix + donor_key..., distance)``: the ``k`` nearest donors of each query row.

    Distances are Euclidean over ``columns``; ties go to the smaller donor key. Rows with a missing or infinite
    coordinate neither ask nor answer; fewer than ``k`` donors give fewer rows.
    """
    columns, query_key, donor_key = as_list(columns), as_list(query_key), as_list(donor_key)
    vec = F.array(*[F.col(c).cast("double") for c in columns])
    asked = queries.where(_complete(queries, columns)).select(F.lit(0).alias("space"), vec.alias("vec"), F.lit(0).cast("long").alias("tag"),
                                                             *[F.col(c).alias(f"_q_{c}") for c in query_key])
    asked = materialize(asked.withColumn("qid", F.monotonically_increasing_id()))
    given = donors.where(_complete(donors, columns)).select(F.lit(0).alias("space"), vec.alias("vec"), F.struct(*donor_key).alias("key"),
                                                           F.array().cast("array<double>").alias("payload"))
    found = k_nearest(asked.select("space", "qid", "vec", "tag"), given, len(columns), k, report)
    order = Window.partitionBy("qid").orderBy("d2", "key")
    found = found.withColumn("rank", F.row_number().over(order))
    return found.join(asked.drop("space", "vec", "tag"), "qid").select(
        *[F.col(f"_q_{c}").alias(c) for c in query_key], "rank", *[F.col("key")[c].alias(prefix + c) for c in donor_key], F.sqrt("d2").alias("distance"))


def impute_knn(df: DataFrame, columns: Sequence[str], key=None, k: int = KNN, report: dict | None = None) -> DataFrame:
    """Missing → the mean of the column over the ``k`` nearest rows that have it (nan-Euclidean distance).

    The squared distance of two rows is that over the columns both have, times all columns over those. Ties
    go to the smaller ``key`` (the row's place in the input without one). With fewer than ``k`` such rows all of them count;
    a cell without any (no row shares a column with it) gets the column's mean. Infinite cells count as
    missing. The imputed columns come back as double; all other columns and rows stay.
    """
    ship_package(df.sparkSession)
    spark = df.sparkSession
    columns, key = as_list(columns), as_list(key)
    cell = lambda c: F.when(F.abs(nan_to_null(c).cast("double")) < float("inf"), nan_to_null(c).cast("double"))
    base = df.select("*", *[cell(c).alias(f"_x{i}") for i, c in enumerate(columns)]).withColumn("_row", F.monotonically_increasing_id())
    base = materialize(base)
    p = len(columns)
    has = sum((F.when(F.col(f"_x{i}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i in range(p)), F.lit(0).cast("long"))
    vec = F.array(*[F.col(f"_x{i}") for i in range(p)])
    rows = base.select("_row", has.alias("has"), vec.alias("cells"), (F.struct(*[F.col(c) for c in key], F.col("_row"))).alias("key"))
    patterns = [r["has"] for r in rows.select("has").distinct().collect()]  # at most 2^columns
    full = (1 << p) - 1
    spaces: dict[tuple[int, int], int] = {}
    asking = []
    for q in (x for x in patterns if x != full):
        for d in patterns:
            if d & q and d & ~q:
                asking.append((q, d, spaces.setdefault((d, d & q), len(spaces))))
    means = base.agg(*[F.avg(f"_x{i}").alias(f"_mean{i}") for i in range(p)])
    if asking:
        both = F.broadcast(spark.createDataFrame([(s, d, m) for (d, m), s in spaces.items()], "space int, has long, shared long"))
        ask = F.broadcast(spark.createDataFrame([(q, s, d & q) for q, d, s in asking], "has long, space int, shared long"))
        masked = F.transform("cells", lambda x, i: F.when(F.expr("shared").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0, x).otherwise(0.0))
        given = rows.join(both, "has").select("space", masked.alias("vec"), "key", F.col("cells").alias("payload"))
        asked = rows.join(ask, "has").select("space", F.col("_row").alias("qid"), masked.alias("vec"), F.col("has").alias("tag"))
        found = k_nearest(asked, given, p, k, report)
        scale = F.broadcast(spark.createDataFrame([(s, p / m.bit_count()) for (_, m), s in spaces.items()], "space int, scale double"))
        cells = found.join(scale, "space").select("qid", "tag", (F.col("d2") * F.col("scale")).alias("d2"), "key", F.posexplode("payload").alias("at", "value"))
        lacks = F.expr("(tag & shiftleft(1L, at)) = 0")
        order = Window.partitionBy("qid", "at").orderBy("d2", "key")
        near = cells.where(F.col("value").isNotNull() & lacks).withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k)
        fills = near.groupBy("qid").agg(*[F.avg(F.when(F.col("at") == i, F.col("value"))).alias(f"_fill{i}") for i in range(p)])
    else:
        fills = spark.createDataFrame([], "qid long, " + ", ".join(f"_fill{i} double" for i in range(p)))
    lacking = base.where(has != full).join(fills, F.col("_row") == F.col("qid"), "left").crossJoin(F.broadcast(means))
    filled = {c: F.coalesce(f"_x{i}", f"_fill{i}", f"_mean{i}") for i, c in enumerate(columns)}
    present = {c: F.col(f"_x{i}") for i, c in enumerate(columns)}
    out = lambda frame, how: frame.select(*[how[c].alias(c) if c in how else F.col(c) for c in df.columns])
    return out(base.where(has == full), present).unionByName(out(lacking, filled))
