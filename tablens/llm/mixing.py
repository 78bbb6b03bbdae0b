"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents that belong to the same set of sources form one pattern. Tokens flow from patterns
over their sources to the sources' quotas; each further pass over a pattern costs more than the
one before (convex repetition costs), so a quota takes fresh tokens before it repeats any. The
flow gives every pattern a number of whole passes and a rest; the rest goes to the first
documents in seeded order. Only token sums per pattern and per hash bucket leave the tables.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

MAX_REPEATS = 2
MAX_PATTERNS = 200_000
LEVEL_BITS = 8


def capped_targets(sizes: dict, weights: dict, budget: float, most: float = MAX_REPEATS) -> dict:
    """``budget`` by weight, no source above ``most`` times its size; the excess is reshared by weight."""
    held: dict = {}
    rest = dict(weights)
    while rest:
        left, whole = budget - sum(held.values()), sum(rest.values())
        over = [s for s in rest if left * rest[s] / whole > most * sizes[s]]
        if not over:
            return held | {s: left * w / whole for s, w in rest.items()}
        for s in over:
            held[s] = float(most * sizes[s])
            del rest[s]
    return held


def route(patterns: dict[tuple, int], quotas: dict, max_repeats: int = MAX_REPEATS) -> dict[tuple, dict]:
    """Tokens from each pattern (a tuple of sources) to each of its sources, by min-cost flow.

    Arcs: start -> pattern, one of the pattern's size for each pass k at cost k; pattern -> its
    sources; source -> end with the quota. Solved by successive shortest paths, one connected
    group of patterns and sources at a time.
    """
    by_source = defaultdict(list)
    for p in patterns:
        for s in p:
            by_source[s].append(p)
    flow: dict[tuple, dict] = {p: dict.fromkeys(p, 0.0) for p in patterns}
    seen: set = set()
    for start in patterns:
        if start in seen:
            continue
        group, todo, near = [], [start], set()
        seen.add(start)
        while todo:
            p = todo.pop()
            group.append(p)
            for s in set(p) - near:
                near.add(s)
                for q in by_source[s]:
                    if q not in seen:
                        seen.add(q)
                        todo.append(q)
        _route_group(group, near, patterns, quotas, max_repeats, flow)
    return flow


def _route_group(group: list, sources: set, sizes: dict, quotas: dict, max_repeats: int, flow: dict) -> None:
    ids: dict = {}
    heads: list[list[int]] = [[], []]
    arcs: list[list] = []  # to, capacity, cost; the reverse arc is at index ^ 1

    def node(key) -> int:
        if key not in ids:
            ids[key] = len(heads)
            heads.append([])
        return ids[key]

    def arc(a: int, b: int, cap: float, cost: float) -> int:
        heads[a].append(len(arcs))
        arcs.append([b, cap, cost])
        heads[b].append(len(arcs))
        arcs.append([a, 0.0, -cost])
        return len(arcs) - 2

    routed = {}
    for p in group:
        for k in range(max_repeats):
            arc(0, node(("p", p)), float(sizes[p]), k + 1)
        for s in p:
            routed[p, s] = arc(node(("p", p)), node(("s", s)), float("inf"), 0)
    for s in sources:
        arc(node(("s", s)), 1, float(quotas.get(s, 0.0)), 0)
    while True:
        cost, back, todo, queued = {0: 0.0}, {}, deque([0]), {0}
        while todo:
            a = todo.popleft()
            queued.discard(a)
            for i in heads[a]:
                b, cap, c = arcs[i]
                if cap > 1e-6 and cost[a] + c < cost.get(b, float("inf")) - 1e-12:
                    cost[b], back[b] = cost[a] + c, i
                    if b not in queued:
                        queued.add(b)
                        todo.append(b)
        if 1 not in cost:
            break
        path, at = [], 1
        while at:
            path.append(back[at])
            at = arcs[back[at] ^ 1][0]
        push = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= push
            arcs[i ^ 1][1] += push
    for (p, s), i in routed.items():
        flow[p][s] = arcs[i ^ 1][1]


def mix(docs: DataFrame, sources: Column, size: Column, quotas: Callable[[dict], dict], id_col: str = "doc_id", seed: int = 11,
        max_repeats: int = MAX_REPEATS) -> tuple[DataFrame, dict, dict]:
    """``docs`` with ``mix_size``, ``mix_taken``, ``mix_copies``; the sources' sizes; their quotas.

    ``mix_taken`` counts the tokens the mix takes, repeats included: the document at the cut of
    its pattern gives only as many as the quota still needs. ``mix_copies`` (0 to
    ``max_repeats``) is the same in whole documents.

    ``sources`` is an array of the sources a row belongs to (null is a source like any other; an
    empty or null array belongs to none and is never taken), ``size`` its tokens. ``quotas``
    maps the sizes of the sources to their quotas. Rows without tokens are taken once where their
    pattern's pass reaches them. Rows of one pattern that share their id share one place in the order. At most
    MAX_PATTERNS distinct patterns are handled on the driver (ValueError beyond); reruns agree.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.to_json(F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.struct(s.isNull().alias("null"), s.alias("s")))))), F.lit("[]"))
    h = F.xxhash64(F.lit(seed), F.col(id_col))
    wide = docs.withColumn("mix_size", F.coalesce(size.cast("long"), F.lit(0).cast("long"))).withColumn("mix_key", key).withColumn("mix_hash", h)
    sized = written(wide.select("mix_key", "mix_hash", "mix_size", sources.alias("sources")), "mix")
    stats = (sized.groupBy("mix_key").agg(F.sum("mix_size").alias("tokens"), F.first("sources").alias("sources"))
             .limit(MAX_PATTERNS + 1).collect())
    if len(stats) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    named = {r["mix_key"]: tuple(sorted(set(r["sources"] or ()), key=lambda s: (s is None, s or ""))) for r in stats}
    tokens = {named[r["mix_key"]]: r["tokens"] for r in stats}
    sizes: dict = defaultdict(int)
    for p, n in tokens.items():
        for s in p:
            sizes[s] += n
    wanted = quotas(dict(sizes))
    flow = route({p: n for p, n in tokens.items() if p}, wanted, max_repeats)
    plan = []
    for k, p in named.items():
        total, n = sum(flow.get(p, {}).values()), tokens[p]
        passes = min(max_repeats, int(total / n + 1e-9)) if n else int(bool(p))
        plan.append((k, passes, max(0.0, total - passes * n) if passes < max_repeats and n else 0.0))
    # At most MAX_PATTERNS rows, checked above.
    plans = F.broadcast(spark.createDataFrame(plan, "mix_key string, passes int, rest double"))
    # The rest of each pattern ends in one of 2^LEVEL_BITS hash buckets, that in one of its own
    # 2^LEVEL_BITS; the rows of that one alone are put in order. No window is longer than a level.
    edge = plans.select("mix_key", "rest", F.lit(0.0).alias("ahead"), F.lit(0).cast("long").alias("bucket"))
    for level in (1, 2):
        part = F.shiftrightunsigned("mix_hash", 64 - LEVEL_BITS * level)
        sums = (sized.withColumn("above", F.shiftrightunsigned("mix_hash", 64 - LEVEL_BITS * (level - 1)) if level > 1 else F.lit(0).cast("long"))
                .join(F.broadcast(edge.select("mix_key", F.col("bucket").alias("above"))), ["mix_key", "above"])
                .groupBy("mix_key", part.alias("part")).agg(F.sum("mix_size").alias("n")))
        over = Window.partitionBy("mix_key").orderBy("part")
        found = (sums.join(F.broadcast(edge), "mix_key").withColumn("upto", F.col("ahead") + F.sum("n").over(over))
                 .where((F.col("upto") > F.col("rest")) & (F.col("n") > 0))
                 .groupBy("mix_key").agg(F.min(F.struct("part", (F.col("upto") - F.col("n")).alias("ahead"), "rest")).alias("at")))
        # One row per pattern, at most MAX_PATTERNS.
        edge = spark.createDataFrame([tuple(r) for r in found.select("mix_key", "at.rest", "at.ahead", "at.part").collect()],
                                     "mix_key string, rest double, ahead double, bucket long")
    bucket = F.shiftrightunsigned("mix_hash", 64 - 2 * LEVEL_BITS)
    hashes = (sized.withColumn("bucket", bucket).join(F.broadcast(edge), ["mix_key", "bucket"])
              .groupBy("mix_key", "mix_hash", "ahead", "rest").agg(F.sum("mix_size").alias("n")))
    order = Window.partitionBy("mix_key").orderBy(F.col("mix_hash"))
    # Signed order inside a bucket agrees with unsigned order: the top bits are the same.
    last = (hashes.withColumn("upto", F.col("ahead") + F.sum("n").over(order)).where((F.col("upto") > F.col("rest")) & (F.col("n") > 0))
            .groupBy("mix_key").agg(F.min(F.struct("mix_hash", ((F.col("rest") - F.col("upto") + F.col("n")) / F.col("n")).alias("part"))).alias("at")))
    cuts = {r["mix_key"]: (r["bucket"], r["mix_hash"], r["part"])
            for r in edge.join(last, "mix_key").select("mix_key", "bucket", "at.mix_hash", "at.part").collect()}
    rows = [(k, n, *cuts.get(k, (0, None, 0.0))) for k, n, _ in plan]
    decided = F.broadcast(spark.createDataFrame(rows, "mix_key string, mix_passes int, mix_cut long, mix_last long, mix_part double"))
    mine = F.shiftrightunsigned("mix_hash", 64 - 2 * LEVEL_BITS)
    at_cut = mine == F.col("mix_cut")
    part = (F.when(mine < F.col("mix_cut"), 1.0).when(at_cut & (F.col("mix_hash") < F.col("mix_last")), 1.0)
            .when(at_cut & (F.col("mix_hash") == F.col("mix_last")), F.col("mix_part")).otherwise(0.0))
    copies = F.col("mix_passes") + (part >= 0.5).cast("int")
    out = (wide.join(decided, "mix_key")
           .withColumn("mix_taken", F.col("mix_size") * F.col("mix_passes") + F.round(F.col("mix_size") * part).cast("long"))
           .withColumn("mix_copies", F.when(F.col("mix_size") > 0, copies).otherwise(F.least(copies, F.lit(1)))))
    return out.drop("mix_key", "mix_hash", "mix_passes", "mix_cut", "mix_last", "mix_part"), dict(sizes), wanted


def rotating_quotas(sizes: dict, weights: tuple = (3, 1, 2), share: float = 1.5, most: float = MAX_REPEATS) -> dict:
    """Weights repeating over the sources by code point, null last; ``share`` of all sizes, capped."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    return capped_targets(sizes, {s: weights[i % len(weights)] for i, s in enumerate(order)}, share * sum(sizes.values()), most)
