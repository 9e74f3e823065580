"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to).
Tokens flow from patterns to the sources they belong to and on to the sources' quotas;
a pattern's first pass over its documents costs nothing, each further pass more, up to
`max_repeats` passes, so repetition is used last and evenly. The flow problem has as
many nodes as there are patterns and sources, not documents, and is solved on the
driver. Spark then selects documents in a seeded order until a pattern's tokens are
reached: every document belongs to one of `buckets` buckets by its seeded hash; whole
buckets are decided from their sums, and only the bucket that the limit falls into is
ordered document by document. Results depend on the rows and the seed alone.

Missing text has size 0, a missing source is a source of its own, sorted last; a
document with an empty list of sources belongs to none and is not taken. Repeated rows
are documents of their own; which of them comes first makes no difference. No
documents, or none with words, take nothing.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from itertools import cycle

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored, words


def targets(sizes: dict, weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3, total: int | None = None) -> dict:
    """A target per source: shares of the total (of all documents, which is the sum of the
    sizes unless sources overlap) by weight, none above `max_repeats` times its source's
    size; what is over is shared again by weight among the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = dict(zip(names, cycle(weights), strict=False))
    out, left, free = {}, float(sum(sizes.values()) if total is None else total), list(names)
    while free:
        of = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / of > max_repeats * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / of for s in free}
            break
        for s in full:
            out[s] = float(max_repeats * sizes[s])
        left -= sum(out[s] for s in full)
        free = [s for s in free if s not in out]
    return out


def min_cost_flow(supply: dict[tuple, int], quota: dict, max_repeats: int = 3) -> dict[tuple, dict]:
    """Tokens from each pattern to each of its sources.

    Successive shortest paths with potentials. `supply`: tokens of one pass by pattern;
    `quota`: tokens wanted by source. Pass i of a pattern costs i*i. A path ends where
    quotas or passes do, so sources that can't be filled stay short.
    """
    graph: dict = defaultdict(dict)  # node -> node -> [capacity, cost]

    def edge(u, v, capacity: int, cost: int) -> None:
        if capacity > 0:
            graph[u][v] = [capacity, cost]
            graph[v].setdefault(u, [0, -cost])

    for pattern, size in supply.items():
        for i in range(max_repeats):
            edge("start", ("pass", pattern, i), size, i * i)
            edge(("pass", pattern, i), ("pattern", pattern), size, 0)
        for source in pattern:
            if source in quota:
                edge(("pattern", pattern), ("source", source), size * max_repeats, 0)
    for source, wanted in quota.items():
        edge(("source", source), "end", wanted, 0)
    potential: dict = defaultdict(int)
    while True:
        far, back, heap, n = {"start": 0}, {}, [(0, 0, "start")], 0
        while heap:
            d, _, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for v, (capacity, cost) in graph[u].items():
                if capacity > 0 and (new := d + cost + potential[u] - potential[v]) < far.get(v, float("inf")):
                    far[v], back[v], n = new, u, n + 1
                    heapq.heappush(heap, (new, n, v))
        if "end" not in far:
            break
        for v in graph:  # nodes out of reach move with the farthest
            potential[v] += min(far.get(v, far["end"]), far["end"])
        path, v = [], "end"
        while v != "start":
            path.append((back[v], v))
            v = back[v]
        amount = min(graph[u][v][0] for u, v in path)
        for u, v in path:
            graph[u][v][0] -= amount
            graph[v][u][0] += amount
    return {
        pattern: {s: graph[("source", s)][("pattern", pattern)][0] for s in pattern if ("pattern", pattern) in graph[("source", s)]}
        for pattern in supply
    }


def mix(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3, seed: int = 7, buckets: int = 4096) -> DataFrame:
    """`sized` (id columns, `size`, `sources`: array of names) with `copies`, how often the
    document is taken, and `pattern_target`, the tokens wanted of its pattern.

    Also adds `targets`, a map from source to (source_size, target)."""
    spark = sized.sparkSession
    pattern = F.array_sort(F.array_distinct(F.transform(F.coalesce("sources", F.array().cast("array<string>")), lambda s: F.struct(s.isNull().alias("none"), s.alias("name")))))
    keyed = sized.withColumn("pattern", F.to_json(F.transform(pattern, lambda s: s["name"]), {"ignoreNullFields": "false"}))
    others = [c for c in sized.columns if c not in ("sources", "size")]
    order = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in others], "size")
    keyed = keyed.withColumn("key", order).withColumn("bucket", F.pmod(F.shiftrightunsigned("key", 20), F.lit(buckets)))
    groups = keyed.groupBy("pattern").agg(F.sum("size").alias("size"), F.first(F.transform(pattern, lambda s: s["name"])).alias("names")).collect()
    supply, names_of = {}, {}
    sizes: dict = defaultdict(int)
    for row in groups:
        names = tuple(row["names"] or ())
        supply[names], names_of[names] = int(row["size"] or 0), row["pattern"]
        for s in names:
            sizes[s] += supply[names]
    wanted = targets(dict(sizes), weights, max_repeats, sum(n for names, n in supply.items() if names))
    flow = min_cost_flow(supply, {s: round(t) for s, t in wanted.items()}, max_repeats)
    rows = []
    for names, size in supply.items():
        tokens = sum(flow[names].values())
        passes = min(max_repeats, tokens // size) if size else 0
        rows.append((names_of[names], tokens, int(passes), int(tokens - passes * size), [(s, sizes[s], wanted[s]) for s in names]))
    plan = spark.createDataFrame(
        rows, "pattern string, pattern_target long, passes int, rest long, targets array<struct<source:string,source_size:long,target:double>>"
    )
    # The bucket that the rest falls into, from the sums of all buckets before it.
    sums = keyed.groupBy("pattern", "bucket").agg(F.sum("size").alias("in_bucket"))
    ahead = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = sums.withColumn("before", F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0))).join(plan.select("pattern", "rest"), "pattern")
    cut = cut.where("before <= rest and rest < before + in_bucket").select("pattern", F.col("bucket").alias("cut"), "before")
    plan = stored(plan.join(cut, "pattern", "left"))
    # In that bucket a document is taken if this brings the sum nearer to the rest.
    placed = keyed.join(plan, "pattern")
    inside = Window.partitionBy("pattern").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = placed.where("bucket = cut").withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    edge = edge.withColumn("more", (2 * (F.col("rest") - F.col("ahead")) > F.col("size")).cast("int")).drop("ahead")
    rest = placed.where("cut is null or bucket <> cut").withColumn("more", F.coalesce(F.col("bucket") < F.col("cut"), F.lit(False)).cast("int"))
    copies = F.when(F.col("size") > 0, F.least(F.col("passes") + F.col("more"), F.lit(max_repeats))).otherwise(0)
    return edge.unionByName(rest).select(*sized.columns, copies.alias("copies"), "pattern_target", "targets")


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size in words and the one source of every document."""
    return docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("size"), F.array("source").alias("sources"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    found = mix(stored(sized_documents(docs)), **options)
    own = F.col("targets")[0]
    return found.select("doc_id", "size", own["source_size"].alias("source_size"), own["target"].alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents taken, with all their columns, each as often as the mix takes it."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    sized = docs.select(
        whole.alias("row"),
        F.size(words(F.col("text"))).cast("long").alias("size"),
        F.array("source").alias("sources"),
    )
    keyed = sized.select("row", F.xxhash64("row.doc_id", "row.text").alias("id"), "size", "sources")
    sizes = stored(keyed.drop("row"))
    found = mix(sizes, **options).where("copies > 0").groupBy("id", "size").agg(F.max("copies").alias("copies"))
    taken = keyed.join(found, ["id", "size"]).select("row", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return taken.select("row.*")
