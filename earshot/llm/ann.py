"""Approximate nearest neighbours with an inverted multi-index.

Unit vectors are cut into two halves, and each half is quantised by its own centroids
(k-means on a bounded, seeded sample). A vector's entry is in the cell of its two
centroids. A query walks the cells in order of the summed distance of its halves to
the centroid pairs, with a heap, until the cells hold `share` of all entries (and
`least` of them at least); the entries of those cells are reranked by the exact cosine
of the original vectors in double precision. The pairs walked depend on the query and
the cells' sizes alone; a cell with many entries is split into blocks, so a third of
all vectors may be equal, and so are the queries that visit it. All vectors are indexed.

Vectors that are missing, zero, or hold a missing or non-finite component, and rows
without an id, take no part; nor do vectors whose length isn't the most common one
(of equals, the longest). Of rows that repeat an id the least vector counts. Fewer
candidates than k are all returned; ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, vector (array of double): one row per id that takes part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    rows = stored(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")))
    size = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vector") == (size["d"] if size else 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 9) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = (2 * x @ centres.T - (centres**2).sum(axis=1)).argmax(axis=1)
        centres = np.stack([x[own == i].mean(axis=0) if (own == i).any() else c for i, c in enumerate(centres)])
    return centres


def _unit(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in order of summed distance until they hold `wanted` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, out, held = [(first[a[0]] + second[b[0]], 0, 0)], [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        n = int(sizes[a[i], b[j]])
        if n:
            out.append(int(a[i]) * len(b) + int(b[j]))
            held += n
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
    return out


def _cells(one: np.ndarray, two: np.ndarray):
    half = one.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                x = _unit(np.stack(rows["vector"].to_numpy()))
                cell = _distances(x[:, :half], one).argmin(axis=1) * len(two) + _distances(x[:, half:], two).argmin(axis=1)
                yield rows.assign(cell=cell)

    return run


def _walks(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, wanted: int):
    half = one.shape[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                x = _unit(np.stack(rows["vector"].to_numpy()))
                first, second = _distances(x[:, :half], one), _distances(x[:, half:], two)
                yield rows.assign(cells=[walk(f, s, sizes, wanted) for f, s in zip(first, second, strict=True)])

    return run


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Of q (one vector, or one per row) and each row of x. Row by row, so that equal
    vectors get equal numbers wherever they stand; scaling by powers of two changes no
    digit, and keeps very long vectors finite."""
    x, q = _scaled(x), _scaled(q)
    return (x * q).sum(axis=-1) / (np.sqrt((x * x).sum(axis=-1)) * np.sqrt((q * q).sum(axis=-1)))


def _scaled(x: np.ndarray) -> np.ndarray:
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def _rerank(k: int, margin: float = 1e-9, cells: int = 1 << 22):
    """The k nearest entries of a block for each query. A matrix product finds those
    within rounding (`margin`) of the k-th best, and their exact cosines decide."""

    def run(key: tuple, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64).astype({"score": float})]
        if len(entries) and len(queries):
            x, ids = np.stack(entries["vector"].to_numpy()), entries["vec_id"].to_numpy()
            unit, step = _unit(x), max(1, cells // x.size)
            for at in range(0, len(queries), step):
                asked = queries["query_id"].to_numpy()[at : at + step]
                q = np.stack(queries["query"].to_numpy()[at : at + step])
                near = _unit(q) @ unit.T
                near[asked[:, None] == ids] = -np.inf
                kth = np.partition(near, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))]
                rows, found = np.nonzero(near >= np.maximum(kth - margin, -2)[:, None])
                score = cosines(q[rows], x[found])
                order = np.lexsort((ids[found], -score, rows))
                rows, found, score = rows[order], found[order], score[order]
                best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
                out.append(pd.DataFrame({"query_id": asked[rows[best]], "vec_id": ids[found[best]], "score": score[best]}))
        return pd.concat(out)

    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, centroids: int = 32, share: float = 0.5, least: int = 1000, fit_rows: int = 4000, block: int = 1000, query_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, the ids divisible by `every`."""
    rows = usable(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id")).limit(fit_rows).toPandas()
    schema = "query_id long, rank int, vec_id long, score double"
    if not len(sample):
        return rows.sparkSession.createDataFrame([], schema)
    x = _unit(np.stack(sample["vector"].to_numpy()))
    half = x.shape[1] // 2
    centroids = max(1, min(centroids, len(x) // 32))
    one, two = kmeans(x[:, :half], centroids), kmeans(x[:, half:], centroids)
    entries = stored(rows.mapInPandas(_cells(one, two), "vec_id long, vector array<double>, cell int"))
    counted = entries.groupBy("cell").count().toPandas()
    sizes = np.zeros(len(one) * len(two), np.int64)
    sizes[counted["cell"]] = counted["count"]
    wanted = max(least, k + 1, int(np.ceil(share * sizes.sum())))
    parts = -(-sizes // block)
    blocks_of = F.array(*[F.lit(int(p)) for p in parts])
    entries = entries.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.get(blocks_of, F.col("cell"))).cast("int"))
    asked = rows.where(F.col("vec_id") % every == 0)
    # Entries meet the queries in blocks of these, too.
    lots = max(1, -(-asked.count() // query_block))
    entries = entries.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))))
    queries = asked.mapInPandas(
        _walks(one, two, sizes.reshape(len(one), len(two)), wanted), "vec_id long, vector array<double>, cells array<int>"
    )
    visits = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.explode("cells").alias("cell"))
    visits = visits.select("query_id", "query", "cell", F.explode(F.sequence(F.lit(0), F.get(blocks_of, F.col("cell")) - 1)).alias("part"))
    visits = visits.withColumn("lot", F.pmod(F.xxhash64("query_id"), F.lit(lots)).cast("int"))
    places = ["cell", "part", "lot"]
    found = (
        entries.groupBy(*places).cogroup(visits.groupBy(*places)).applyInPandas(_rerank(k), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
