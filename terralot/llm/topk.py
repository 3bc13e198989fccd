"""Exact top-k by inner product, with pivot-table elimination.

Method: vectors are lifted onto a sphere (one more component makes all candidates' norms equal),
where the largest inner product is the least distance. A table holds each candidate's distances to
many pivots. Together they place it in the pivots' span, up to a rest of known length; so the greatest
lower bound on its distance to a query that all these distances allow is that of the two places and the
difference of the rests (no single pivot's triangle inequality gives more). Candidates are evaluated in
the order of the bounds, by exact integers, until no bound reaches the k-th score found.

The table is computed once and written to the shared folder, in the order of the nearest pivot and the
distance to it, so that blocks of it lie close together: for a whole block the least and greatest
distances to each pivot give a bound by the triangle inequality, and a query passes over blocks it
rules out. Queries are dealt in chunks of bounded size, each broadcast by itself. A first scan of one
candidate in `SEED_ONE_IN` gives each query a k-th score to start from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, staged

#: Pivots; the rows (of least hash) that they are chosen from; block sizes.
PIVOTS, PIVOT_SAMPLE, SEED_ONE_IN, BLOCK = 128, 2048, 32, 4096
CHUNK_COMPONENTS = 4_000_000
TABLE = "vec_id long, n int, items binary, distances binary, nearest int, gap double"
FOUND = "query_id long, vec_id long, score long"


def by_dimension(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Integer vectors floor(256 x) by dimension; rows with a null id, a null vector, or a null or non-finite component are left out."""
    out: dict[int, list] = {}
    flat = vectors.flatten()
    values = np.floor(256 * flat.to_numpy(zero_copy_only=False).astype(np.float64)) if len(flat) else np.zeros(0)
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    there = ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
    names = ids.fill_null(0).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths[there]):
        at = np.flatnonzero(there & (lengths == n))
        m = values[starts[at][:, None] + np.arange(n)] if n else np.zeros((len(at), 0))
        fine = np.isfinite(m).all(axis=1)
        out[int(n)] = (names[at][fine], m[fine])
    return out


def farthest_first(points: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the points, each the farthest from those before."""
    chosen, gap = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as integers; sums beyond 2^53 by Python's, held to the range of a long."""
    top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, len(q))
    if top < 2**53:
        return (x @ q).astype(np.int64)
    whole = [int(a) for a in q]
    return np.array([max(-(2**63), min(2**63 - 1, sum(a * int(b) for a, b in zip(whole, row)))) for row in x], np.int64)


class Pivots:
    """Pivots of one dimension on the sphere of the greatest norm, and the map from distances to places in their span."""

    def __init__(self, points: np.ndarray, top: float, n: int):
        self.top = top
        self.p = farthest_first(self.lifted(points), n)
        u, s, vt = np.linalg.svd(self.p, full_matrices=False)
        fine = s > 1e-5 * s[0] if s[0] > 0 else np.zeros(len(s), bool)
        self.axes, self.map = vt[fine], (u[:, fine] / s[fine])

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(0, self.top - (x**2).sum(axis=1)))[:, None]], axis=1)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 * self.top - 2 * self.lifted(x) @ self.p.T))

    def places(self, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the span, and the rests' lengths, rounded up by more than the arithmetic loses."""
        at = (self.top - distances**2 / 2) @ self.map
        return at, np.sqrt(np.maximum(0, self.top - (at**2).sum(axis=1)) + 1e-8 * self.top)


class Searcher:
    """The k best candidates of each query of one dimension, over candidates that come in blocks."""

    def __init__(self, names: np.ndarray, queries: np.ndarray, pivots: Pivots, k: int, least: np.ndarray):
        self.names, self.q, self.pivots, self.k, self.least = names, queries, pivots, k, least
        self.norm = (queries**2).sum(axis=1)
        flat = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        self.dq = np.sqrt(np.maximum(0, self.norm[:, None] + pivots.top - 2 * flat @ pivots.p.T))
        self.at = flat @ pivots.axes.T
        self.rest = np.sqrt(np.maximum(0, self.norm - (self.at**2).sum(axis=1)) + 1e-8 * self.norm)
        self.slack = 1e-6 * (pivots.top + self.norm) + 1e-6
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in names]
        self.kth = least.astype(np.float64)
        self.evaluated = self.passed = 0

    def add(self, names: np.ndarray, x: np.ndarray, distances: np.ndarray) -> None:
        gap = np.maximum(self.dq - distances.max(axis=0), distances.min(axis=0) - self.dq).max(axis=1)
        upper = (self.norm + self.pivots.top - np.maximum(0, gap) ** 2) / 2 + self.slack
        left = np.flatnonzero(upper >= self.kth)
        self.passed += len(x) * (len(self.names) - len(left))
        if not len(left):
            return
        at, rest = self.pivots.places(distances)
        for i in range(0, len(left), 64):
            some = left[i : i + 64]
            upper = self.at[some] @ at.T + self.rest[some, None] * rest + self.slack[some, None]
            for j in np.flatnonzero((upper >= self.kth[some, None]).any(axis=1)):
                self.search(int(some[j]), names, x, upper[j])

    def search(self, i: int, names: np.ndarray, x: np.ndarray, upper: np.ndarray) -> None:
        scores, ids = self.best[i]
        kth = self.kth[i]
        left = np.flatnonzero(upper >= kth)
        step = 64
        if len(left) > step:
            first = np.argpartition(-upper[left], step)[:step]
            scores, ids = self.merged(i, scores, ids, names, x, left[first])
            kth = max(kth, scores[-1] if len(scores) == self.k else -(2**63))
            rest = np.ones(len(left), bool)
            rest[first] = False
            left = left[rest]
            left = left[upper[left] >= kth]
            left = left[np.argsort(-upper[left], kind="stable")]
        while len(left) and upper[left[0]] >= kth:
            scores, ids = self.merged(i, scores, ids, names, x, left[:step])
            kth = max(kth, scores[-1] if len(scores) == self.k else -(2**63))
            left, step = left[step:], 4 * step
        self.best[i], self.kth[i] = (scores, ids), kth

    def merged(self, i: int, scores: np.ndarray, ids: np.ndarray, names: np.ndarray, x: np.ndarray, at: np.ndarray):
        new = exact_scores(self.q[i], x[at])
        self.evaluated += len(at)
        own = (names[at] != self.names[i]) & (new >= self.least[i])
        scores, ids = np.concatenate([scores, new[own]]), np.concatenate([ids, names[at][own]])
        pairs = np.unique(np.stack([-scores, ids], axis=1), axis=0)[: self.k] if len(ids) else np.zeros((0, 2), np.int64)
        return -pairs[:, 0], pairs[:, 1]


def pivot_table(rows: DataFrame, pivots) -> DataFrame:
    """The table (TABLE): integer vectors, their distances to the pivots, the nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, BLOCK):
            for n, (names, x) in by_dimension(b.column(0), b.column(1)).items():
                if len(names):
                    d = pivots.value[n].distances(x)
                    near = d.argmin(axis=1)
                    blobs = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
                    columns = [pa.array(names, pa.int64()), pa.array([n] * len(names), pa.int32()), blobs(x), blobs(d), pa.array(near, pa.int32()), pa.array(d[np.arange(len(d)), near])]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in TABLE.split(", ")])

    return rows.mapInArrow(run, TABLE)


def scan(table: DataFrame, chunk, k: int, pivots) -> DataFrame:
    """The k best of each query in every partition of the table. chunk: a broadcast of {dimension: (ids, vectors, least scores)}."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = {n: Searcher(names, q.astype(np.float64), pivots.value[n], k, least) for n, (names, q, least) in chunk.value.items()}
        for b in sliced(batches, BLOCK, 64 << 20):
            dims = b.column(1).to_numpy()
            for n in np.unique(dims):
                if n in searchers:
                    own = b.take(pa.array(np.flatnonzero(dims == n)))
                    whole = lambda c: np.frombuffer(b"".join(own.column(c).to_pylist()), np.float64).reshape(own.num_rows, -1)
                    searchers[n].add(own.column(0).to_numpy(), whole(2), whole(3))
        for s in searchers.values():
            for i in range(0, len(s.names), 4096):
                some = s.best[i : i + 4096]
                sizes = [len(x[1]) for x in some]
                if sum(sizes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(s.names[i : i + 4096], sizes)), pa.array(np.concatenate([x[1] for x in some])), pa.array(np.concatenate([x[0] for x in some]))], ["query_id", "vec_id", "score"]
                    )

    return table.select("vec_id", "n", "items", "distances").mapInArrow(run, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5, every: int = 50, n_pivots: int = PIVOTS, chunk_components: int = CHUNK_COMPONENTS
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest integer inner products, ties to the smaller id.

    Queries: rows whose id is divisible by `every`; candidates: all rows with another id. Rows with a
    null id, a null vector or a null or non-finite component take no part; vectors meet only those of
    their own dimension. Equal rows count once; rows of one id with different vectors are candidates
    each, and as a query the least of them counts. No rows give none; further columns are ignored.
    The pivots are chosen, each the farthest from those before, from at most PIVOT_SAMPLE rows of each
    dimension; any choice gives the same result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    rows = rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    norm = F.expr("aggregate(embedding, 0D, (a, x) -> a + pow(floor(256D * x), 2D))")
    # the norms of each dimension, and the rows of least hash; as many rows as dimensions
    spread = rows.select(F.size("embedding").alias("n"), norm.alias("norm"), "embedding", F.xxhash64("vec_id").alias("h"))
    tops = {r["n"]: float(r["top"]) for r in spread.groupBy("n").agg(F.max("norm").alias("top")).collect()}
    pivots: dict[int, Pivots] = {}
    for n, top in tops.items():
        t = spread.filter(F.col("n") == n).orderBy("h").limit(PIVOT_SAMPLE).select(F.lit(0).cast("long").alias("vec_id"), "embedding").toArrow().combine_chunks()
        points = by_dimension(t.column(0).combine_chunks(), t.column(1).combine_chunks())[n][1]
        pivots[n] = Pivots(np.unique(points, axis=0), top, n_pivots)
    known = spark.sparkContext.broadcast(pivots)
    table = pivot_table(rows, known).repartitionByRange("n", "nearest", "gap", "vec_id").sortWithinPartitions("n", "nearest", "gap", "vec_id")
    table = staged(table, "pivot-table")
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    queries = staged(queries, "queries")
    size = queries.agg(F.sum(F.size("embedding") + 4)).first()[0] or 0
    chunks = max(1, -(-size // chunk_components))
    queries = queries.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)))
    seeds = table.filter(F.pmod(F.xxhash64("vec_id"), F.lit(SEED_ONE_IN)) == 0)
    out = None
    for c in range(chunks):
        t = queries.filter(F.col("chunk") == c).select("vec_id", "embedding").toArrow().combine_chunks()
        if not t.num_rows:
            continue
        own = by_dimension(t.column(0).combine_chunks(), t.column(1).combine_chunks())
        none = {n: (names, q, np.full(len(names), -(2**63), np.int64)) for n, (names, q) in own.items() if len(names)}
        first = spark.sparkContext.broadcast(none)
        kth = best(scan(seeds, first, k, known), k).filter(F.col("rank") == k).select("query_id", "score").toPandas()
        least = dict(zip(kth["query_id"], kth["score"]))
        chunk = spark.sparkContext.broadcast({n: (names, q, np.array([least.get(int(i), -(2**63)) for i in names], np.int64)) for n, (names, q, _) in none.items()})
        found = best(scan(table, chunk, k, known), k)
        if chunks > 1:  # one chunk's queries at a time in memory
            found = staged(found, "found")
            chunk.destroy()
        first.destroy()
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], FOUND).withColumn("rank", F.lit(0))
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
