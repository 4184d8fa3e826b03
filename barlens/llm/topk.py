"""Exact top-k by inner product with pivot-table elimination (operator 9).

Vectors are turned into integers, floor(64 * x). A further coordinate makes the
longest vector's length common to all candidates, so the largest inner product
is the smallest Euclidean distance:

    |q' - x'|**2 = |q|**2 + M**2 - 2 * q.x

The distances of every vector to ``PIVOTS`` pivots are computed once. For a query,
the largest difference between its own and a candidate's pivot distances bounds
their distance from below, hence the score from above. The candidates of the
best bounds are evaluated first; then, of the others, exactly those whose bound
still reaches the k-th best score so far. The rest can't enter the result.

Candidates are cut into stripes and queries into blocks; each (block, stripe) is
one group of bounded size that yields k rows per query, and Spark ranks those.

Defined cases: vectors that are null or hold a null, NaN or infinite component
take no part, nor do rows without id; vectors of different length are never
compared; equal rows (id and integers) count once, a query's own row never; equal
scores are ranked by id; an empty table gives an empty result. Scores beyond a
bigint are clipped to it. Every row is indexed: the pivots alone come from a
bounded sample.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlens.sinks import materialize

SCALE = 64
K = 20
PIVOTS = 64
#: Vectors that the pivots are chosen from.
SAMPLE = 1000
STRIPE, BLOCK = 4096, 4096
#: Candidates evaluated first, and queries handled at once.
FIRST, BATCH = 128, 32


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, v): the usable rows as integers, equal rows once."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (embeddings.select("vec_id", "embedding")
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.size("embedding").alias("dim"),
                    F.transform(e, lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"))
            .distinct())


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), dim)


def exact_in_double(x: np.ndarray, q: np.ndarray) -> bool:
    """Whether every partial sum of an inner product is an exact integer in a double."""
    return float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1]) < 2.0 ** 53


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products (rows of q by rows of x), clipped to 64 bits."""
    if x.dtype == np.float64:
        return q @ x.T
    return np.clip((q.astype(object) @ x.astype(object).T), -2 ** 63, 2 ** 63 - 1).astype(np.int64).reshape(len(q), len(x))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those already chosen."""
    x = sample.astype(np.float64)
    chosen = [0]
    far = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(x)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


class Space:
    """The extended space of one vector length: longest length, pivots."""

    def __init__(self, longest2: float, pivots: np.ndarray):
        self.longest2, self.pivots = longest2, pivots
        self.pivot2 = (pivots ** 2).sum(axis=1)
        self.pivot_extra = np.sqrt(np.maximum(longest2 - self.pivot2, 0))

    def candidate_table(self, x: np.ndarray) -> np.ndarray:
        """Distances of candidates to the pivots, one row per pivot."""
        x2 = (x ** 2).sum(axis=1)
        extra = np.sqrt(np.maximum(self.longest2 - x2, 0))
        d2 = x2 + self.pivot2[:, None] - 2 * (self.pivots @ x.T) + (extra - self.pivot_extra[:, None]) ** 2
        return np.sqrt(np.maximum(d2, 0))

    def query_table(self, q: np.ndarray) -> np.ndarray:
        """Distances of queries to the pivots, one row per query."""
        d2 = (q ** 2).sum(axis=1)[:, None] + self.longest2 - 2 * (q @ self.pivots.T)
        return np.sqrt(np.maximum(d2, 0))


def best_of(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def search(ids: np.ndarray, x: np.ndarray, table: np.ndarray, q_ids: np.ndarray, q: np.ndarray, near: np.ndarray,
           space: Space, k: int) -> tuple[list, int]:
    """For each query of a batch the (ids, scores) of the k best candidates of a stripe; and
    how many candidates were evaluated in all."""
    own = [np.flatnonzero(ids == i) for i in q_ids]
    own = [at[(x[at] == v).all(axis=1)] for at, v in zip(own, q)]
    q2 = (q.astype(np.float64) ** 2).sum(axis=1) + space.longest2
    # the bounds are computed in floating point: leave room for their rounding
    slack = 1e-5 * q2 + 1.0
    lower = np.zeros((len(q), len(ids)), np.float32)
    for row, d in zip(table, near.T.astype(np.float32)):
        np.maximum(lower, np.abs(row[None, :] - d[:, None]), out=lower)
    evaluated, out = 0, []
    alive = np.ones(lower.shape, bool)
    if len(ids) > FIRST:
        first = np.argpartition(lower, FIRST - 1, axis=1)[:, :FIRST]
        for i in range(len(q)):
            at = np.setdiff1d(first[i], own[i])
            if len(at) >= k:
                score = products(x[at], q[i:i + 1])[0]
                kth = np.partition(score, len(at) - k)[len(at) - k]
                alive[i] = (q2[i] - lower[i].astype(np.float64) ** 2) / 2 + slack[i] >= kth
                alive[i, first[i]] = True
    # what bounds leave of most candidates is cheaper as one product
    dense = products(x, q) if alive.mean() > 0.2 else None
    for i in range(len(q)):
        alive[i, own[i]] = False
        at = np.flatnonzero(alive[i])
        evaluated += len(at)
        score = dense[i, at] if dense is not None else products(x[at], q[i:i + 1])[0]
        top = best_of(ids[at], score, k)
        out.append((ids[at][top], score[top].astype(np.int64)))
    return out, evaluated


RESULT = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def top_k(embeddings: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row with ``is_query``."""
    spark = embeddings.sparkSession
    vectors = materialize(quantised(embeddings, scale), "topk-vectors")
    dims = vectors.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("int")).alias("nq"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("longest2"))
    found = None
    for d in dims.filter("n > 1 and nq > 0").collect():  # one row per vector length
        part = _search_length(vectors.filter(F.col("dim") == d["dim"]), d, is_query, k, pivots)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search_length(vectors: DataFrame, d, is_query: Column, k: int, pivots: int) -> DataFrame:
    dim, n, nq = d["dim"], d["n"], d["nq"]
    sample = vectors.orderBy(F.xxhash64("vec_id"), "v").limit(SAMPLE).select("v").collect()
    space = Space(d["longest2"], choose_pivots(np.array([r["v"] for r in sample], np.int64).reshape(len(sample), dim),
                                               pivots))
    shared = vectors.sparkSession.sparkContext.broadcast(space)

    # the pivot table: computed once per vector, before it is sent to the blocks
    def with_table(batches):
        for b in batches:
            # single precision will do: bounds leave room for rounding
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, dim)
            t = shared.value.candidate_table(x).T
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(list(np.ascontiguousarray(t, np.float32)), pa.list_(pa.float32()))], names=["vec_id", "v", "t"])

    stripes, blocks = ceil(n / STRIPE), ceil(nq / BLOCK)
    row = F.xxhash64("vec_id", "v")
    candidates = (vectors.select("vec_id", "v").mapInArrow(with_table, "vec_id bigint, v array<bigint>, t array<float>")
                  .withColumn("stripe", F.pmod(row, F.lit(stripes)).cast("int"))
                  .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    queries = (vectors.filter(is_query).select(F.col("vec_id").alias("query_id"), "v", row.alias("query_row"))
               .withColumn("block", F.pmod("query_row", F.lit(blocks)).cast("int"))
               .withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))))

    def group(qs: pa.Table, xs: pa.Table) -> pa.Table:
        space, out = shared.value, []
        if qs.num_rows and xs.num_rows:
            x, q = matrix(xs["v"], dim), matrix(qs["v"], dim)
            if exact_in_double(x, q):
                x, q = x.astype(np.float64), q.astype(np.float64)
            ids, q_ids, q_rows = (c.to_numpy() for c in (xs["vec_id"], qs["query_id"], qs["query_row"]))
            table = xs["t"].combine_chunks().flatten().to_numpy().reshape(len(ids), len(space.pivots))
            table = np.ascontiguousarray(table.T)
            near = space.query_table(q.astype(np.float64))
            for at in range(0, len(q), BATCH):
                part = slice(at, at + BATCH)
                found, _ = search(ids, x, table, q_ids[part], q[part], near[part], space, k)
                out += [(np.full(len(got), r), np.full(len(got), i), got, score)
                        for r, i, (got, score) in zip(q_rows[part], q_ids[part], found)]
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_row", "query_id", "vec_id", "score"), cols)})

    return (queries.groupBy("block", "stripe").cogroup(candidates.groupBy("block", "stripe"))
            .applyInArrow(group, RESULT))


def digest(embeddings: DataFrame) -> DataFrame:
    """Queries: rows whose vec_id is divisible by 20."""
    return top_k(embeddings, F.col("vec_id") % 20 == 0)


SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
