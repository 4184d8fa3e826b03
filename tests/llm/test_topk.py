import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlens.llm import topk as X
from barlens.llm.common import table
from tests.llm.conftest import SF


def brute(rows, k=20):
    """rows: (id, integer vector); all pairs in Python integers."""
    out = set()
    for q, v in rows:
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows
                            if (i, w) != (q, v) and len(w) == len(v))
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def test_whole_table(spark):
    e = table(spark, SF, "embeddings")
    rows = [(r["vec_id"], tuple(int(np.floor(64 * float(x))) for x in r["embedding"])) for r in e.collect()]
    assert {tuple(r) for r in X.digest(e).collect()} == brute(rows)


def test_several_stripes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(X, "STRIPE", 60)
    monkeypatch.setattr(X, "BLOCK", 7)
    monkeypatch.setattr(X, "FIRST", 30)
    e = table(spark, SF, "embeddings")
    rows = [(r["vec_id"], tuple(int(np.floor(64 * float(x))) for x in r["embedding"])) for r in e.collect()]
    assert {tuple(r) for r in X.digest(e).collect()} == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 4), st.sampled_from([1, 30, 10 ** 6, 10 ** 12]), st.integers(1, 12))
def test_bounds_lose_nothing(seed, dim, spread, pivots):
    """Random stripes, also with many ties and with large numbers, against all products."""
    rng = np.random.default_rng(seed)
    n, k = 400, 5
    x = rng.integers(-spread, spread + 1, (n, dim))
    q = x[:20]
    ids = rng.permutation(n).astype(np.int64)
    space = X.Space(float((x.astype(float) ** 2).sum(axis=1).max()), X.choose_pivots(x[rng.permutation(n)[:50]], pivots))
    table_ = space.candidate_table(x.astype(float)).astype(np.float32)
    exact = X.exact_in_double(x, q)
    xs, qs = (x.astype(float), q.astype(float)) if exact else (x, q)
    got, _ = X.search(ids, xs, table_, ids[:20], qs, space.query_table(q.astype(float)), space, k)
    for i, (found, score) in enumerate(got):
        every = sorted((-int(sum(int(a) * int(b) for a, b in zip(q[i], w))), int(j)) for j, w in zip(ids, x) if j != ids[i])
        clip = [(-min(max(-s, -2 ** 63), 2 ** 63 - 1), j) for s, j in every]
        clip = sorted(clip)[:k]
        assert [(int(-s), int(j)) for s, j in zip(score, found)] == clip


def test_clusters_are_pruned():
    rng = np.random.default_rng(0)
    centres = rng.integers(-60, 60, (10, 8))
    x = np.repeat(centres, 200, axis=0) + rng.integers(-2, 3, (2000, 8))
    x = x.astype(float)
    space = X.Space(float((x ** 2).sum(axis=1).max()), X.choose_pivots(x[::3], 16))
    ids = np.arange(2000)
    q = x[::250]
    _, evaluated = X.search(ids, x, space.candidate_table(x).astype(np.float32), ids[::250], q, space.query_table(q), space, 20)
    assert evaluated < 0.5 * len(q) * len(x)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (0, [1.0, 0.0], "x"), (0, [0.5, 0.5], "x"), (1, [1.0, 1.0], "x"), (2, None, "x"),
            (3, [1.0, None], "x"), (4, [nan, 1.0], "x"), (5, [inf, 1.0], "x"), (6, [2.0], "x"), (None, [1.0, 1.0], "x"),
            (20, [1e15, 1e15], "x"), (40, [], "x"), (41, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = sorted(tuple(r) for r in X.digest(df).collect())
    big = 64 * 10 ** 15
    assert got == sorted([
        (0, 1, 20, 64 * big), (0, 2, 1, 4096), (0, 3, 0, 2048),
        (0, 1, 20, 64 * big), (0, 2, 1, 4096), (0, 3, 0, 2048),
        (20, 1, 1, 128 * big), (20, 2, 0, 64 * big), (20, 3, 0, 64 * big), (40, 1, 41, 0)])
    assert X.digest(df.limit(0)).count() == 0
    assert X.digest(df.filter(F.col("vec_id") == 40)).count() == 0
