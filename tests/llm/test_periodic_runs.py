import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from barlens.llm import periodic_runs as P


def smallest_period(s):
    return next(q for q in range(1, len(s) + 1) if all(s[k] == s[k + q] for k in range(len(s) - q)))


def brute_runs(s, least=12):
    """By definition: for each period the maximal stretches, if no smaller period fits."""
    out = []
    for q in range(1, len(s) // 2 + 1):
        a = 0
        while a + q < len(s):
            b = a
            while b + q < len(s) and s[b] == s[b + q]:
                b += 1
            size = b - a + q
            if size >= max(least, 2 * q) and smallest_period(s[a:a + size]) == q:
                out.append((a, size, q))
            a = max(a + 1, b)
    return sorted(out)


def brute_digest(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {k for a, size, q in runs for k in range(a + q, a + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 12))
def test_runs_of_small_alphabets(words, least):
    assert P.runs(np.array(words, np.int64), least) == brute_runs(words, least)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 4), min_size=1, max_size=9), st.integers(1, 6)), max_size=5))
def test_runs_of_planted_repeats(parts):
    words = [w for block, times in parts for w in block * times]
    assert P.runs(np.array(words, np.int64)) == brute_runs(words)


def test_fibonacci_words_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    assert P.runs(np.array(b)) == brute_runs(b)
    assert P.runs(np.zeros(5000, np.int64)) == [(0, 5000, 1)]
    assert P.runs(np.arange(5000)) == []
    assert P.runs(np.tile(np.arange(700), 30)) == [(0, 21000, 700)]


def test_filter_leaves_no_run_out():
    rng = np.random.default_rng(5)
    for q in (1, 5, 6, 7, 13):
        for size in {max(12, 2 * q), max(12, 2 * q) + 1, 5 * q + 12}:
            words = np.concatenate([rng.integers(100, 10 ** 6, 40), np.resize(np.arange(q), size), rng.integers(100, 10 ** 6, 40)])
            assert P.runs(words) == [(40, size, q)]


def test_digest_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = {r["doc_id"]: brute_digest(r["doc_id"], r["text"]) for r in rows if len((r["text"] or "").split()) < 800}
    got = {r["doc_id"]: tuple(r) for r in P.digest(docs).collect()}
    assert len(got) == len(rows) and len(want) > 150
    assert {k: got[k] for k in want} == want
    assert sum(v[1] > 0 for v in want.values()) > 10


def test_odd_rows(spark, odd, empty):
    got = P.digest(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] in (1, 2, 3) or (r["doc_id"] is None and r["n_runs"] == 0):
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (None,) * 4
            assert r["runs_sha256"] == hashlib.sha256(b"").hexdigest()
    assert {r["collapsed_sha256"] for r in got if r["doc_id"] in (1, 2, 3)} == {hashlib.sha256(b"").hexdigest()}
    assert P.digest(empty).count() == 0 and P.periodic_runs(empty).count() == 0 and P.collapse(empty).count() == 0
    assert P.collapse(odd).columns == odd.columns
    short = odd.filter("length(text) < 1000 or text is null")
    assert sorted(map(str, P.collapse(short).collect())) == sorted(map(str, short.collect()))


def test_collapse_keeps_one_period(spark):
    text = "start of it " + "alpha beta gamma delta " * 5 + "alpha end"
    docs = spark.createDataFrame([(1, text, "x"), (2, "no  runs\nhere", "y"), (3, None, "z")], "id long, text string, row string")
    docs = docs.withColumnRenamed("id", "doc_id")
    got = {r["doc_id"]: r["text"] for r in P.collapse(docs).collect()}
    assert got == {1: "start of it alpha beta gamma delta end", 2: "no  runs\nhere", 3: None}
    assert [tuple(r)[2:] for r in P.periodic_runs(docs).collect()] == [(3, 21, 4)]
