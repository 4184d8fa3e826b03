import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa

from barlens.llm import line_dedup as L

WS = " \t\n\v\f\r"


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(rows, least=20, docs=3):
    """(doc_id, text) -> kept lines of each row, by definition. A null id is the least."""
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[lower(line.strip(WS))].add((doc is not None, doc or 0))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            h = holders[lower(line.strip(WS))]
            if len(lower(line.strip(WS))) < least or len(h) < docs or max(h) == (doc is not None, doc or 0):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def as_set(rows):
    return sorted(map(str, (tuple(r) for r in rows)))


def test_digest_by_brute_force(documents, texts):
    assert as_set(L.digest(documents).collect()) == as_set(brute(list(texts.items())))


def crowd(n=200, seed=3):
    """One line in every document, others in few; lines repeated within a document."""
    rng = random.Random(seed)
    pool = [f"  Line number {k} of the common lines, é and more" for k in range(40)] + ["short", "", "   ", "ÀÉÎÕÜ" * 4, "ÀÉÎÕÜ" * 4 + "x"]
    rows = []
    for i in range(n):
        lines = ["THE line that stands in every single document"] * rng.randint(1, 4)
        lines += [rng.choice(pool).upper() if rng.random() < 0.3 else rng.choice(pool) + rng.choice(["", " ", "\t", "\r"]) for _ in range(rng.randint(0, 12))]
        rng.shuffle(lines)
        rows.append((i // 2 if i % 17 == 0 else i, "\n".join(lines)))
    return rows + [(None, rows[5][1]), (None, rows[6][1]), rows[7], rows[7]]


def test_hot_lines_over_many_ranges(spark):
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert as_set(L.digest(docs).collect()) == as_set(brute(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_stream_is_the_same_for_any_ranges_and_batches():
    """Sorted rows, cut into ranges and batches anywhere: dropped lines, open lines and reports
    always settle to the same drops."""
    rng = random.Random(11)
    rows = sorted({(rng.randint(0, 6), -rng.randint(0, 5) ** 2, 0, k) for k in range(120)})
    want = set()
    for h in {r[0] for r in rows}:
        docs = sorted({r[1] for r in rows if r[0] == h})
        if len(docs) >= 3:
            want |= {(h, d, k) for g, d, _, k in rows if g == h and d != docs[0]}

    def batch(part):
        h, d, r, k = (np.array([x[i] for x in part], np.int64) for i in range(4))
        return pa.RecordBatch.from_arrays([pa.array(-d), pa.array(r), pa.array(k.astype(np.int32)), pa.array(h), pa.array(h * 0)],
                                          names=["doc_id", "row", "pos", "h1", "h2"])

    def pieces(part, n):
        cuts = sorted(rng.sample(range(1, len(part)), min(n, len(part) - 1))) if len(part) > 1 else []
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])]

    for trial in range(200):
        out = []
        for part in pieces(rows, rng.randint(0, 25)):
            for b in L._first_occurrences(iter([batch(x) for x in pieces(part, rng.randint(0, 6))]), 3):
                out += [tuple(x.values()) for x in b.to_pylist()]
        got = {(h, -d, k) for kind, d, _, k, h, _ in out if kind == L.DROPPED}
        seen = defaultdict(set)
        for kind, d, _, _, h, _ in out:
            if kind == L.SEEN:
                seen[h].add(d)
        got |= {(h, -d, k) for kind, d, _, k, h, _ in out if kind == L.OPEN and len(seen[h]) >= 3 and d != max(seen[h])}
        assert got == want


def test_bitmaps_and_general_form(spark):
    line = "a line of more than twenty letters"
    rows = [(k, f"head {k}\n{line}\n{line.upper()} \nfoot", "x") for k in (3, 1, 2)] + [(4, None, "y"), (5, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep string")
    bits = {r["doc_id"]: r for r in L.keep_bitmaps(docs).collect()}
    assert sorted(bits) == [1, 2] and bits[1]["n_dropped"] == 2
    kept = np.unpackbits(np.frombuffer(zlib.decompress(bits[1]["keep"]), np.uint8), bitorder="little")
    assert kept[:3].tolist() == [1, 0, 0]
    out = {r["doc_id"]: (r["text"], r["keep"]) for r in L.dedup_lines(docs).collect()}
    assert out == {1: ("head 1\nfoot", "x"), 2: ("head 2\nfoot", "x"), 3: (rows[0][1], "x"), 4: (None, "y"), 5: ("", "z")}


def test_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert as_set(L.digest(odd).collect()) == as_set(brute(rows))
    assert L.digest(empty).count() == 0
    assert L.dedup_lines(odd).columns == odd.columns
