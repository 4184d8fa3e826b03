import itertools
import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from barlens.llm import spelling as S


def lower(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def deletions(w):
    return {(w[:i] + w[i + 1:], i) for i in range(len(w))}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(d == a for d, _ in deletions(b))


def brute_words(rows, plant=97):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if plant and h % plant == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute_groups(words):
    out, form = [], {}
    neighbours = {w: [] for w in words}
    by = {}
    for w in words:
        for key in {("del", d) for d, _ in deletions(w)} | {("sub", d, i) for d, i in deletions(w)}:
            by.setdefault(key, set()).add(w)
    for w in words:
        other = set().union(*(by[("sub", d, i)] for d, i in deletions(w))) - {w}
        other |= {d for d, _ in deletions(w) if d in words} | by.get(("del", w), set())
        neighbours[w] = [x for x in other if x != w]
    for w, n in words.items():
        best = min(neighbours[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, n, len(neighbours[w]), words[f] if f else None))
    return sorted(out)


def test_digest_by_brute_force(documents, texts):
    got = sorted(tuple(r) for r in S.digest(documents).collect())
    want = brute_groups(brute_words(texts.items()))
    assert got == want
    assert sum(r[1] is not None for r in want) > 30


def frame(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n long")


def test_join_finds_all_pairs_of_similar_words(spark):
    rng = random.Random(4)
    words = set()
    for seed in ("banana", "aaaaa", "aaaaaa", "ababab", "abababa", "mississippi", "réréré", "ÿabcdé", "zzzzzzzzzz"):
        pool = {seed}
        for _ in range(2):
            for w in rng.sample(sorted(pool), min(len(pool), 12)):
                i = rng.randint(0, len(w))
                pool |= {w[:i] + c + w[i:] for c in "abé"} | {w[:i] + w[i + 1:], w[:i] + "z" + w[i + 1:]}
        words |= {w for w in pool if len(w) >= 5}
    words = {w: rng.randint(3, 50) for w in sorted(words)}
    want = {(a, b) for a, b in itertools.combinations(sorted(words), 2) if near(a, b)}
    got = [(r["a"], r["b"]) for r in S.near_words(frame(spark, words)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 200
    assert sorted(tuple(r) for r in S.group_variants(frame(spark, words)).collect()) == brute_groups(words)


@settings(max_examples=400, deadline=None)
@given(st.text("abc", min_size=5, max_size=12), st.integers(0, 12), st.sampled_from("abcd"), st.sampled_from(["insert", "delete", "replace"]),
       st.randoms())
def test_every_edit_shares_a_key(r, at, letter, edit, rng):
    """For any order of the bigrams, the word whose prefix ends first meets the other."""
    at = min(at, len(r) - (edit != "insert"))
    s = r[:at] + ("" if edit == "delete" else letter) + r[at + (edit != "insert"):]
    if len(s) < 5 or s == r:
        return
    grams = sorted({x[k:k + 2] for x in (r, s) for k in range(len(x) - 1)})
    rng.shuffle(grams)
    order = {g: i for i, g in enumerate(grams)}
    import pyarrow as pa
    words = pa.RecordBatch.from_arrays([pa.array([r, s])], names=["word"])
    seek, hold = (next(S._key_batches(iter([words]), order, {g: 1 + i // 3 for g, i in order.items()}, x)).to_pylist()
                  for x in (True, False))
    last = {w: sorted(order[w[k:k + 2]] for k in range(len(w) - 1))[2] for w in (r, s)}
    assert any(x["key"] == y["key"] and x["word"] != y["word"] and last[x["word"]] <= last[y["word"]] for x in seek for y in hold)


def test_pivots_are_the_lightest_disjoint_pair():
    rng = random.Random(1)
    for _ in range(300):
        places = sorted(rng.sample(range(9), 4 if rng.random() < 0.5 else 3))
        prefix = [(p, rng.randint(1, 9)) for p in places]
        pairs = [(a[1] + b[1]) for a, b in itertools.combinations(prefix, 2) if b[0] - a[0] >= 2]
        chosen = S.pivots(prefix)
        assert chosen[1] - chosen[0] >= 2 and sum(dict(prefix)[p] for p in chosen) == min(pairs)


def test_frequent_bigrams_bring_few_candidates(spark):
    """Words that share their ends and their length but no more of them don't meet."""
    rng = random.Random(9)
    counts = []
    for size in (200, 400, 800):
        words = set()
        while len(words) < size:
            words.add("ab" + "".join(rng.choice("abcdefgh") for _ in range(8)) + "cd")
        words = frame(spark, {w: 3 for w in words})
        frequency = S.gram_frequencies(words)
        order = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}
        seek, hold = (words.select("word").mapInArrow(lambda it, x=x: S._key_batches(it, order, frequency, x), "key bigint, word string")
                      for x in (True, False))
        met = seek.join(hold.select("key"), "key")
        counts.append(met.count() / size)
    assert counts[2] < 2 * counts[0]


def test_chains_are_followed_to_the_end(spark):
    words = {"abcdefghij": 3}
    w = "abcdefghij"
    for k in range(9):
        w = w[:k] + "z" + w[k + 1:]
        words[w] = 3 * 2 ** (k + 1)
    got = {r["word"]: (r["form"], r["root"]) for r in S.group_variants(frame(spark, words)).collect()}
    assert got["abcdefghij"][1] == w and got[w] == (None, w)
    assert sorted(tuple(r) for r in S.group_variants(frame(spark, words)).collect()) == brute_groups(words)


def test_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(tuple(r) for r in S.digest(odd).collect()) == brute_groups(brute_words(rows))
    assert S.digest(empty).count() == 0
    long = spark.createDataFrame([(1, "a" * 3000), (1, "a" * 3000), (2, "a" * 3000 + " " + "a" * 3001)] * 3, "doc_id long, text string")
    assert len(S.group_variants(S.counted_words(long)).collect()) == 2
