from collections import defaultdict

import numpy as np
import pytest

from barlens.llm import near_dup
from barlens.llm.common import WordHashes
from barlens.llm.components import connected_components
from barlens.llm.shingles import Signer, odd_sketch, shingle_set, words_of


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return set() if not w else {tuple(w)} if len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(texts):
    """Least linked id of every document, all pairs that share a shingle compared."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders, common = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for ids in holders.values():
        for n, a in enumerate(ids):
            for b in ids[:n]:
                common[a, b] += 1
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), k in common.items():
        if 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(got, expected):
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_whole_table_against_all_pairs(documents, texts):
    check(near_dup.near_duplicates(documents).collect(), brute(texts))


def test_crowd_of_half_alike_texts(spark):
    """One text copied with many different edits: far apart copies, chains, and copies that
    share much with the crowd but not enough with anyone."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = {}
    for i in range(400):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(0, 14)), replace=False):
            words[at] = f"x{i}_{at}"
        rows[i] = " ".join(words)
    expected = brute(rows)
    assert 1 < len({c for _, c in expected.values()}) < 390
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    check(near_dup.near_duplicates(df).collect(), expected)


def test_odd_rows(odd, empty):
    got = near_dup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i in (1, 2, 3):
        assert (by_id[i]["n_shingles"], by_id[i]["component_id"], by_id[i]["kept"]) == (0, i, True)
    assert by_id[4]["n_shingles"] == 59_996 and by_id[4]["kept"]
    assert (by_id[5]["component_id"], by_id[6]["component_id"]) == (5, 5)
    assert by_id[5]["kept"] and not by_id[6]["kept"]
    assert all(r["kept"] for r in got if r["doc_id"] is None)
    assert by_id[7]["n_shingles"] == 1
    left = near_dup.deduplicate(odd)
    assert left.columns == odd.columns and left.count() == odd.count() - 1
    assert near_dup.near_duplicates(empty).count() == 0 and near_dup.deduplicate(empty).count() == 0


def test_null_id_never_represents(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (9, "a b c d e f"), (3, "A B C D E F")], "doc_id long, text string")
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dup.near_duplicates(df).collect()}
    assert got == {None: (3, False), 9: (3, False), 3: (3, True)}


def test_threshold_is_inclusive(spark):
    """Seven of eight and three of four shingles: 100 * 6 >= 75 * 8 holds, 100 * 5 >= 75 * 7 doesn't."""
    words = [f"v{i}" for i in range(11)]  # 7 shingles
    rows = {1: " ".join(words), 2: " ".join(words[:10] + ["z"]), 3: " ".join([f"u{i}" for i in range(10)]),
            4: " ".join([f"u{i}" for i in range(9)] + ["y"])}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    expected = brute(rows)
    assert expected[2][1] == 1 and expected[4][1] == 4
    check(near_dup.near_duplicates(df).collect(), expected)


def test_repeated_words_keep_shingles_apart():
    memo = WordHashes()
    a, b = ([x.encode() for x in t.split()] for t in ("p q r s p q", "q p p s r p"))
    assert not np.intersect1d(shingle_set(a, 5, memo), shingle_set(b, 5, memo)).size
    rng = np.random.default_rng(1)
    words = [f"{i}".encode() for i in rng.integers(0, 4, 3000)]
    assert len(shingle_set(words, 5, memo)) == len({tuple(words[i:i + 5]) for i in range(2996)})


def test_signature_agreement_estimates_similarity():
    memo, sign = WordHashes(), Signer(2048)
    words = [f"{i}".encode() for i in range(1000)]
    a, b = shingle_set(words[:800], 1, memo), shingle_set(words[200:], 1, memo)
    assert abs((sign(a) == sign(b)).mean() - 0.6) < 0.05
    assert (sign(a) == sign(a[::-1])).all()


@pytest.mark.parametrize("n", [16, 64, 128])
def test_posterior_bound(n):
    """The binomial form equals the numerically integrated posterior; the bound is the
    least count whose posterior probability of reaching the threshold is not below miss."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for m in (0, n // 2, n - 2, n):
        density = grid ** m * (1 - grid) ** (n - m)
        tail = density[grid >= 0.75].sum() / density.sum()
        assert near_dup.upper_tail(m, n, 0.75) == pytest.approx(tail, rel=1e-3, abs=1e-12)
    least = near_dup.least_agreement(n, 0.75, 1e-5)
    assert near_dup.upper_tail(least, n, 0.75) >= 1e-5 > (near_dup.upper_tail(least - 1, n, 0.75) if least else 0)


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, None), (7, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
    assert connected_components(df.limit(0)).count() == 0


def test_words_split_on_ascii_white_space_only():
    assert words_of("A B C d\x0be\x1fÀ".encode()) == ["a b c".encode(), b"d", "e\x1fÀ".encode()]


def test_rows_without_or_with_repeated_ids_leave_one_by_one(spark):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(20)) for k in "abcd")
    rows = [(3, b), (5, b), (5, a), (8, a), (None, a), (None, c), (None, d), (None, d), (None, d + " more")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n long")
    left = near_dup.deduplicate(df)
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert left.columns == df.columns and len(got) == 4
    assert {(3, b), (5, a), (None, c)} < set(got) and len([t for i, t in got if i is None and t.startswith(d)]) == 1


def crowd(m, part, seed, words=100):
    """``m`` texts that share ``part`` of their words, in the same places, and nothing else."""
    rng = np.random.default_rng(seed)
    own = set(rng.choice(words, round(words * (1 - part)), replace=False).tolist())
    return {i: " ".join(f"x{i}_{k}" if k in own else f"w{k}" for k in range(words)) for i in range(m)}


def test_boilerplate_does_not_meet_pair_by_pair(spark):
    """Texts that are boilerplate to four fifths, each a component of its own: what the prefix
    join brings together grows with the texts, not with their pairs."""
    met = []
    for m in (100, 200, 400):
        rows = crowd(m, 0.8, 1)
        df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
        dup = near_dup.NearDup(df)
        members = dup._members()
        sets = dup._sets(members)
        comps = dup._hub_components(members, sets)
        met.append(sum(a.join(b, "shingle").count() for a, b in dup._prefix_sides(members, comps, sets)))
        if m == 100:
            check(dup.digest().collect(), brute(rows))
    assert all(b <= 2.2 * a + 100 for a, b in zip(met, met[1:])), met


@pytest.mark.parametrize("part", [0.93, 0.96, 0.97])
def test_boilerplate_around_the_threshold(spark, part):
    """Shares of one word sequence that bring pairs just below and above the threshold."""
    rows = crowd(60, part, 7, words=200)
    rows |= {100 + i: t for i, t in crowd(60, part - 0.01, 8, words=200).items()}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    check(near_dup.near_duplicates(df).collect(), brute(rows))


def test_crowd_of_copies_with_edits_of_their_own_does_not_meet_pair_by_pair(spark):
    """Copies of one text, a few words of each replaced: any two are below the threshold, but share the shingles
    that no edit took. The pairs left to verify grow with the texts, not with their pairs."""
    left = []
    for m in (100, 200, 400):
        rng = np.random.default_rng(m)
        rows = {}
        for i in range(m):
            words = [f"w{k}" for k in range(150)]
            for at in rng.choice(30, 4, replace=False) * 5:
                words[at] = f"x{i}_{at}"
            rows[i] = " ".join(words)
        dup = near_dup.NearDup(spark.createDataFrame(list(rows.items()), "doc_id long, text string"))
        members = dup._members()
        sets = dup._sets(members)
        left.append(dup._cross_pairs(members, dup._hub_components(members, sets), sets).count())
        if m == 200:
            check(dup.digest().collect(), brute(rows))
    assert all(b <= 2.2 * a + 100 for a, b in zip(left, left[1:])), left


def test_odd_sketches_never_differ_in_more_bits_than_the_sets():
    rng = np.random.default_rng(2)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 3000, int(rng.integers(1, 600)), np.uint64)) for _ in range(2))
        bits = int(np.bitwise_count((odd_sketch(x) ^ odd_sketch(y)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(x, y)) and (bits - len(np.setxor1d(x, y))) % 2 == 0
    assert not odd_sketch(np.empty(0, np.uint64)).any()
