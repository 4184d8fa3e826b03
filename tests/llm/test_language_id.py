import numpy as np
import pytest
from pyspark.sql import functions as F

from barlens.llm import language_id as X


@pytest.fixture(scope="module")
def digest(documents):
    return {r["doc_id"]: r for r in X.digest(documents).collect()}


def test_held_out_accuracy(digest, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    import zlib
    held = [i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(digest[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in lang)
    assert np.mean([digest[i]["lang_pred"] == lang[i] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in digest.values())


def test_held_out_labels_are_not_used(documents, digest):
    spoiled = documents.withColumn("lang", F.when(X.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert {r["doc_id"]: r["lang_pred"] for r in X.digest(spoiled).collect()} == {i: r["lang_pred"] for i, r in digest.items()}


def test_kernel_counts_shared_ngrams():
    """Presence rows against sets of n-grams, for texts whose n-grams don't collide."""
    rows = np.zeros((2, X.DIM), np.float32)
    grams = []
    for row, text in zip(rows, ("le chat", "la chatte")):
        points = X.normalise(text)
        X.presence(points, row)
        s = "".join(map(chr, points))
        grams.append({s[i:i + n] for n in range(1, X.NGRAMS + 1) for i in range(len(s) - n + 1)})
    assert [int(r.sum()) for r in rows] == [len(g) for g in grams]
    model = X.Model(["x"], [np.flatnonzero(rows[0]).astype(np.int32)], np.ones((1, 1), np.float32))
    expected = len(grams[0] & grams[1]) / np.sqrt(len(grams[0]) * len(grams[1]))
    assert model.kernel(rows[1:])[0, 0] == pytest.approx(expected, rel=1e-5)


def test_normalise():
    assert "".join(map(chr, X.normalise("Ab, C12\tÉ."))) == " ab c é "
    assert len(X.normalise("12 !")) == 0 and len(X.normalise("")) == 0


def test_long_texts_are_scored_whole(spark):
    """The end of a very long text counts as much as its beginning."""
    train = [("the cat and the dog are with him", "en"), ("le chat et le chien sont avec lui", "fr")] * 5
    model = X.fit([t for t, _ in train], [l for _, l in train])
    half = "the cat and the dog are with him " * 3000
    other = "le chat et le chien sont avec lui " * 9000
    df = spark.createDataFrame([(1, half + other), (2, half * 3 + other[:30_000])], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in X.predict(df, model).collect()}
    assert got == {1: "fr", 2: "en"}
    assert sum(map(len, X.windows(X.normalise(half)))) == len(X.normalise(half))


def test_odd_rows(odd, empty):
    got = X.digest(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] in (1, 2, 3, 7):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (4, 5, 6)} <= {"en", "de"}
    assert X.digest(empty).count() == 0
    kept = X.filter_language(odd, 0.3)
    assert kept.columns == odd.columns and kept.filter("text is null").count() == 0
    nothing = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in X.digest(nothing).collect()} == {"und"}


def dense_fit(texts, langs):
    """The same regression from n-gram sets, whole matrices at once: (labels, coefficients, landmark sets)."""
    def grams(text):
        row = np.zeros(X.DIM, np.float32)
        X.presence(X.normalise(text)[:X.WINDOW], row)
        return frozenset(np.flatnonzero(row).tolist())

    sets = [grams(t) for t in texts]
    labels = sorted(set(langs))
    each = max(1, X.LANDMARKS // len(labels))
    chosen = [i for lang in labels for i in [k for k, x in enumerate(langs) if x == lang][:each]]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    k_nm = np.array([[kernel(s, sets[j]) for j in chosen] for s in sets])
    w = np.array([1 / langs.count(x) for x in langs])
    y = np.array([[x == lang for lang in labels] for x in langs], float)
    left = k_nm.T @ (k_nm * w[:, None]) + X.RIDGE * (k_nm[chosen] + 1e-6 * np.eye(len(chosen)))
    return labels, np.linalg.solve(left, k_nm.T @ (y * w[:, None])), [sets[i] for i in chosen], grams, kernel


def test_scores_by_brute_force(documents, spark):
    """Kernel, regression and scores of a small table, from n-gram sets."""
    rows = [r for r in documents.orderBy("doc_id").limit(90).collect() if r["lang"] and X.normalise(r["text"]).size]
    texts, langs = [r["text"][:X.WINDOW // 2] for r in rows], [r["lang"] for r in rows]
    labels, alpha, marks, grams, kernel = dense_fit(texts, langs)
    model = X.fit(texts, langs)
    assert model.labels == labels and model.alpha == pytest.approx(alpha, rel=2e-2, abs=2e-3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in X.predict(df, model).collect():
        f = np.array([kernel(grams(texts[r["doc_id"]]), m) for m in marks]) @ alpha
        best = np.sort(f)
        if best[-1] - best[-2] > 0.02:
            assert r["lang_pred"] == labels[int(f.argmax())]
            assert r["score"] == pytest.approx(max(f.max(), 0) / np.maximum(f, 0).sum(), abs=0.02)


def test_many_languages_fit_in_bounded_memory():
    """1,500 languages: all are learned, with far less memory than a dense row per text takes."""
    import tracemalloc
    rng = np.random.default_rng(2)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 9000)]
    texts, langs = [], []
    for k in range(1500):
        own = letters[6 * k:6 * k + 6]
        for _ in range(4):
            texts.append("".join(rng.choice(own, 60)))
            langs.append(f"l{k:04}")
    order = rng.permutation(len(texts))
    tracemalloc.start()
    model = X.fit([texts[i] for i in order], [langs[i] for i in order])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.labels) == 1500 and peak < 1e9
    rows = np.zeros((200, X.DIM), np.float32)
    for row, i in zip(rows, order[:200]):
        X.presence(X.normalise(texts[i]), row)
    got = [model.labels[k] for k in model.scores(rows).argmax(axis=1)]
    assert np.mean([g == langs[i] for g, i in zip(got, order)]) > 0.98


def test_sample_is_bounded_and_takes_every_language(spark, monkeypatch):
    monkeypatch.setattr(X, "SAMPLE", 400)
    monkeypatch.setattr(X, "LEAST", 4)
    rows = [(i, f"some text {i}", "hot" if i % 2 else f"l{i % 60}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [r["lang"] for r in X.training_sample(df, F.lit(True)).collect()]
    assert len(set(got)) == 31 and 200 < len(got) <= 800 and got.count("hot") < 60
