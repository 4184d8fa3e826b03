import zlib
from math import exp, prod

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlens.llm import toxicity as X
from barlens.llm.common import table
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


@pytest.fixture(scope="module")
def scored(documents, labels):
    return {r["doc_id"]: r for r in X.digest(documents, labels).collect()}


def test_held_out_documents(scored, labels):
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in toxic if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(scored[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in toxic)
    a = np.array([scored[i]["score"] for i in held if toxic[i]])
    b = np.array([scored[i]["score"] for i in held if not toxic[i]])
    assert ((a[:, None] > b).mean() + (a[:, None] == b).mean() / 2) > 0.85
    assert np.mean([scored[i]["predicted"] for i in held if not toxic[i]]) < 0.05
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in scored.values())


def test_held_out_labels_are_not_used(documents, labels, scored):
    spoiled = labels.withColumn("toxic", F.when(X.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {r["doc_id"]: r["score"] for r in X.digest(documents, spoiled).collect()} == {
        i: r["score"] for i, r in scored.items()}


def test_score_is_noisy_or_of_sentences():
    model = X.Model({b"bad": 5.0, b"worse": 7.0}, -6.0, 0.01)
    text = "A fine one. Bad and worse! Only bad here; fine again"
    logits = model.sentence_logits(text)
    assert logits == [-6, 6, -1, -6]
    p = [1 / (1 + exp(-z)) for z in logits]
    assert model.score(logits) == pytest.approx(1 - 0.99 * prod(1 - x for x in p))
    assert model.score([]) == pytest.approx(0.01)


def test_training_locates_the_sentence(spark):
    rng = np.random.default_rng(0)
    rows, marks = [], []
    for i in range(600):
        lines = [" ".join(rng.choice([f"n{j}" for j in range(60)], 6)) for _ in range(8)]
        toxic = int(rng.random() < 0.3)
        if toxic:
            at = int(rng.integers(8))
            lines[at] += " " + str(rng.choice(["scoundrelx", "rascaly"]))
        rows.append((i, ". ".join(lines) + "."))
        marks.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = X.train(docs, spark.createDataFrame(marks, "doc_id long, toxic int"), F.lit(True))
    for (i, text), (_, toxic), r in zip(rows, marks, X.score(docs, model).orderBy("doc_id").collect()):
        assert r["predicted"] == toxic
        where = [n for n, s in enumerate(text.split(".")) if "scoundrelx" in s or "rascaly" in s]
        assert [o["sentence"] for o in r["offending"]] == where


def test_whole_text_is_scored(spark):
    model = X.Model({b"bad": 12.0}, -12.0, 0.001)
    df = spark.createDataFrame([(1, "fine words " * 200_000 + ". bad"), (2, "fine words " * 200_000)], "doc_id long, text string")
    a, b = X.score(df, model).orderBy("doc_id").collect()
    assert a["predicted"] == 1 and b["predicted"] == 0 and len(a["offending"]) == 1


def test_odd_rows(odd, empty, spark, labels):
    marks = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (6, None), (99, 1)], "doc_id long, toxic int")
    got = X.digest(odd, marks).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert {r["score"] for r in X.digest(odd, marks.limit(0)).collect()} == {0.0}
    assert X.digest(empty, labels).count() == 0


def test_all_scores_by_brute_force(documents, labels, texts, scored):
    """Every document's score from the trained weights, word by word and sentence by sentence."""
    import re
    model = X.train(documents, labels, ~X.held_out())
    assert model.weights

    def weight(word):
        word = word.encode()
        parts = [word] + [word[:n] + b"*" for n in (4, 5) if len(word) > n]
        return sum(model.weights.get(p, 0.0) for p in parts)

    for i, text in texts.items():
        clean, offending = 1 - model.leak, 0
        for line in re.split(r"[.!?\n\r;]", text.lower()):
            words = re.sub(r"[^\w'\x80-\U0010ffff]|_", " ", line, flags=re.ASCII).split()
            words = [w for w in words if w]
            for at in range(0, len(words), 40):
                p = 1 / (1 + exp(-(model.bias + sum(map(weight, words[at:at + 40])))))
                clean *= 1 - p
                offending += p >= 0.3
        assert scored[i]["score"] == pytest.approx(1 - clean, abs=1e-9), i
        assert scored[i]["n_offending"] == offending
