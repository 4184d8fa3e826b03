import numpy as np
import pytest

from barlens.llm import quality as X
from barlens.llm.common import table
from tests.llm.conftest import SF


def test_scores_agree_with_hidden_labels(documents, spark):
    """Labels are never used in training; they only judge the result."""
    got = X.classify(documents).join(table(spark, SF, "labels").select("doc_id", "quality"), "doc_id").collect()
    bad = [r for r in got if r["quality"] == 0]
    good = [r for r in got if r["quality"] == 1]
    assert np.mean([not r["kept"] for r in bad]) > 0.8
    assert np.mean([r["kept"] for r in good]) > 0.98
    assert all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] >= X.KEEP) for r in got)


def test_patterns_count_every_document(documents):
    model = X.WeakLabels(documents)
    assert model.counts.sum() == documents.count()
    assert set(model.posterior) >= {X.encode(X.votes(r["text"].encode())) for r in documents.limit(50).collect()}


def test_estimation_recovers_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(20_000) < 0.8
    accuracy = np.array([0.95, 0.9, 0.8, 0.75, 0.6])
    right = rng.random((len(truth), 5)) < accuracy
    votes = np.where(right == truth[:, None], 1, -1)
    votes[rng.random(votes.shape) < 0.2] = X.SILENT
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, tables = X.estimate(patterns, counts.astype(float))
    assert share[1] == pytest.approx(0.8, abs=0.02)
    for i, a in enumerate(accuracy):
        spoken = tables[:, i, [0, 2]] / tables[:, i, [0, 2]].sum(axis=1, keepdims=True)
        assert spoken[1, 1] == pytest.approx(a, abs=0.03) and spoken[0, 0] == pytest.approx(a, abs=0.05)


def test_codes():
    vote = [1, -1, 0, X.SILENT, 1, 1, -1, 0, 0, X.SILENT, 1]
    assert X.decode(X.encode(vote), len(vote)) == vote


def test_odd_rows(odd, empty):
    got = X.classify(odd).collect()
    assert len(got) == odd.count()
    assert all((r["score"], r["kept"], r["n_votes"]) == (0.0, False, 0) for r in got if r["doc_id"] in (1, 2, 3))
    pairs = {}
    for r in got:
        pairs.setdefault(r["doc_id"], set()).add((r["score"], r["posterior"]))
    assert len(pairs[4]) == 1 and pairs[5] == pairs[6]
    assert X.classify(empty).count() == 0


def test_label_model_document_by_document(documents):
    """EM over documents instead of vote patterns, with plain loops over classes and labellers."""
    rows = [r["text"] for r in documents.orderBy("doc_id").limit(150).collect()]
    votes = [X.votes((t or "").encode()) for t in rows]
    post = [[0.9, 0.5, 0.1][min(2, v.count(-1))] for v in votes]
    for _ in range(X.EM_STEPS):
        mass = [sum(1 - p for p in post), sum(post)]
        share = [(m + 0.5) / (sum(mass) + 1.0) for m in mass]
        table = [[{v: 0.5 for v in (-1, 0, 1)} for _ in X.LABELLERS] for _ in (0, 1)]
        for p, vote in zip(post, votes):
            for k, v in enumerate(vote):
                if v != X.SILENT:
                    table[0][k][v] += 1 - p
                    table[1][k][v] += p
        for c in (0, 1):
            for k in range(len(X.LABELLERS)):
                total = sum(table[c][k].values())
                table[c][k] = {v: x / total for v, x in table[c][k].items()}
        new = []
        for vote in votes:
            like = [share[c] * np.prod([table[c][k][v] for k, v in enumerate(vote) if v != X.SILENT]) for c in (0, 1)]
            new.append(like[1] / sum(like))
        moved = max(abs(a - b) for a, b in zip(new, post))
        if moved < 1e-9:
            break
        post = new
    good = sum(table[1][k][1] - table[1][k][-1] for k in range(len(X.LABELLERS)))
    bad = sum(table[0][k][1] - table[0][k][-1] for k in range(len(X.LABELLERS)))
    if good < bad:
        new = [1 - p for p in new]
    model = X.WeakLabels(documents.orderBy("doc_id").limit(150))
    got = [model.posterior[X.encode(v)] for v in votes]
    assert got == pytest.approx(new, abs=1e-6)


def test_votes_and_scores_by_definition(documents, spark):
    """Some labellers from the words of a text, and the trained scorer as a mean of weights."""
    rows = documents.orderBy("doc_id").limit(120).collect()
    model = X.WeakLabels(documents)
    names = list(X.LABELLERS)
    got = {r["doc_id"]: r for r in X.classify(spark.createDataFrame(rows, documents.schema), model).collect()}
    for r in rows:
        words, text = r["text"].encode().split(), r["text"].encode()
        vote = X.votes(text)
        assert len(vote) == len(names) and got[r["doc_id"]]["n_votes"] == sum(v in (1, -1) for v in vote)
        marks = (r["text"].count("!") + r["text"].count("?")) / max(1, len(words))
        assert vote[4] == (X.SILENT if not words else 1 if marks <= 0.1 else -1 if marks >= 0.3 else 0)
        lines = [x for x in text.split(b"\n") if x.strip()]
        again = 1 - len(set(lines)) / len(lines) if lines else 0
        assert vote[5] == (X.SILENT if len(lines) <= 2 else 1 if again <= 0.1 else -1 if again >= 0.3 else 0)
        if not words:
            continue
        z = model.scorer.bias + sum(float(model.scorer.weights[s]) for w in words for s in X.slots_of(w)) / len(words)
        z += sum(a == b for a, b in zip(words, words[1:])) * float(model.scorer.weights[X.STUTTER]) / len(words)
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-5)
