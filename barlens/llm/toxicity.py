"""Toxicity by multiple-instance learning (operator 6).

Only documents are labelled, but sentences offend. A sentence's probability is
logistic in the weights of its words; a document's is the noisy-or of its
sentences plus a small leak (documents labelled toxic for no visible reason):

    P(doc) = 1 - (1 - leak) * prod(1 - p(sentence))

Training on document labels makes the sentence scores, which then locate the
offending sentences. A word's features are itself and its beginnings, so unseen
forms of a known stem count as well. Features get a weight only if a test on
documents tells their toxic share from the base rate, so rare words of a few
toxic documents stay out.

The model is fitted on a bounded sample of labelled documents, about
``PER_CLASS`` of each label, drawn by a hash of the id and weighted back to the
label's share; documents over ``MAX_BYTES`` are not drawn. Scoring reads whole texts
of any length.

Defined cases: a null or empty text has no sentences and gets the leak; with no
labels at all every score is 0; repeated rows score alike; a document with
several labels counts as toxic if one says so.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, expm1, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlens.llm import common as C

THRESHOLD = 0.3
CUT = log(THRESHOLD / (1 - THRESHOLD))
PER_CLASS = 2000
MAX_BYTES = 200_000
#: Longest instance in words; longer sentences are cut.
SENTENCE = 40
#: Significance (standard deviations) a word needs to get a weight.
SIGMA = 5.0
#: Lengths (bytes) of the word beginnings that are features.
STEMS = (4, 5)
STEPS, RATE = 400, 0.1
#: Strength of the prior on word weights, in documents.
PRIOR = 0.0005
#: Where the bias starts, and what the prior takes for it.
BIAS = -10.0

# Sentence ends become line feeds; other ASCII marks become spaces.
_ENDS = b".!?\n\r;"
_TABLE = bytes(10 if c in _ENDS else c if chr(c).isalnum() or c >= 128 or c == 39 else 32 for c in range(256))


def sentences(text: str) -> Iterator[list]:
    """Word lists (lower-cased, UTF-8) of the sentences of the whole text."""
    for line in text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split(b"\n"):
        words = line.split()
        for at in range(0, len(words), SENTENCE):
            yield words[at:at + SENTENCE]


def features(word: bytes) -> tuple:
    """The word, and its beginnings where it goes on after them."""
    return (word, *(word[:n] + b"*" for n in STEMS if len(word) > n))


class WordWeights(dict):
    """word -> summed weight of its features; forgets when it grows large."""

    LIMIT = 400_000

    def __init__(self, weights: dict[bytes, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        w = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return w


class Model:
    def __init__(self, weights: dict[bytes, float], bias: float, leak: float):
        self.weights, self.bias, self.leak = weights, bias, leak
        self.words = WordWeights(weights)

    def sentence_logits(self, text: str) -> list[float]:
        get = self.words.__getitem__
        return [self.bias + sum(map(get, words)) for words in sentences(text)]

    def score(self, logits: list[float]) -> float:
        """Noisy-or over all sentences, in log space."""
        total = float(np.logaddexp(0.0, np.array(logits)).sum()) - log1p(-self.leak)
        return min(1.0, max(0.0, -expm1(-total)))


def select_features(docs: list[list[list]], y: np.ndarray) -> dict[bytes, float]:
    """Features whose share of sentences in toxic documents differs from the base rate by
    SIGMA, with the log odds of that share (half a sentence added to either side)."""
    distinct = {}  # a sentence counts once, however many copies of its document there are
    for doc, label in zip(docs, y):
        for sentence in doc:
            key = tuple(sentence)
            distinct[key] = max(label, distinct.get(key, 0.0))
    seen, toxic = Counter(), Counter()
    for sentence, label in distinct.items():
        found = {f for w in sentence for f in features(w)}
        seen.update(found)
        if label:
            toxic.update(found)
    base = sum(distinct.values()) / max(1, len(distinct))
    out = {}
    for w, n in sorted(seen.items()):
        if n < 3:
            continue
        # normal approximation of the binomial, with a half count of continuity
        if (abs(toxic[w] - n * base) - 0.5) > SIGMA * np.sqrt(n * base * (1 - base)):
            out[w] = log((toxic[w] + 0.5) / (n - toxic[w] + 0.5))
    return out


def fit(docs: list[list[list]], y: np.ndarray, weight: np.ndarray) -> Model | None:
    """Maximum likelihood of the noisy-or with leak by full-batch Adam."""
    if not len(y):
        return None
    base = float((weight * y).sum() / weight.sum())
    if base in (0.0, 1.0):
        return Model({}, -30.0, base * 0.999)
    odds = select_features(docs, y)
    vocab = {f: i for i, f in enumerate(odds)}
    word, beside, inst, doc_of, n_quiet = [], [], [], [], np.zeros(len(docs))
    for d, doc in enumerate(docs):
        for words in doc:
            known = [[vocab[f] for f in features(w) if f in vocab] for w in words]
            ids = [i for each in known for i in each]
            if ids:
                word += ids
                beside += [len(each) for each in known for _ in each]
                inst += [len(doc_of)] * len(ids)
                doc_of.append(d)
            else:
                n_quiet[d] += 1
    word, beside, inst, doc_of = (np.array(x, np.int64) for x in (word, beside, inst, doc_of))
    k = len(vocab)
    # A sentence with one selected word is expected to have that word's odds, shared among
    # the word's features; several offending words in a document would else be credited to
    # the strongest of them alone.
    features_beside = np.bincount(word, beside, k) / np.maximum(1, np.bincount(word, minlength=k))
    odds = np.array(list(odds.values()))
    theta = np.zeros(k + 2)  # word weights, bias, logit of the leak
    theta[k], theta[k + 1] = BIAS, -5.0
    m, v = np.zeros(k + 2), np.zeros(k + 2)
    share = weight / weight.sum()
    for step in range(1, STEPS + 1):
        w, b, leak = theta[:k], theta[k], 1 / (1 + np.exp(-theta[k + 1]))
        z = b + np.bincount(inst, w[word], len(doc_of))
        soft, sig = np.logaddexp(0, z), 1 / (1 + np.exp(-z))
        quiet_soft, quiet_sig = np.logaddexp(0, b), 1 / (1 + np.exp(-b))
        total = np.bincount(doc_of, soft, len(docs)) + n_quiet * quiet_soft - np.log1p(-leak)
        # d(-log likelihood) / d(total): 1 where clean, -1 / (e**total - 1) where toxic
        g = share * np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-9, 50)), 1.0)
        gz = g[doc_of] * sig
        grad = np.empty(k + 2)
        expected = (odds - BIAS) / np.maximum(1, features_beside)
        grad[:k] = np.bincount(word, gz[inst], k) + PRIOR / len(docs) * (w - expected)
        grad[k] = gz.sum() + (g * n_quiet).sum() * quiet_sig
        grad[k + 1] = g.sum() * leak
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-10)
        theta[k], theta[k + 1] = np.clip(theta[k], -30, 0), np.clip(theta[k + 1], -12, -0.9)
    return Model({w: float(theta[i]) for w, i in vocab.items()}, float(theta[k]), float(1 / (1 + np.exp(-theta[k + 1]))))


def training_sample(docs: DataFrame, labels: DataFrame, usable: Column) -> tuple[DataFrame, dict]:
    """(text, toxic) of a bounded sample, and the share of each label that was drawn."""
    known = (labels.filter(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = known.withColumn("toxic", (F.col("toxic") > 0).cast("int"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {k: min(1.0, PER_CLASS / n) for k, n in counts.items()}
    grid = 1 << 30
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(grid))
    limit = F.when(F.col("toxic") == 1, int(share.get(1, 0) * grid)).otherwise(int(share.get(0, 0) * grid))
    drawn = known.filter(h < limit).select("doc_id", "toxic")
    ids = F.broadcast(drawn.orderBy(h, "doc_id").limit(4 * PER_CLASS))  # bounded by the draw
    texts = (docs.select("doc_id", "text").filter(F.octet_length("text") <= MAX_BYTES)
             .join(ids, "doc_id").orderBy("doc_id", "text").limit(4 * PER_CLASS).select("text", "toxic"))
    return texts, share


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Model | None:
    sample, share = training_sample(docs, labels, usable)
    rows = sample.collect() if share else []
    y = np.array([r["toxic"] for r in rows], np.float64)
    weight = np.array([1 / share[r["toxic"]] for r in rows])
    return fit([list(sentences(r["text"])) for r in rows], y, weight)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score, predicted and the offending sentences of every row: the places (from
    0, in the order of ``sentences``) and probabilities of those that reach the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, found = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                logits = model.sentence_logits(text) if model else []
                s = model.score(logits) if model else 0.0
                scores.append(s)
                found.append([{"sentence": i, "p": 1 / (1 + exp(-z))} for i, z in enumerate(logits) if z >= CUT])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()),
                 pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), pa.array(found, FOUND)],
                names=["doc_id", "score", "predicted", "offending"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, score double, predicted int, offending array<struct<sentence:int,p:double>>")


FOUND = pa.list_(pa.struct([("sentence", pa.int32()), ("p", pa.float64())]))


def held_out() -> Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return F.pmod(C.id_crc(), F.lit(4)) == 2


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_offending; learned from rows not held out."""
    model = train(docs, labels, ~held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted",
                                     F.size("offending").alias("n_offending"))
