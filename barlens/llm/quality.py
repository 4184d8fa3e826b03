"""Quality classifier from weak labels (operator 3).

Overlapping heuristics ("labellers") each vote good, bad or undecided on every
document, or can't judge it (too short) and say nothing. Nobody knows how
reliable they are: expectation-maximisation over the
counts of all vote patterns of the corpus estimates the class share and every
labeller's vote distribution under each class. The posterior class probability
of a document's pattern is its soft label, and soft labels train a hashed linear
scorer on the words and word shapes of a bounded sample, which then scores every
whole text.

All documents are counted: the patterns are summed by Spark, and at most
4 ** labellers of them reach the driver. The scorer is fitted on about
``SAMPLE`` documents drawn by a hash of the id (texts over ``MAX_BYTES`` are not
drawn).

Defined cases: a null, empty or blank text gets no votes, the posterior of that
pattern, score 0 and is not kept; copies and repeated rows score alike; with an
empty table the result is empty; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


KEEP = 0.5
SAMPLE = 4000
MAX_BYTES = 200_000
EM_STEPS = 200
BITS = 16
STEPS, RATE, RIDGE = 200, 0.3, 1e-4

_PUNCTUATION = b".,;:!?'\"()-\xe2\x80\x99"
_SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _PUNCTUATION)
_DIGITS = b"0123456789"


_CLEAN = re.compile(rb"^[\"'(]?[A-Za-z\x80-\xff][A-Za-z\x80-\xff'-]*[\"')]?[.,;:!?]?$")

LABELLERS = ("symbols", "bare marks", "capitals", "digits", "exclamations", "repeated lines", "variety", "stutter",
             "clean words", "plain words", "sentence ends")
#: A labeller that can't judge a text.
SILENT = 2


class Kinds(dict):
    """word -> four flags: clean word, begins like running text, capitals only, marks
    only; forgets when large."""

    LIMIT = 300_000

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        flags = self[w] = (bool(_CLEAN.match(w)) + 2 * (w[0] > 127 or 97 <= w[0] <= 122)
                           + 4 * (len(w) > 1 and w.isupper()) + 8 * (not w.translate(None, _SYMBOLS)))
        return flags


_kinds = Kinds()
#: For each flag, the flag sets that hold it.
_HAS = [[x for x in range(16) if x >> bit & 1] for bit in range(4)]


def _vote(value: float, good: float, bad: float) -> int:
    """1 (good) up to ``good``, -1 (bad) from ``bad`` on, else 0; or the other way round."""
    if good > bad:
        return -_vote(value, bad, good)
    return 1 if value <= good else -1 if value >= bad else 0


def stutters(words: list) -> int:
    """Words that repeat the word before them."""
    return sum(map(eq, words, words[1:]))


def votes(text: bytes) -> list[int]:
    """One vote per labeller: 1 good, -1 bad, 0 undecided, SILENT."""
    words = text.split()
    if not words:
        return [SILENT] * len(LABELLERS)
    n = len(words)
    joined = b"".join(words)
    chars = len(joined)
    lines = [x for x in text.split(b"\n") if x.strip()]
    of_kind = np.bincount(np.fromiter(map(_kinds.__getitem__, words), np.uint8, n), minlength=16)
    clean, plain, shouted, bare = (int(of_kind[has].sum()) for has in _HAS)
    # repeats are judged by stretches, or every long text would look repetitive
    variety = sum(len(set(words[i:i + 100])) for i in range(0, n, 100)) / n
    return [
        _vote((chars - len(joined.translate(None, _SYMBOLS))) / chars, 0.02, 0.08),
        _vote(bare / n, 0.02, 0.1),
        _vote(shouted / n, 0.1, 0.3),
        _vote((chars - len(joined.translate(None, _DIGITS))) / chars, 0.1, 0.3),
        _vote((text.count(b"!") + text.count(b"?")) / n, 0.1, 0.3),
        _vote(1 - len(set(lines)) / len(lines), 0.1, 0.3) if len(lines) > 2 else SILENT,
        _vote(variety, 0.45, 0.3) if n >= 20 else SILENT,
        _vote(stutters(words) / n, 0.02, 0.1) if n >= 5 else SILENT,
        _vote(clean / n, 0.85, 0.6),
        _vote(plain / n, 0.6, 0.3) if n >= 10 else SILENT,
        _vote(sum(1 for x in lines if x.rstrip()[-1:] in b".!?\"'") / len(lines), 0.5, 0.1) if n >= 10 else SILENT,
    ]


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = EM_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(share of the good class, P(vote | class) as [class, labeller, vote + 1]).

    Labellers vote independently given the class; silent ones play no part. Starts from
    the number of bad votes; half a document of each kind keeps all probabilities
    inside (0, 1). Class 1 is the one that good votes favour.
    """
    post = np.choose(np.minimum((patterns == -1).sum(axis=1), 2), [0.9, 0.5, 0.1])
    onehot = (patterns[:, :, None] == np.array([-1, 0, 1])) * 1.0
    for _ in range(steps):
        weight = np.stack([(1 - post) * counts, post * counts])
        share = (weight.sum(axis=1) + 0.5) / (weight.sum() + 1.0)
        table = np.einsum("cp,plv->clv", weight, onehot) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        new = posterior(patterns, share, table)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    if (table[1, :, 2] - table[1, :, 0]).sum() < (table[0, :, 2] - table[0, :, 0]).sum():
        share, table = share[::-1], table[::-1]
    return share, table


def posterior(patterns: np.ndarray, share: np.ndarray, table: np.ndarray) -> np.ndarray:
    """P(good | votes) of each pattern."""
    spoken = patterns != SILENT
    at = np.where(spoken, patterns, 0) + 1
    logs = np.log(share) + np.stack(
        [(np.log(table[c][np.arange(at.shape[1]), at]) * spoken).sum(axis=1) for c in (0, 1)], axis=1)
    logs -= logs.max(axis=1, keepdims=True)
    p = np.exp(logs)
    return p[:, 1] / p.sum(axis=1)


_CLASS = bytes(48 if chr(c).isdigit() and c < 128 else 65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else c
               for c in range(256))
_RUNS = re.compile(rb"([0Aa])\1+")


def shape(word: bytes) -> bytes:
    """Runs of digits, capitals and other letters as one sign each; marks stay."""
    return _RUNS.sub(rb"\1", word.translate(_CLASS))


class ShapeSlots(dict):
    """word with its letters replaced by their classes -> slot of its shape."""

    def __missing__(self, classes: bytes) -> int:
        if len(self) >= Features.LIMIT:
            self.clear()
        slot = self[classes] = xxhash.xxh3_64_intdigest(b"\0" + _RUNS.sub(rb"\1", classes)) >> (64 - BITS)
        return slot


#: Slot that counts words repeating the word before them.
STUTTER = 0


_shape_slots = ShapeSlots()


def slots_of(word: bytes) -> tuple[int, int]:
    """Slots of the lower-cased word and of its shape."""
    return xxhash.xxh3_64_intdigest(word.lower()) >> (64 - BITS), _shape_slots[word.translate(_CLASS)]


class Features(dict):
    """word -> hashed slots of the word and of its shape; forgets when large."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= self.LIMIT:
            self.clear()
        slots = self[word] = slots_of(word)
        return slots


class WordSums(dict):
    """word -> summed weight of its slots; forgets when large."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) >= Features.LIMIT:
            self.clear()
        one, other = slots_of(word)
        s = self[word] = self.weights[one] + self.weights[other]
        return s


class Scorer:
    """Logistic in the mean weight of a text's hashed features."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.sums = WordSums(weights)

    def __call__(self, words: list) -> float:
        total = sum(map(self.sums.__getitem__, words)) + stutters(words) * float(self.weights[STUTTER])
        z = self.bias + total / len(words)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit(texts: list[bytes], soft: np.ndarray) -> Scorer:
    """Logistic regression on soft labels, full-batch Adam on hashed features."""
    slots, size, features, flat = Features(), [], [], []
    for text in texts:
        words = text.split()
        found = [i for w in words for i in slots[w]] + [STUTTER] * stutters(words)
        flat += found
        size.append(len(words))
        features.append(len(found))
    size = np.array(size, np.float64)
    flat = np.array(flat, np.int64)
    doc = np.repeat(np.arange(len(texts)), features)
    k = 1 << BITS
    theta, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, STEPS + 1):
        z = theta[k] + np.bincount(doc, theta[flat], len(texts)) / size
        g = (1 / (1 + np.exp(-z)) - soft) / len(texts)
        grad = np.append(np.bincount(flat, (g / size)[doc], k) + RIDGE / len(texts) * theta[:k], g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta = theta - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Scorer(theta[:k].astype(np.float32), float(theta[k]))


class WeakLabels:
    """The label model of a corpus and the scorer that it trains."""

    def __init__(self, docs: DataFrame):
        names = len(LABELLERS)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = [encode(votes(t.as_py() or b"")) for t in batch.column(0).cast(pa.binary())]
                found, n = np.unique(np.array(codes, np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())],
                                                 names=["pattern", "n"])

        rows = (docs.select("text").mapInArrow(count, "pattern bigint, n bigint")
                .groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect())  # 4 ** labellers at most
        self.patterns = np.array([decode(r["pattern"], names) for r in rows], np.int64).reshape(-1, names)
        self.counts = np.array([r["n"] for r in rows], np.float64)
        self.posterior: dict[int, float] = {}
        if len(rows):
            self.share, self.table = estimate(self.patterns, self.counts)
            p = posterior(self.patterns, self.share, self.table)
            self.posterior = {r["pattern"]: float(x) for r, x in zip(rows, p)}
        self.scorer = self._train(docs)

    def _train(self, docs: DataFrame) -> Scorer | None:
        usable = docs.select("doc_id", "text").filter((F.octet_length("text") <= MAX_BYTES) & (F.length(F.trim("text")) > 0))
        total = int(self.counts.sum())
        grid = 1 << 30
        h = F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality"))
        drawn = usable.filter(F.pmod(h, F.lit(grid)) < int(min(1.0, SAMPLE / max(1, total)) * grid))
        rows = drawn.orderBy(h, "text").limit(2 * SAMPLE).select("text").collect()
        texts = [t for t in (r["text"].encode("utf-8", "surrogatepass") for r in rows) if t.split()]
        if not texts:
            return None
        return fit(texts, np.array([self.posterior[encode(votes(t))] for t in texts]))


def encode(vote: list[int]) -> int:
    code = 0
    for v in vote:
        code = 4 * code + v + 1
    return code


def decode(code: int, names: int) -> list[int]:
    out = []
    for _ in range(names):
        code, v = divmod(code, 4)
        out.append(v - 1)
    return out[::-1]


def classify(docs: DataFrame, model: WeakLabels | None = None) -> DataFrame:
    """doc_id, n_votes, posterior (of the label model), score (of the trained scorer, 0 to
    1) and kept (score of at least KEEP), one row per row of ``docs``."""
    model = WeakLabels(docs) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast((model.posterior, model.scorer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, scorer = shared.value
        for batch in batches:
            n, post, score = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                text = text.as_py() or b""
                vote, words = votes(text), text.split()
                n.append(sum(1 for v in vote if v in (-1, 1)))
                post.append(known.get(encode(vote)))
                score.append(scorer(words) if words and scorer else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(post, pa.float64()), pa.array(score, pa.float64()),
                 pa.array([s >= KEEP for s in score], pa.bool_())],
                names=["doc_id", "n_votes", "posterior", "score", "kept"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_votes int, posterior double, score double, kept boolean")
