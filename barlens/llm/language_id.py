"""Language identification with string kernels (operator 1).

Texts are compared by a blended-spectrum presence kernel: the number of
character n-grams (lengths 1 to 4, hashed) that two texts share, over the
geometric mean of their own numbers. Kernel ridge regression, one language
against the rest, is restricted to a set of landmark texts (Nystroem), so
scoring is two matrix products per batch of texts: presence rows by landmark
rows, kernel rows by coefficients.

A text is lower-cased, everything but letters becomes single spaces, and the
whole of it is scored in windows of ``WINDOW`` characters; a document's scores
are the mean over its windows by length, so long texts don't saturate the
presence rows and need no more memory than short ones.

The model is fitted on a bounded sample: about ``PER_LANGUAGE`` documents of each
language, fewer where languages are many (``SAMPLE`` in all, but ``LEAST`` of each), one
window of each, drawn by a hash of the id. Every language that has usable rows is
learned. Kernel rows are made batch by batch and only their sums are kept, so the fit holds the
sample's texts, the landmark matrix (64 KiB a landmark) and two small square sums.

Defined cases: ``und`` with score 0 where a text is null or has no letter, or
where nothing could be learned; a document's copies get the same answer; equal
scores go to the language first in code point order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlens.llm import common as C
from barlens.sinks import materialize

UND = "und"
WINDOW = 4096
NGRAMS = 4
#: Hashed presence features.
DIM = 1 << 14
#: Windows scored by one matrix product.
BATCH = 128
#: Documents per language that the model is fitted on, in expectation.
PER_LANGUAGE = 400
#: Documents in all that the model is fitted on, in expectation, unless LEAST of each language are more.
SAMPLE = 40_000
LEAST = 8
#: Landmarks, at least one of each language.
LANDMARKS = 128
RIDGE = 1e-3


@lru_cache(1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def normalise(text: str) -> np.ndarray:
    """Code points of the lower-cased text: letters, and one space for each run of
    anything else; with a space on both ends. Empty if there is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.uint32)
    points = np.concatenate(([32], np.where(letter, points, 32), [32])).astype(np.uint32)
    return points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]


def presence(points: np.ndarray, row: np.ndarray) -> None:
    """Mark the n-grams of ``points`` in the zero row ``row``."""
    h = np.zeros(len(points), np.uint32)
    for n in range(1, NGRAMS + 1):
        if len(points) < n:
            break
        h = (h[:len(points) - n + 1] + points[n - 1:]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        row[(h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - 14)] = 1.0


def windows(points: np.ndarray) -> list[np.ndarray]:
    """The whole text in stretches of at most WINDOW, nearly equal in length."""
    return np.array_split(points, -(-len(points) // WINDOW)) if len(points) else []


class Model:
    """Landmark presence rows (as indices), kernel coefficients, languages."""

    def __init__(self, labels: list[str], marks: list[np.ndarray], alpha: np.ndarray):
        self.labels, self.marks, self.alpha = labels, marks, alpha
        self.dense = None

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        if self.dense is None:
            self.dense = np.zeros((DIM, len(self.marks)), np.float32)
            for i, m in enumerate(self.marks):
                self.dense[m, i] = 1 / np.sqrt(len(m))
        return (rows @ self.dense) / np.sqrt(rows.sum(axis=1, keepdims=True))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return self.kernel(rows) @ self.alpha


def fit(texts: list[str], langs: list[str]) -> Model | None:
    """Kernel ridge regression on Nystroem landmarks, each language alike in weight."""
    seen = np.fromiter((any(map(str.isalpha, t)) for t in texts), bool, len(texts))
    used = np.flatnonzero(seen)
    if not len(used):
        return None
    labels = sorted({langs[i] for i in used})
    number = {lang: k for k, lang in enumerate(labels)}
    of = np.array([number[langs[i]] for i in used])

    def rows_of(members: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(members), DIM), np.float32)
        for row, i in zip(rows, members):
            presence(normalise(texts[used[i]])[:WINDOW], row)
        return rows

    each = max(1, LANDMARKS // len(labels))
    # the first of each language, in the order of the sample
    order = np.argsort(of, kind="stable")
    first = np.searchsorted(of[order], np.arange(len(labels)))
    chosen = np.concatenate([order[a:b][:each] for a, b in zip(first, [*first[1:], len(order)])])
    marks = [np.flatnonzero(rows_of([i])[0]).astype(np.int32) for i in chosen]
    model = Model(labels, marks, None)
    weight = 1 / np.bincount(of)[of]
    kk, ky = np.zeros((len(chosen), len(chosen))), np.zeros((len(chosen), len(labels)))
    for at in range(0, len(used), BATCH):
        part = np.arange(at, min(at + BATCH, len(used)))
        k = model.kernel(rows_of(part)).astype(np.float64)
        heavy = k * weight[part, None]
        kk += k.T @ heavy
        np.add.at(ky.T, of[part], heavy)
    k_mm = np.concatenate([model.kernel(rows_of(chosen[i:i + BATCH])) for i in range(0, len(chosen), BATCH)]).astype(np.float64)
    left = kk + RIDGE * (k_mm + 1e-6 * np.eye(len(chosen)))
    model.alpha = np.linalg.solve(left, ky).astype(np.float32)
    model.dense = None
    return model


def training_sample(docs: DataFrame, usable: Column) -> DataFrame:
    """(text window, lang) of some documents of each language, see ``SAMPLE``."""
    labelled = docs.filter(usable & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "text", "lang")
    counts = materialize(labelled.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "language-counts")
    languages = counts.count()
    if not languages:
        return labelled.select("text", "lang").limit(0)
    each = max(LEAST, min(PER_LANGUAGE, SAMPLE // languages))
    grid = 1 << 30
    h = F.xxhash64(F.col("doc_id").cast("string"), F.lit("language"))
    # the number of rows of a language that repeat an id is not bounded by the rate: twice the share is taken at most
    rate = counts.select("of", F.least(F.lit(1.0), F.lit(each) / F.col("n")).alias("rate"))
    start = F.lit(1) + F.pmod(F.xxhash64(h), F.greatest(F.length("text") - WINDOW, F.lit(1))).cast("int")
    return (labelled.join(rate, F.col("lang") == F.col("of")).filter(F.pmod(h, F.lit(grid)) < F.col("rate") * F.lit(grid))
            .select(F.col("text").substr(start, F.lit(WINDOW)).alias("text"), "lang", h.alias("h"))
            .orderBy("h", "text").limit(2 * each * languages).select("text", "lang"))


def train(docs: DataFrame, usable: Column) -> Model | None:
    """Fit on rows of ``docs`` (doc_id, text, lang) that ``usable`` selects."""
    sample = training_sample(docs, usable).collect()
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None, text_at: int) -> Iterator[pa.RecordBatch]:
    """Append lang_pred and score to each batch; column ``text_at`` is the text."""
    buffer = np.zeros((BATCH, DIM), np.float32)
    for batch in batches:
        n = batch.num_rows
        total = np.zeros((n, len(model.labels) if model else 1))
        length, owners, sizes = np.zeros(n), [], []

        def flush():
            if owners:
                f = model.scores(buffer[:len(owners)])
                np.add.at(total, owners, f * np.array(sizes)[:, None])
                buffer[:len(owners)] = 0
                owners.clear(), sizes.clear()

        for i, text in enumerate(batch.column(text_at) if model else ()):
            for points in windows(normalise(text.as_py() or "")):
                presence(points, buffer[len(owners)])
                owners.append(i), sizes.append(len(points))
                length[i] += len(points)
                if len(owners) == BATCH:
                    flush()
        flush()
        best = total.argmax(axis=1)
        positive = np.maximum(total, 0)
        top, whole = positive[np.arange(n), best], positive.sum(axis=1)
        score = np.where(whole > 0, top / np.where(whole > 0, whole, 1), 0.0)
        labels = [model.labels[k] if seen else UND for k, seen in zip(best, length > 0)] if model else [UND] * n
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(labels, pa.string()), pa.array(score, pa.float64())],
            names=[*batch.schema.names, "lang_pred", "score"])


def predict(docs: DataFrame, model: Model | None, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the prediction and its score; input columns of these names give way."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in (pred.lower(), score.lower())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    names = [*docs.columns, pred, score]
    schema = T.StructType([*docs.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(lambda batches: (b.rename_columns(names) for b in _predict(batches, shared.value, at)), schema)


def held_out() -> Column:
    """crc32 of the id as text, modulo 3, is 1."""
    return F.pmod(C.id_crc(), F.lit(3)) == 1


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows not held out."""
    model = train(docs, ~held_out())
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def filter_language(docs: DataFrame, min_score: float, usable: Column | None = None) -> DataFrame:
    """Rows of ``docs`` in a learned language that gets ``min_score`` at least."""
    model = train(docs, F.lit(True) if usable is None else usable)
    pred, score = C.fresh(docs, "lang_pred"), C.fresh(docs, "lang_score")
    return (predict(docs, model, pred, score)
            .filter((F.col(pred) != UND) & (F.col(score) >= min_score)).drop(pred, score))
