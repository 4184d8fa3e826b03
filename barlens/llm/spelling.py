"""Spelling variant grouping (operator 13): a similarity join of words at edit
distance one by pivotal bigrams.

Bigrams are ordered by their frequency among the words, rarest first. A word's prefix
is its first three bigrams in that order; its two pivots are disjoint bigrams of
the prefix with the least total frequency, chosen by dynamic programming. One edit touches
at most one of two disjoint bigrams, so of two near words the one whose prefix ends first
(in bigram order) has a pivot that the other holds in its prefix, ties of the last
bigram included.

Position limits make the join exact on more than the bigram: behind an untouched
pivot either all before it or all after it is untouched, so the bigram stands in the
same place, counted from that end, in both words. Going on from the pivot, either the next
``STEP`` letters are untouched as well, or all that follows them is. The join key is a hash
of the untouched pieces; a frequent bigram brings together only words that agree in all
but a few letters, or but what follows them. What meets is verified.

A word's form is its near word with most occurrences, if those are ``ratio`` times the
word's. Forms are followed to the last by pointer doubling; every step multiplies the
occurrences, so a few rounds reach the end of any chain.

Defined cases: a null or blank text has no words; a null id counts as the empty text
in the planted deletions; repeated rows count as often as they stand; an empty table gives an
empty table; further columns are not looked at. The bigram table is the only thing
sent to all tasks: the alphabet has 90 letters, so it has at most 8,100 rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.llm import common as C
from barlens.sinks import materialize

RUN = "[a-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
#: Runs whose CRC-32 this divides lose a letter (see ``counted_words``).
PLANT = 97
PREFIX = 3
#: Letters after a pivot that are tried as one piece.
STEP = 4


def planted(run: str, doc: int, plant: int = PLANT) -> str:
    """``run`` with one code point less if ``plant`` divides the CRC-32 of ``<doc_id>:<run>``;
    ``doc``: CRC-32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), doc)
    if h % plant:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count_batches(batches: Iterator[pa.RecordBatch], min_length: int, plant: int) -> Iterator[pa.RecordBatch]:
    """(doc_id as text, text) -> (word, n), counted within a batch."""
    # shorter runs can't give a word, with or without a deletion
    find = re.compile(RUN.replace("+", f"{{{min_length},}}")).findall
    for batch in batches:
        total: Counter = Counter()
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            text = text.as_py()
            if not text:
                continue
            # bytes.lower lowers A-Z only
            runs = Counter(find(text.lower().decode("utf-8", "replace")))
            if plant:
                start = zlib.crc32(f"{doc or ''}:".encode())
                for run, n in runs.items():
                    total[planted(run, start, plant)] += n
            else:
                total.update(runs)
        words = [(w, n) for w, n in total.items() if len(w) >= min_length]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())],
                                         names=["word", "n"])


def counted_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, plant: int = 0) -> DataFrame:
    """(word, n) of every word with ``min_length`` code points and ``min_count`` occurrences.
    With ``plant``, runs are first misspelt as in ``planted``."""
    counted = docs.select(F.col("doc_id").cast("string").alias("doc"), "text").mapInArrow(
        lambda it: _count_batches(it, min_length, plant), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").cast("bigint").alias("n")).filter(F.col("n") >= min_count)


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total: Counter = Counter()
        for word in batch.column(0).to_pylist():
            total.update(map("".join, pairwise(word)))
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                         names=["gram", "n"])


def gram_frequencies(words: DataFrame) -> dict[str, int]:
    """Occurrences of every bigram in the distinct words; bounded by the alphabet squared."""
    grams = words.select("word").mapInArrow(_gram_batches, "gram string, n bigint")
    return {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def pivots(prefix: list[tuple[int, int]]) -> list[int]:
    """Places of the two disjoint bigrams of least total frequency among ``prefix``:
    (place, frequency), by place. Dynamic programming: the best pair that ends in a bigram
    extends the lightest one that ends before it."""
    best = lightest = None
    behind = 0
    for place, weight in prefix:
        while prefix[behind][0] + 2 <= place:
            if lightest is None or prefix[behind][1] < lightest[1]:
                lightest = prefix[behind]
            behind += 1
        if lightest is not None and (best is None or lightest[1] + weight < best[0]):
            best = lightest[1] + weight, [lightest[0], place]
    return best[1]


def _key(*parts) -> int:
    h = xxhash.xxh3_64_intdigest("|".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _seek(r: str, at: int, side: str) -> set[int]:
    """Keys of a word that looks for words with the bigram at ``at`` in the same place and all
    letters before it; the partner may be a letter shorter or longer."""
    end = at + 2 + STEP
    keys = {_key(side, at, r[:at + 2], r[end - d:]) for d in (-1, 0, 1)}     # the edit is in the step
    if len(r) >= end:
        keys.add(_key(side, r[:end]))                                        # it comes later
    return keys


def _hold(s: str, at: int, side: str) -> set[int]:
    """Keys under which a word is found by its bigram at ``at``."""
    end = at + 2 + STEP
    keys = {_key(side, at, s[:at + 2], s[end:])}
    if len(s) >= end:
        keys.add(_key(side, s[:end]))
    return keys


def _key_batches(batches: Iterator[pa.RecordBatch], order: dict[str, int], frequency: dict[str, int],
                 seek: bool) -> Iterator[pa.RecordBatch]:
    """(word) -> (key, word): of its pivots if it seeks, else of all bigrams that are not behind
    the last one of its prefix."""
    made = _seek if seek else _hold
    for batch in batches:
        keys, rows = [], []
        for i, word in enumerate(batch.column(0).to_pylist()):
            grams = [word[k:k + 2] for k in range(len(word) - 1)]
            ranks = [order[g] for g in grams]
            by_rank = sorted(range(len(grams)), key=lambda k: (ranks[k], k))
            if seek:
                places = pivots([(k, frequency[grams[k]]) for k in sorted(by_rank[:PREFIX])])
            else:
                end = ranks[by_rank[PREFIX - 1]]
                places = [k for k, rank in enumerate(ranks) if rank <= end]
            back = word[::-1]
            own = set()
            for at in places:
                own |= made(word, at, ">") | made(back, len(word) - at - 2, "<")
            keys.extend(own)
            rows += [i] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0).take(pa.array(rows, pa.int64()))],
                                         names=["key", "word"])


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(a, na, b, nb), a < b: all pairs of ``words`` (word, n; at least ``min_length`` >= 4 code
    points each) that differ by one inserted, deleted or replaced code point."""
    if min_length < PREFIX + 1:
        raise ValueError(f"words need {PREFIX + 1} code points to have {PREFIX} bigrams")
    frequency = gram_frequencies(words)
    order = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}
    sides = [words.select("word").mapInArrow(lambda it, seek=seek: _key_batches(it, order, frequency, seek), "key bigint, word string")
             for seek in (True, False)]
    met = (sides[0].withColumnRenamed("word", "r").join(sides[1], "key")
           .filter((F.col("r") != F.col("word")) & (F.abs(F.length("r") - F.length("word")) <= 1))
           .filter(F.levenshtein("r", "word", 1) == 1))
    pairs = met.select(F.least("r", "word").alias("a"), F.greatest("r", "word").alias("b")).distinct()
    n = {c: words.select(F.col("word").alias(c), F.col("n").alias(f"n{c}")) for c in "ab"}
    return pairs.join(n["a"], "a").join(n["b"], "b").select("a", "na", "b", "nb")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last one, by pointer doubling.
    Forms must not run in a circle."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        step = materialize(at.join(further, F.col("root") == F.col("__w"), "left")
                           .select("word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")),
                           "spelling-roots")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def group_variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n)."""
    pairs = materialize(near_words(words, min_length), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("other"), F.col("nb").alias("other_n")) \
        .union(pairs.select("b", "nb", "a", "na"))
    near = (both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.first("n").alias("__n"),
                                     F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other"))).alias("best"))
            .withColumn("large", -F.col("best.m") >= F.lit(ratio) * F.col("__n"))
            .select("word", "n_near", F.when(F.col("large"), F.col("best.other")).alias("form"),
                    F.when(F.col("large"), -F.col("best.m")).alias("form_n")))
    near = materialize(near, "spelling-near")
    last = roots(near.filter(F.col("form").isNotNull()))
    return (words.join(near, "word", "left").join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("form_n").cast("bigint").alias("form_n")))


def digest(docs: DataFrame) -> DataFrame:
    """The words of ``docs``, planted misspellings included, with their forms and roots."""
    return group_variants(materialize(counted_words(docs, plant=PLANT), "spelling-words"))
