"""Periodic run detection (operator 11): suffix automaton with link-cut access.

A run is a maximal stretch of words with smallest period q that holds at least two
periods. The suffix automaton of the words gives the tree of suffix links; the words are
then appended one by one, and each append accesses the path from the node of the new
prefix to the root, as a link-cut tree does: the path falls into segments whose nodes
last occurred at the same place, and all of it is recoloured with the new place. Where a
segment's words last ended at j and the new prefix ends at i, the distance i - j is
a period; if it is at most the segment's length there is a square, which ends
at i and starts where the segment does, i.e. it is extended to the left already. It
is extended to the right word by word, once for each period. Of a primitive square's last
period the previous end is exactly one period back, so no run escapes.

The tree is built before the accesses, so its heavy paths can hold the segments:
on each, they form a stack from the root's end down, and an access pops what it
recolours and pushes one entry. Each word adds one entry per heavy path it meets, of
which there are at most log n, and whatever is popped was pushed once: n log n in all.

Before that, an exact filter: each word of a run of ``min_length`` words lies in a
window of ``min_length`` / 2 words that stands twice within the run. Stretches without
repeated windows hold no run and never reach the automaton; on plain prose nothing does.

Defined cases: a null or empty text has no words and no run; a null id counts as the
empty text in the planted periods; repeated rows are judged each; an empty
table gives an empty table; other columns pass through. A text is handled in one task; its
automaton takes about 500 bytes for each word of its periodic stretches.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.llm import common as C

MIN_LENGTH = 12
#: Rounds of the filter, each within the stretches of the one before.
ROUNDS = 3


def _automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix automaton: links and lengths of the states, and the state of each prefix. State 0 is the root."""
    after: list[dict] = [{}]
    link, length, ends = [-1], [0], []
    last = 0
    for w in words:
        state = len(link)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in after[p]:
            after[p][w] = state
            p = link[p]
        if p >= 0:
            q = after[p][w]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(link)
                after.append(after[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[state] = copy
                while p >= 0 and after[p].get(w) == q:
                    after[p][w] = copy
                    p = link[p]
        last = state
        ends.append(state)
    return link, length, ends


def _heavy_tops(link: list[int], length: list[int]) -> list[int]:
    """The upper end of each state's heavy path."""
    down = np.argsort(np.asarray(length), kind="stable").tolist()    # parents before children
    size = [1] * len(link)
    heavy = [-1] * len(link)
    best = [0] * len(link)
    for v in reversed(down):
        p = link[v]
        if p >= 0:
            size[p] += size[v]
            if size[v] > best[p]:
                best[p], heavy[p] = size[v], v
    top = list(range(len(link)))
    for v in down:
        p = link[v]
        if p >= 0 and heavy[p] == v:
            top[v] = top[p]
    return top


def squares(words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(start, end, period), both ends included: the longest stretch around each square
    that the accesses meet; a stretch may come again with a multiple of its period."""
    link, length, ends = _automaton(words)
    top = _heavy_tops(link, length)
    stacks: list[list | None] = [None] * len(link)
    reached: dict[int, int] = {}                # period -> end of its latest stretch
    n = len(words)
    for i, v in enumerate(ends):
        while v > 0:
            head = top[v]
            depth = length[v]
            stack = stacks[head]
            if stack is None:
                stacks[head] = [(depth, i)]
            else:
                met = []
                covered = 0
                while stack and stack[-1][0] <= depth:
                    met.append(stack.pop())
                    covered = met[-1][0]
                if stack and covered < depth:
                    met.append((depth, stack[-1][1]))
                stack.append((depth, i))
                for reach, j in reversed(met):
                    period = i - j
                    if period <= reach and reached.get(period, -1) < i:
                        end = i
                        while end + 1 < n and words[end + 1] == words[end + 1 - period]:
                            end += 1
                        reached[period] = end
                        yield j - reach + 1, end, period
            v = link[head]


def _stretches(ids: np.ndarray, window: int, least: int, rounds: int) -> list[tuple[int, int]]:
    """[from, to) of the maximal stretches covered by windows that stand at least twice
    in them; ``rounds`` bounds how often a stretch is looked at again on its own."""
    done, work = [], [(0, len(ids), 0)]
    while work:
        a, b, again = work.pop()
        if b - a < least:
            continue
        part = ids[a:b]
        n = len(part) - window + 1
        h = np.zeros(n, np.uint64)
        for i in range(window):
            h = C.mix64(h * np.uint64(31) + part[i:i + n])
        _, at, counts = np.unique(h, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(counts[at] > 1)
        if not len(twice):
            continue
        cover = np.zeros(len(part) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + window, -1)
        covered = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
        edges = np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2)
        whole = len(edges) == 1 and edges[0][1] - edges[0][0] == len(part)
        for x, y in edges.tolist():
            if whole or again + 1 >= rounds:
                if y - x >= least:
                    done.append((a + x, a + y))
            else:
                work.append((a + x, a + y, again + 1))
    return done


def runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``min_length`` words, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    for a, b in _stretches(np.asarray(ids, np.uint64), min_length // 2, min_length, ROUNDS):
        for start, end, period in squares(np.asarray(ids[a:b]).tolist()):
            size = end - start + 1
            if size >= min_length and size >= 2 * period:
                key = a + start, size
                if period < found.get(key, size):
                    found[key] = period
    return sorted((start, size, period) for (start, size), period in found.items())


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word's number among the distinct words, exact."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def planted(n: int, h: int) -> np.ndarray | None:
    """Which original word stands at each of ``n`` places if ``h`` asks for a period, else None."""
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def repeats(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each of ``n`` words stands in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, size, period in found:
        change[start + period] += 1
        change[start + size] -= 1
    return np.cumsum(change)[:n] > 0


def _run_rows(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, found = [], []
        for i, text in enumerate(batch.column(2).cast(pa.binary())):
            own = runs(numbered((text.as_py() or b"").split()), min_length)
            at += [i] * len(own)
            found += own
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows),
             *(pa.array([x[k] for x in found], pa.int64()) for k in range(3))], names=["doc_id", "row", "start", "length", "period"])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, row, start, length, period) of every run; ``row`` is xxhash64 of the text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        lambda it: _run_rows(it, min_length), f"doc_id {id_type}, row bigint, start bigint, length bigint, period bigint")


def _collapse(batches: Iterator[pa.RecordBatch], text_at: int, min_length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text in batch.column(text_at).cast(pa.binary()):
            text = text.as_py()
            words = (text or b"").split()
            found = runs(numbered(words), min_length)
            if found:
                gone = repeats(len(words), found).tolist()
                text = b" ".join([w for w, x in zip(words, gone) if not x])
            texts.append(text)
        columns = batch.columns
        columns[text_at] = pa.array(texts, pa.binary()).cast(columns[text_at].type)
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def collapse(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs``; texts with runs keep of each run its first period only and are joined by
    single spaces, others stay as they are."""
    at = docs.columns.index("text")
    return docs.mapInArrow(lambda it: _collapse(it, at, min_length), docs.schema)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


DIGEST = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, doc_id as text, text) -> the digest columns."""
    names = ["doc_id", *(c.split()[0] for c in DIGEST.split(", "))]
    for batch in batches:
        out = []
        for doc, text in zip(batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            words = (text.as_py() or b"").split()
            source = planted(len(words), zlib.crc32((doc or "").encode()))
            ids = numbered(words)
            if source is not None:
                ids = ids[source]
                words = [words[k] for k in source.tolist()]
            found = runs(ids, min_length)
            best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
            if found:
                gone = repeats(len(words), found).tolist()
                words = [w for w, x in zip(words, gone) if not x]
            listed = "".join(f"{a},{size},{q}\n" for a, size, q in found)
            out.append((len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                        _sha(listed.encode()), _sha(b" ".join(words))))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds))], names=names)


def digest(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Runs of every row of ``docs``, of which a tenth are made periodic (``planted``)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("doc_id").cast("string").alias("doc"), "text").mapInArrow(
        lambda it: _digests(it, min_length), f"doc_id {id_type}, {DIGEST}")
