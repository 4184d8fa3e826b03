"""Corpus-wide line dedup (operator 12): range-partitioned line hashes, first
occurrences streamed, compressed bitmaps of kept lines per document.

1. Every line gives a key (ASCII white space stripped at both ends, A-Z lower-cased)
   and, if the key has ``min_length`` code points, one narrow row: 128-bit hash of the
   key, document, position. Texts are left behind.
2. The rows are dealt by ranges of (hash, document descending, row, position) and
   sorted in that order within each range, so the first document of a hash is the
   one that keeps the line. A very common line is simply spread over several ranges.
3. Each range is streamed once in constant memory. Rows of the second and later documents
   of a hash that has ``min_documents`` are dropped. Only the first and the last
   hash of a range can go on in a neighbouring one: their rows stay open, with at most
   ``min_documents`` documents of either reported, and are decided by the union of the
   reports, which has a few rows per range.
4. Dropped positions are gathered per document to a bitmap, which is joined to the
   texts.

Defined cases: a null or empty text is one empty line, nothing of it is dropped; a
null id is one document, the least; rows that repeat an id are one document, each
row with its own bitmap; equal rows get equal bitmaps; an empty table gives an
empty table; other columns pass through whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlens.llm import common as C
from barlens.sinks import materialize

MIN_LENGTH = 20
MIN_DOCUMENTS = 3

#: What a streamed row is: a dropped line, a line of an open hash, a document of an open hash.
DROPPED, OPEN, SEEN = 0, 1, 2


def key_of(line: bytes) -> bytes:
    """``bytes.strip`` and ``bytes.lower`` know ASCII only, as the key does."""
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least:
        return False
    return len(key) >= 4 * least or key.isascii() or len(key.decode("utf-8", "replace")) >= least


def _line_rows(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, row, text) -> (doc_id, row, pos, h1, h2) of every line with a key."""
    for batch in batches:
        at, pos, digests = [], [], []
        for i, text in enumerate(batch.column(2).cast(pa.binary())):
            for k, line in enumerate((text.as_py() or b"").split(b"\n")):
                key = key_of(line)
                if _long_enough(key, min_length):
                    at.append(i)
                    pos.append(k)
                    digests.append(xxhash.xxh3_128_digest(key))
        h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        rows = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(pos, pa.int32()),
             pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1]))],
            names=["doc_id", "row", "pos", "h1", "h2"])


def _changes(column: pa.Array, before: pa.Scalar | None) -> np.ndarray:
    """Whether each value differs from the one before it (null equals null)."""
    first = pa.array([None if before is None else before.as_py()], column.type)
    shifted = pa.concat_arrays([first, column.slice(0, len(column) - 1)])
    both_null = pc.and_(pc.is_null(column), pc.is_null(shifted))
    differ = pc.fill_null(pc.not_equal(column, shifted), True)
    out = pc.and_not(differ, both_null).to_numpy(zero_copy_only=False).copy()
    if before is None:
        out[0] = True
    return out


class _Stream:
    """State of the open hash while one sorted range goes by."""

    def __init__(self, min_documents: int):
        self.least = min_documents
        self.last = None        # (h1, h2, doc_id) of the row before
        self.rank = 0           # documents of the hash before that row's
        self.first_run = True   # the hash of the range's first row
        self.heads: list[pa.RecordBatch] = []    # its first documents
        self.held: list[pa.RecordBatch] = []     # lines that go if more documents follow

    def _tag(self, rows: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, kind, np.int8)), *rows.columns],
                                          names=["kind", *rows.schema.names])

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """``batch``: (doc_id, row, pos, h1, h2), sorted."""
        doc, h1, h2 = batch.column(0), batch.column(3), batch.column(4)
        a, b, d = self.last or (None, None, None)
        new_hash = _changes(h1, a) | _changes(h2, b)
        new_doc = new_hash | _changes(doc, d)
        run = np.cumsum(new_hash)                        # 0: the hash carried over
        steps = np.cumsum(new_doc & ~new_hash)
        starts = np.flatnonzero(new_hash)
        base = np.concatenate([[-self.rank], steps[starts]])
        rank = steps - base[run]
        ends = np.append(starts - 1, len(run) - 1)       # last row of each run, -1 if none here
        top = np.where(ends >= 0, rank[ends], self.rank)[run]
        final = run[-1]
        first = np.zeros(len(run), bool)
        if self.first_run:
            first = run == (0 if self.last is not None else 1)
        enough = self.least - 1
        # the hash carried over: what was held is decided now, or stays held
        if self.last is not None and not self.first_run:
            if len(run) and run[0] == 0 and top[0] >= enough:
                for rows in self.held:
                    yield self._tag(rows, DROPPED)
                self.held = []
            elif final > 0:
                self.held = []
        drop = (rank >= 1) & (top >= enough) & ~first
        if drop.any():
            yield self._tag(batch.filter(pa.array(drop)), DROPPED)
        if first.any():
            yield self._tag(batch.filter(pa.array(first)), OPEN)
        heads = new_doc & (rank < self.least)
        mine = heads & first
        if mine.any():
            yield self._tag(batch.filter(pa.array(mine)), SEEN)
        if final > 0:
            self.heads = []
        if self.first_run and not first[-1]:
            self.first_run = False
        if not self.first_run:
            last = run == final
            if (heads & last).any():
                self.heads.append(batch.filter(pa.array(heads & last)))
            hold = last & (rank >= 1) & (top < enough)
            if hold.any():
                self.held.append(batch.filter(pa.array(hold)))
        self.last, self.rank = (h1[-1], h2[-1], doc[-1]), int(rank[-1])

    def close(self) -> Iterator[pa.RecordBatch]:
        for rows in self.held:
            yield self._tag(rows, OPEN)
        for rows in self.heads:
            yield self._tag(rows, SEEN)


def _first_occurrences(batches: Iterator[pa.RecordBatch], min_documents: int) -> Iterator[pa.RecordBatch]:
    state = _Stream(min_documents)
    for batch in batches:
        if batch.num_rows:
            yield from state.feed(batch)
    yield from state.close()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, row, positions) -> (doc_id, row, n_dropped, keep)."""
    for batch in batches:
        n, keep = [], []
        for positions in batch.column(2):
            at = positions.values.to_numpy()
            bits = np.ones(-(-(int(at.max()) + 1) // 8) * 8, np.uint8)
            bits[at] = 0
            n.append(len(at))
            keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 6))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keep, pa.binary())],
                                         names=["doc_id", "row", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, row, n_dropped, keep) of every row that loses a line; ``row`` is xxhash64
    of the text and tells rows of one id apart. ``keep`` is a zlib-compressed bitmap, lowest
    bit first: line i stays where bit i is set; lines beyond its end stay as well."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    lines = materialize(narrow.mapInArrow(lambda it: _line_rows(it, min_length),
                                          f"doc_id {id_type}, row bigint, pos int, h1 bigint, h2 bigint"), "line-hashes")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("row"), F.col("pos")]
    streamed = materialize(
        lines.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(lambda it: _first_occurrences(it, min_documents),
                    f"kind tinyint, doc_id {id_type}, row bigint, pos int, h1 bigint, h2 bigint"), "line-drops")
    # at most two open hashes and 2 * min_documents rows a range
    seen = (streamed.filter(F.col("kind") == SEEN).groupBy("h1", "h2")
            .agg(F.max("doc_id").alias("top"), F.count_distinct(F.struct("doc_id")).alias("n"))
            .filter(F.col("n") >= min_documents).drop("n"))
    late = (streamed.filter(F.col("kind") == OPEN).join(F.broadcast(seen), ["h1", "h2"])
            .filter(~F.col("doc_id").eqNullSafe(F.col("top"))))
    gone = streamed.filter(F.col("kind") == DROPPED).select("doc_id", "row", "pos").union(late.select("doc_id", "row", "pos"))
    return (gone.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("positions"))
            .mapInArrow(_pack, f"doc_id {id_type}, row bigint, n_dropped bigint, keep binary"))


def _kept(text: bytes, keep: bytes | None) -> tuple[list, list]:
    """(all lines, kept lines) of a text."""
    lines = text.split(b"\n")
    if keep is None:
        return lines, lines
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")[:len(lines)]
    return lines, [x for x, bit in zip(lines, bits.tolist()) if bit] + lines[len(bits):]


def _apply(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """Rows with their bitmap in the last column -> rows with kept lines only."""
    for batch in batches:
        column, keep = batch.column(text_at), batch.column(batch.num_columns - 1)
        texts = [None if t.as_py() is None else b"\n".join(_kept(t.as_py(), k.as_py())[1])
                 for t, k in zip(column.cast(pa.binary()), keep)]
        columns = batch.columns[:-1]
        columns[text_at] = pa.array(texts, pa.binary()).cast(column.type)
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, keep) -> (doc_id, n_lines, n_dropped, kept_sha256)."""
    for batch in batches:
        n, dropped, digest = [], [], []
        for text, keep in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
            lines, kept = _kept(text.as_py() or b"", keep.as_py())
            n.append(len(lines))
            dropped.append(len(lines) - len(kept))
            digest.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                                          pa.array(digest, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` and, as last column, the bitmap of each row."""
    d, r, k = (C.fresh(docs, x) for x in ("line_id", "line_row", "line_keep"))
    side = bitmaps.select(F.col("doc_id").alias(d), F.col("row").alias(r), F.col("keep").alias(k))
    return docs.join(side, F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(r)), "left").drop(d, r), k


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with repeated lines taken out of their texts; a null text stays null."""
    joined, _ = _with_bitmaps(docs, keep_bitmaps(docs, min_length, min_documents))
    at = docs.columns.index("text")
    return joined.mapInArrow(lambda it: _apply(it, at), docs.schema)


def digest(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    docs = docs.select("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    joined, _ = _with_bitmaps(docs, keep_bitmaps(docs, min_length, min_documents))
    return joined.mapInArrow(_digests, f"doc_id {id_type}, n_lines bigint, n_dropped bigint, kept_sha256 string")


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS MATERIALIZED (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, g.key IS NOT NULL AND doc_id <> top AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
