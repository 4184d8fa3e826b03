"""Word shingles of whole texts, their MinHash signatures and set digests.

Words are runs of anything but ASCII white space after lower-casing A-Z;
``bytes.lower`` and ``bytes.split`` do exactly that on UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from barlens.llm.common import WordHashes, mix64, word_hashes

#: Random odd multipliers that tell the positions inside a shingle apart. They must
#: not be small multiples of each other, or shingles with repeated words collide.
POSITION = np.random.default_rng(64).integers(0, 2 ** 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
#: Shingles hashed at once; bounds the work array of a very long text.
BLOCK = 4096
#: 64-bit words of an odd sketch.
ODD_WORDS = 16


def shingle_set(words: list, width: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; with fewer
    words the whole sequence counts as one; without words: empty."""
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words, memo)
    if len(h) < width:
        return mix64((h * POSITION[:len(h)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(h)))
    n = len(h) - width + 1
    s = np.full(n, np.uint64(width), np.uint64)
    for i in range(width):
        s += h[i:i + n] * POSITION[i]
    return np.unique(mix64(s))


class Signer:
    """MinHash signatures: ``rows`` multiply-add permutations, seeded."""

    def __init__(self, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2 ** 63, rows, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2 ** 63, rows, np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(shingles), BLOCK):
            x = shingles[at:at + BLOCK]
            work = np.multiply.outer(self.a, x)
            work += self.b[:, None]
            np.minimum(low, work.min(axis=1), out=low)
        return (low >> np.uint64(32)).astype("<u4")


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Bit i says whether an odd number of the shingles falls into slot i. A shingle that only one of two sets
    has flips one bit, so the sketches differ in as many bits as the sets in shingles, at most."""
    slots = 64 * ODD_WORDS
    odd = np.bincount((shingles % np.uint64(slots)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def words_of(text: bytes) -> list:
    return text.lower().split()


def text_key(words: list) -> bytes:
    """128-bit digest of a word sequence."""
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def sign_batches(batches: Iterator[pa.RecordBatch], width: int, rows: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, text_hash) -> (doc_id, text_hash, n_shingles, key, sig, odd); key, sig and odd are null
    where a text has no words."""
    memo, sign = WordHashes(), Signer(rows)
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
        n, keys, sigs, odds = [], [], [], []
        for text in texts:
            words = words_of(text.as_py() or b"")
            s = shingle_set(words, width, memo)
            n.append(len(s))
            keys.append(text_key(words) if words else None)
            sigs.append(sign(s).tobytes() if words else None)
            odds.append(odd_sketch(s) if words else None)
        yield pa.RecordBatch.from_arrays(
            [ids, batch.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()),
             pa.array(odds, pa.list_(pa.int64()))],
            names=["doc_id", "text_hash", "n_shingles", "key", "sig", "odd"])


def set_batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(text) -> (key, shingles): the full set as packed sorted 64-bit hashes."""
    memo = WordHashes()
    for batch in batches:
        keys, sets = [], []
        for text in batch.column(0).cast(pa.binary()):
            words = words_of(text.as_py() or b"")
            if words:
                keys.append(text_key(words))
                sets.append(shingle_set(words, width, memo).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())],
                                         names=["key", "shingles"])


def overlap(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    return len(np.intersect1d(x, y, assume_unique=True))
