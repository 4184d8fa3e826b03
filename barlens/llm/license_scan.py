"""License scans by exact set-similarity join (operator 4).

Text blocks are compared with license templates by containment: the share of the
template's distinct words that the block holds. A template's blocks are all windows of
the text that are as wide as the template and a quarter more, line breaks being
plain separators. The join is exact and looks at few of them:

* tokens are ordered by their frequency in the whole corpus, rarest first;
* prefix filter: a block that holds ``need`` of a template's n tokens holds one of
  the template's n - need + 1 rarest, so only blocks around such a word are looked at;
* length filter: a text with fewer than ``need`` of the template's words can't qualify;
* positional filter: where the rarest word that a block shares stands at place p of the
  template, n - p tokens can agree at most; if that is less than ``need`` it is skipped.

Licenses that differ in a word are told apart by it: a template names words that its block
must hold, and words that it must not. Of blocks that overlap, one that holds less of its
template than another gives way. Each block found is returned with its place.
Beside the join, the base phrases of the contract are counted word by word.

Defined cases: a null text is empty, an empty text has no words and no labels;
copies and repeated rows get the same answer row by row; very long texts are
scanned around the places of template words; an empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Least share of a template's words in a block.
CONTAINMENT = 0.8

# Fixed values of the contract: phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Template(NamedTuple):
    label: str
    text: str
    must: tuple[str, ...] = ()
    never: tuple[str, ...] = ()


# Opening sentences of well-known licenses, and the words that decide between them.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache", "2")),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("attribution",), ("noncommercial", "sharealike", "noderivatives", "noderivs")),
    Template("cc-by-4.0", "Licensed under CC BY 4.0", ("cc", "by"), ("nc", "sa", "nd")),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc", "by", "nc"), ("sa", "nd")),
    Template("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("attribution", "noncommercial"), ("sharealike", "noderivatives", "noderivs")),
    Template("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             ("attribution", "sharealike"), ("noncommercial", "noderivatives", "noderivs")),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", ("gnu", "general", "2"),
             ("lesser", "library", "affero")),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", ("gnu", "general", "3"),
             ("lesser", "library", "affero")),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation", ("general",), ("lesser", "library", "affero")),
    Template("mit", "Released under the MIT License", ("mit", "license")),
    Template("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files", ("permission", "granted")),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
             "that the following conditions are met", ("redistribution", "binary")),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla", "2")),
)


def words_of(text: bytes) -> list:
    return WORD.findall(text.lower())


def need_of(n: int, containment: float) -> int:
    """Words of a template of n that a block must hold."""
    return max(1, next(k for k in range(n + 1) if k >= containment * n - 1e-9))


def width_of(words: int) -> int:
    """Words of a block of a template with so many words."""
    return words + max(1, words // 4)


class Block(NamedTuple):
    """A block found: ``held`` of the template's ``size`` tokens, from word ``start`` on."""
    label: str
    held: int
    size: int
    start: int
    length: int

    def share(self) -> float:
        return self.held / self.size

    def rank(self) -> tuple:
        """Orders blocks by what they hold of their template, then by what surrounds it less."""
        return -self.held / self.size, -self.size, self.length, self.start

    def overlaps(self, other: Block) -> bool:
        return self.start < other.start + other.length and other.start < self.start + self.length


class Index:
    """Prefix index of the templates under a global token order."""

    def __init__(self, templates, rank: dict[bytes, tuple], containment: float):
        self.items = []
        self.prefix: dict[bytes, list] = {}
        for t in templates:
            words = words_of(t.text.encode())
            tokens = sorted(set(words), key=lambda w: rank.get(w, (0, w)))
            if not tokens:
                continue
            need = need_of(len(tokens), containment)
            place = {w: i for i, w in enumerate(tokens)}
            must, never = (frozenset(w.encode() for w in x) for x in (t.must, t.never))
            k = len(self.items)
            self.items.append((t.label, place, need, width_of(len(words)), must, never))
            for w in tokens[:len(tokens) - need + 1]:
                self.prefix.setdefault(w, []).append(k)
        self.keys = self.prefix.keys()

    def blocks(self, words: list, present: set) -> list[Block]:
        """All blocks of all templates that reach the containment and hold the deciding words."""
        hits = self.keys & present
        found = []
        for k in sorted({k for w in hits for k in self.prefix[w]}):
            label, place, need, width, must, never = self.items[k]
            if len(place.keys() & present) < need or not must <= present:
                continue
            at = [i for i, w in enumerate(words) if w in place]
            found += self._slide(words, at, k)
        return found

    def _slide(self, words: list, at: list[int], k: int) -> Iterator[Block]:
        """Blocks of template ``k`` that begin and end with one of its words; ``at``: where they stand."""
        label, place, need, width, must, never = self.items[k]
        spare = len(place) - need
        counts: dict[bytes, int] = {}
        head = 0
        for tail, i in enumerate(at):
            counts[words[i]] = counts.get(words[i], 0) + 1
            while at[head] <= i - width:
                w = words[at[head]]
                counts[w] -= 1
                if not counts[w]:
                    del counts[w]
                head += 1
            # the rarest shared word is one of the prefix, and leaves room for the rest
            if len(counts) < need or min(map(place.__getitem__, counts)) > spare:
                continue
            start = at[head]
            block = words[start:i + 1]
            if must.issubset(block) and never.isdisjoint(words[max(0, i + 1 - width):start + width]):
                yield Block(label, len(counts), len(place), start, i + 1 - start)


def _unbeaten(blocks: list[Block], beats) -> list[Block]:
    """Those that no overlapping block beats; only neighbours can overlap."""
    blocks = sorted(set(blocks), key=lambda b: b.start)
    longest = max((b.length for b in blocks), default=0)
    out, first = [], 0
    for b in blocks:
        while blocks[first].start + longest <= b.start:
            first += 1
        near = itertools.takewhile(lambda o: o.start < b.start + b.length, itertools.islice(blocks, first, None))
        if not any(o.overlaps(b) and beats(o, b) for o in near):
            out.append(b)
    return out


def standing(found: list[Block]) -> list[Block]:
    """The best block of each label and stretch, unless one of another label that overlaps it
    holds more of its template, or as much of a longer one."""
    best = _unbeaten(found, lambda o, b: o.label == b.label and o.rank() < b.rank())
    return _unbeaten(best, lambda o, b: o.label != b.label and o.rank()[:2] < b.rank()[:2])


def vocabulary(templates) -> list[bytes]:
    return sorted({w for t in templates for w in words_of(t.text.encode())})


def token_order(docs: DataFrame, templates) -> dict[bytes, tuple]:
    """Frequency rank of every template word, counted over all texts. One row per
    word of the templates comes back, whatever the corpus."""
    wanted = vocabulary(templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = set(wanted)
        tally = dict.fromkeys(wanted, 0)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                for word in known.intersection(words_of(text.as_py() or b"")):
                    tally[word] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(tally), pa.binary()), pa.array(tally.values(), pa.int64())],
                                         names=["word", "n"])

    rows = (docs.select("text").mapInArrow(count, "word binary, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    found = {bytes(r["word"]): r["n"] for r in rows}
    return {w: (found.get(w, 0), w) for w in wanted}


def places(words: list, phrase: list) -> list[int]:
    """Starts of all places where the phrase's words stand consecutively."""
    out, at, n = [], -1, len(phrase)
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return out
        if words[at:at + n] == phrase:
            out.append(at)


def scan(docs: DataFrame, templates=TEMPLATES, phrases: dict[str, str] | None = None,
         containment: float = CONTAINMENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, blocks (label, containment, start and length in words of
    every block of the join).

    ``templates``: ``Template``s; their labels must not be those of phrases.
    score: the best containment; 1 where a base phrase stands; else 0.
    """
    phrases = PHRASES if phrases is None else phrases
    if clash := {t.label for t in templates} & set(phrases.values()):
        raise ValueError(f"labels of phrases can't be labels of templates: {sorted(clash)}")
    index = Index(templates, token_order(docs, templates), containment)
    wanted = [(words_of(p.encode()), label) for p, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).cast(pa.binary()):
                words = words_of(text.as_py() or b"")
                # a cheap look at the whole text first: no prefix word, no template
                present = set(words)
                starts, base = [], set()
                for phrase, label in wanted:
                    if present.issuperset(phrase) and (at := places(words, phrase)):
                        starts += at
                        base.add(label)
                found = [] if index.keys.isdisjoint(present) else standing(index.blocks(words, present))
                rows.append((len(words), len(starts), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted(base)), ",".join(sorted(base | {b.label for b in found})),
                             1.0 if base else max((b.share() for b in found), default=0.0),
                             [{"label": b.label, "containment": b.share(), "start": b.start, "length": b.length} for b in found]))
            columns = list(zip(*rows)) if rows else [()] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), BLOCK_TYPE]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels "
             "string, score double, blocks array<struct<label:string,containment:double,start:bigint,length:bigint>>")


BLOCK_TYPE = pa.list_(pa.struct([("label", pa.string()), ("containment", pa.float64()), ("start", pa.int64()), ("length", pa.int64())]))


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs).drop("blocks")
