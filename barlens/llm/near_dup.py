"""MinHash near-dedup with sequential Bayesian verification (operator 7).

1. One pass over the texts gives every document its shingle count, a digest of
   its word sequence and a MinHash signature. Equal sequences are one class;
   everything below works on classes, named by a 64-bit hash of the digest.
2. Classes that agree on all rows of a band are candidates. A band's bucket is
   not expanded into pairs: its members have one random member, the hub, for company.
   Of the up to ``bands`` hubs of a class only the least is compared at first, which
   connects most of a large group. Then only hubs in another component count: first one
   pair for any two components, and what is still apart after that.
3. Candidate signatures are compared batch by batch. After n compared rows with
   m agreeing, the posterior of the similarity under a uniform prior is
   Beta(m + 1, n - m + 1); a pair is dropped once the probability that its
   similarity reaches the threshold falls below ``miss``. Before that go the pairs whose odd sketches
   (one bit for the shingles of a slot, flipped by each) differ in more bits than linked sets differ in
   shingles: these can't be linked.
4. Survivors are verified on their full shingle sets, in integers.
5. Members of a bucket that hubs left in different components may still be linked.
   Of these pairs, those that a prefix, length and position filter on the full
   sets (rarest shingle first) can't rule out go through steps 3 and 4 as well.
   The filter is exact, so nothing is lost by it. The larger set of a pair looks with
   the n - 0.75 n + 1 rarest of its n shingles, the smaller one is found by the
   n - 0.857 n + 1 rarest of its own: 2 t / (1 + t) of the smaller set must be shared. So the
   shingles that a crowd of texts has in common, but that are less than that part of
   each, are found by no one, and shingles that no one is found by are left out
   before the join. Of a crowd of copies with edits of their own, which meet in the original's
   shingles, the odd sketches leave the pairs close to the threshold, inside the join.
6. Verified links give connected components; the least doc_id represents each.

With bands of ``band_rows`` rows a pair at the threshold t shares no band with
probability (1 - t**band_rows) ** bands: 5e-6 at 0.75 with 32 bands of 4.

Defined cases: null or blank texts are empty, linked with nothing and kept;
rows that repeat a doc_id are the same document; a null id never represents a
component that has another id; an empty table gives an empty table. Removal
(``deduplicate``) goes by id and text: an id on several texts, or none, loses only
the rows that another one represents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlens.llm import common as C
from barlens.llm.components import connected_components
from barlens.llm.shingles import ODD_WORDS, overlap, set_batches, sign_batches
from barlens.sinks import materialize

WIDTH = 5
#: Similarity threshold as a fraction of integers.
THRESHOLD = (75, 100)
BANDS, BAND_ROWS = 32, 4
#: Signature rows compared at a time.
STEP = 16
#: A pair is dropped when its similarity reaches the threshold with less than this probability.
MISS = 1e-5


def upper_tail(m: int, n: int, t: float) -> float:
    """P(similarity >= t | m of n rows agree), uniform prior: the regularised
    incomplete beta function in its binomial form."""
    return sum(comb(n + 1, k) * t ** k * (1 - t) ** (n + 1 - k) for k in range(m + 1))


def least_agreement(n: int, t: float, miss: float) -> int:
    """Smallest number of agreeing rows of n that does not drop a pair."""
    return next(m for m in range(n + 1) if upper_tail(m, n, t) >= miss)


def _survive(batches: Iterator[pa.RecordBatch], rows: int, step: int, threshold: tuple,
             miss: float) -> Iterator[pa.RecordBatch]:
    """(a, b, sig_a, sig_b, n_a, n_b, odd_a, odd_b) -> (a, b) of the pairs that neither the odd sketches nor a
    batch of rows drops."""
    num, den = threshold
    need = {n: least_agreement(n, num / den, miss) for n in range(step, rows + 1, step)}
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, rows) for i in (2, 3))
        # numpy counts the bits of absolute values
        odd_a, odd_b = (batch.column(i).flatten().to_numpy().view(np.uint64).reshape(batch.num_rows, -1) for i in (6, 7))
        sizes = batch.column(4).to_numpy() + batch.column(5).to_numpy()
        alive = np.flatnonzero((den + num) * np.bitwise_count(odd_a ^ odd_b).sum(axis=1, dtype=np.int64) <= (den - num) * sizes)
        agree = np.zeros(len(alive), np.int64)
        for n in range(step, rows + 1, step):
            agree += (x[alive, n - step:n] == y[alive, n - step:n]).sum(axis=1)
            stay = agree >= need[n]
            alive, agree = alive[stay], agree[stay]
        yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(alive)) for i in (0, 1)], names=["a", "b"])


def _confirm(batches: Iterator[pa.RecordBatch], threshold: tuple) -> Iterator[pa.RecordBatch]:
    """(a, b, set_a, set_b) -> (a, b) of the pairs at or above the threshold."""
    num, den = threshold
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            x, y = x.as_py(), y.as_py()
            both = overlap(x, y)
            if den * both >= num * (len(x) // 8 + len(y) // 8 - both):
                keep.append(i)
        yield pa.RecordBatch.from_arrays(
            [batch.column(i).take(pa.array(keep, pa.int64())) for i in (0, 1)], names=["a", "b"])


def _explode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, n, comp, packed set) -> one row per shingle, a few sets at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [np.frombuffer(x.as_py(), np.int64) for x in part.column(3)]
            rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i).take(pa.array(rows)) for i in range(3)),
                 pa.array(np.concatenate(sets), pa.int64())], names=["cid", "n", "comp", "shingle"])


def _classes_of(components: DataFrame) -> DataFrame:
    return materialize(components.select(F.col("node").alias("cid"), F.col("component").alias("comp")), "dup-comps")


class NearDup:
    """The stages of the operator over one table of (doc_id, text)."""

    def __init__(self, docs: DataFrame, width: int = WIDTH, threshold: tuple = THRESHOLD, bands: int = BANDS,
                 band_rows: int = BAND_ROWS, step: int = STEP, miss: float = MISS):
        self.docs = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
        self.width, self.threshold, self.bands, self.band_rows = width, threshold, bands, band_rows
        self.step, self.miss = step, miss
        self.rows = bands * band_rows
        id_type = self.docs.schema["doc_id"].dataType.simpleString()
        width, rows = self.width, self.rows
        self.signed = materialize(self.docs.mapInArrow(
            lambda it: sign_batches(it, width, rows),
            f"doc_id {id_type}, text_hash bigint, n_shingles bigint, key binary, sig binary, odd array<bigint>"), "dup-signed")
        worded = self.signed.filter(F.col("key").isNotNull())
        # equal sequences have equal signatures: any row of the class will do
        self.classes = materialize(worded.groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("odd").alias("odd"))
            .withColumn("cid", F.xxhash64("key")), "dup-classes")

    def _members(self) -> DataFrame:
        """(bucket, cid, n, hub, hub_n) of every class in every band it shares with another class."""
        w = 4 * self.band_rows
        band = F.explode(F.sequence(F.lit(0), F.lit(self.bands - 1))).alias("band")
        # which member is the hub: the least id under a mask of the bucket's own
        mask = F.xxhash64("bucket", F.lit("hub"))
        placed = (self.classes.select("cid", "n", "sig", band)
                  .select(F.xxhash64(F.expr(f"substring(sig, band * {w} + 1, {w})"), "band").alias("bucket"), "cid", "n")
                  .withColumn("masked", F.col("cid").bitwiseXOR(mask)))
        shared = (placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("masked", "n")).alias("least"))
                  .filter("c > 1").select("bucket", F.col("least.masked").bitwiseXOR(mask).alias("hub"),
                                          F.col("least.n").alias("hub_n")))
        return materialize(placed.drop("masked").join(shared, "bucket"), "dup-members")

    def _sets(self, members: DataFrame) -> DataFrame:
        """(cid, shingles) of every class that has candidates; each text is read once."""
        ids = members.select("cid").distinct()
        wanted = self.classes.join(ids, "cid", "left_semi").select("least_id").distinct()
        texts = self.docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("least_id")), "left_semi").select("text")
        width = self.width
        sets = (texts.mapInArrow(lambda it: set_batches(it, width), "key binary, shingles binary")
                .select(F.xxhash64("key").alias("cid"), "shingles").join(ids, "cid", "left_semi"))
        return materialize(sets.groupBy("cid").agg(F.first("shingles").alias("shingles")), "dup-sets")

    def _links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Verified links among candidate pairs (a, b)."""
        side = {s: self.classes.select(F.col("cid").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("sig", "n", "odd")])
                for s in "ab"}
        sides = (pairs.join(side["a"], "a").join(side["b"], "b")
                 .select("a", "b", "sig_a", "sig_b", "n_a", "n_b", "odd_a", "odd_b"))
        rows, step, miss, threshold = self.rows, self.step, self.miss, self.threshold
        alive = sides.mapInArrow(lambda it: _survive(it, rows, step, threshold, miss), "a bigint, b bigint")
        full = (alive.join(sets.withColumnsRenamed({"cid": "a", "shingles": "set_a"}), "a")
                .join(sets.withColumnsRenamed({"cid": "b", "shingles": "set_b"}), "b")
                .select("a", "b", "set_a", "set_b"))
        return materialize(full.mapInArrow(lambda it: _confirm(it, threshold), "a bigint, b bigint"), "dup-links")

    def _near(self, a: str, b: str):
        """Sizes alone allow the threshold: 100 * smaller >= 75 * larger."""
        num, den = self.threshold
        return F.lit(den) * F.least(a, b) >= F.lit(num) * F.greatest(a, b)

    def _prefix_sides(self, members: DataFrame, comps: DataFrame, sets: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        """(seekers, holders), to be joined on ``shingle``: prefix entries of classes that share a
        bucket's company with another component."""
        num, den = self.threshold
        placed = members.join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        split = (placed.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
                 .filter("c0 <> c1").select("bucket"))
        open_ = placed.join(split, "bucket", "left_semi").select("cid", "n", "comp").distinct()
        open_ = materialize(open_, "dup-open")
        tokens = (sets.join(open_, "cid").select("cid", "n", "comp", "shingles")
                  .mapInArrow(_explode_sets, "cid bigint, n bigint, comp bigint, shingle bigint"))
        tokens = materialize(tokens, "dup-tokens")
        df = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
        # a set's shingles, rarest first; those that stand nowhere else come before all others
        order = Window.partitionBy("cid").orderBy("df", "shingle")
        shared = tokens.join(df, "shingle")
        alone = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("cid"))
        entries = (shared.withColumn("p", alone + F.row_number().over(order) - 1)
                   .filter(F.lit(den) * (F.col("n") - F.col("p")) >= F.lit(num) * F.col("n"))
                   .withColumn("holds", F.lit(den + num) * (F.col("n") - F.col("p")) >= F.lit(2 * num) * F.col("n"))
                   .select("shingle", "cid", "n", "comp", "p", "holds"))
        entries = materialize(entries, "dup-prefixes")
        # the most frequent component of a shingle is home: no two of home meet
        home = (entries.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("c"), F.max("holds").alias("h"))
                .groupBy("shingle").agg(F.max(F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("k"), F.max("h").alias("h"))
                .filter("k > 1 and h").select("shingle", F.col("top.comp").alias("home")))
        met = materialize(entries.join(home, "shingle").join(self.classes.select("cid", "odd"), "cid"), "dup-met")
        held = met.filter("holds").select("shingle", *[F.col(c).alias(f"{c}_h") for c in ("cid", "n", "comp", "p", "home", "odd")])
        return [(met, held.filter("comp_h <> home_h")), (met.filter("comp <> home"), held.filter("comp_h = home_h"))]

    def _cross_pairs(self, members: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs (a, b) in different components (ca, cb) that share a bucket's company and that
        the filters on their full sets leave open."""
        num, den = self.threshold
        room = F.lit(den + num) * F.least(F.col("n") - F.col("p"), F.col("n_h") - F.col("p_h")) \
            >= F.lit(num) * (F.col("n") + F.col("n_h"))
        # bits in which the odd sketches differ: no more than shingles that only one set has
        apart = reduce(Column.__add__, [F.bit_count(F.get("odd", F.lit(i)).bitwiseXOR(F.get("odd_h", F.lit(i)))) for i in range(ODD_WORDS)])
        close = F.lit(den + num) * apart <= F.lit(den - num) * (F.col("n") + F.col("n_h"))
        pairs = [seek.join(hold, "shingle").filter("n >= n_h and comp <> comp_h").filter(self._near("n", "n_h") & room & close)
                 .select(F.least("cid", "cid_h").alias("a"), F.greatest("cid", "cid_h").alias("b"),
                         F.least("comp", "comp_h").alias("ca"), F.greatest("comp", "comp_h").alias("cb"))
                 for seek, hold in self._prefix_sides(members, comps, sets)]
        return pairs[0].union(pairs[1]).distinct()

    def _hub_components(self, members: DataFrame, sets: DataFrame) -> DataFrame:
        """(cid, comp) of the classes that links with their buckets' hubs connect."""
        stars = members.filter("hub <> cid").filter(self._near("n", "hub_n"))
        first = stars.groupBy("cid").agg(F.min("hub").alias("hub")) \
            .select(F.least("hub", "cid").alias("a"), F.greatest("hub", "cid").alias("b")).distinct()
        first = materialize(first, "dup-first")
        comps = _classes_of(connected_components(self._links(first, sets)))
        # buckets whose members are not all in the hub's component
        placed = members.join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        split = (placed.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                              F.max(F.when(F.col("cid") == F.col("hub"), F.col("comp"))).alias("hub_comp"))
                 .filter("c0 <> c1").select("bucket", "hub_comp"))
        left = (placed.filter(self._near("n", "hub_n")).join(split, "bucket").filter("comp <> hub_comp")
                .select(F.least("hub", "cid").alias("a"), F.greatest("hub", "cid").alias("b"),
                        F.least("comp", "hub_comp").alias("ca"), F.greatest("comp", "hub_comp").alias("cb")).distinct()
                .join(first, ["a", "b"], "left_anti"))
        left = materialize(left, "dup-left")
        one = materialize(left.groupBy("ca", "cb").agg(F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b", "ca", "cb"), "dup-one")
        comps, joined = self._merge(comps, one, sets)
        left = left.join(one.select("a", "b"), ["a", "b"], "left_anti")
        for c in ("ca", "cb"):
            left = (left.join(joined.withColumnsRenamed({"node": c, "component": "to"}), c, "left")
                    .withColumn(c, F.coalesce("to", c)).drop("to"))
        return self._merge(comps, materialize(left.filter("ca <> cb"), "dup-left"), sets)[0]

    def _merge(self, comps: DataFrame, pairs: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Verify candidate pairs (a, b) of components (ca, cb): the components joined by the links
        among them, and which went where (node, component)."""
        links = self._links(pairs.select("a", "b"), sets)
        joined = materialize(connected_components(pairs.join(links, ["a", "b"], "left_semi").select("ca", "cb")), "dup-joined")
        moved = (comps.join(joined.withColumnRenamed("node", "comp"), "comp", "left")
                 .select("cid", F.coalesce("component", "comp").alias("comp")))
        # components of one class have no row yet
        single = joined.join(comps.select(F.col("cid").alias("node")), "node", "left_anti") \
            .select(F.col("node").alias("cid"), F.col("component").alias("comp"))
        return materialize(moved.union(single), "dup-comps"), joined

    def components(self) -> DataFrame:
        """(cid, comp) of every class that is linked with another one."""
        members = self._members()
        sets = self._sets(members)
        comps = self._hub_components(members, sets)
        late = materialize(self._cross_pairs(members, comps, sets), "dup-late")
        return comps if late.isEmpty() else self._merge(comps, late, sets)[0]

    def digest(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept of every row."""
        comps = self.components()
        classes = self.classes.select("key", "cid", "least_id", "copies").join(comps, "cid", "left")
        linked = classes.filter("comp is not null")
        heads = linked.groupBy("comp").agg(F.min("least_id").alias("head"))
        # only classes with copies or links differ from their own id
        labels = (classes.join(heads, "comp", "left").filter("copies > 1 or comp is not null")
                  .select("key", F.coalesce("head", "least_id").alias("head")))
        return (self.signed.select("doc_id", "n_shingles", "key").join(labels, "key", "left")
                .select("doc_id", "n_shingles", F.coalesce("head", "doc_id").alias("component_id"))
                .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    return NearDup(docs, **params).digest()


def deduplicate(docs: DataFrame, **params) -> DataFrame:
    """``docs`` without the rows that another one represents, decided by id and text: one
    document of each group stays. Rows equal in both are one document, but without an
    id nothing says so, and one of them stays. The texts are dealt by id and digest once, at any
    size: who goes may be a third of all rows."""
    name, digest = C.fresh(docs, "gone"), C.fresh(docs, "gone_text")
    dup = NearDup(docs, **params)
    comps = dup.components()
    classes = dup.classes.select("key", "copies", "cid").join(comps, "cid", "left").filter("copies > 1 or comp is not null")
    # the members of every group, rows of one id and text counted as one
    members = materialize(
        dup.signed.join(classes.select("key", F.coalesce("comp", "cid").alias("grp")), "key")
        .groupBy("grp", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("c")), "dup-group-members")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    heads = members.groupBy(F.col("grp").alias("__grp")).agg(F.min(place).alias("head"))
    judged = members.join(heads, F.col("grp") == F.col("__grp")).withColumn("first", place.eqNullSafe(F.col("head")))
    # a head of several rows without id: all go, and one of them comes back
    single = F.col("first") & (F.col("doc_id").isNotNull() | (F.col("c") == 1))
    judged = materialize(judged.select(F.col("doc_id").alias(name), F.col("text_hash").alias(digest), "first",
                                       single.alias("stays")).filter("not stays"), "dup-gone")
    text = F.xxhash64("text")
    out = docs.join(judged.select(name, digest).hint("merge"), F.col("doc_id").eqNullSafe(F.col(name)) & (text == F.col(digest)), "left_anti")
    back = judged.filter("first").select(digest)
    if back.isEmpty():
        return out
    one = (docs.filter(F.col("doc_id").isNull()).join(back, text == F.col(digest))
           .dropDuplicates([digest]).drop(digest))
    return out.unionByName(one)
