"""Versioned tables (SNK-2, SNK-3, ST-2): immutable data folders behind a snapshot pointer.

A table is a folder with

    data/<folder>/_p=<part>/part-*.parquet     written once, never changed
    pointers/<version>.json                    which folders a version is made of

A write stages its rows in a new folder, lets the caller validate them and then
creates the next pointer file. Only the pointer makes rows part of the table, so a job
that dies before it leaves the table as it was; its folder is listed nowhere and
``vacuum`` removes it. The pointer is created exclusively: of two writers that start
from the same version one fails. A pointer file cut off in the middle does not
parse and does not count.

Each pointer names the loads its table holds. A load that is there already is not written
again, so a job may be replayed at any point. Ordered loads (a stream's batches)
are known by their last number, others by their ids.

A reader works on one version, whatever is written or compacted meanwhile. Paths may be
on any file system that Spark reaches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlens.session import STORED

PART = "_p"
WHOLE = "all"
BASE = ""      # the base's key among the weights


@dataclass(frozen=True)
class Snapshot:
    """One version: ``base`` holds for every part the folder that has its merged rows,
    ``deltas`` the folders written since, oldest first, with the parts of each."""
    version: int = 0
    schema: str | None = None
    base: dict[str, str] = field(default_factory=dict)
    deltas: tuple[tuple[str, tuple[str, ...]], ...] = ()
    loads: tuple[str, ...] = ()
    marks: dict[str, int] = field(default_factory=dict)
    #: loads that the base and folded delta folders are made of
    weights: dict[str, int] = field(default_factory=dict)

    def touched(self) -> set[str]:
        return {p for _, parts in self.deltas for p in parts}


class VersionedTable:
    """``part``: expression of the part a row belongs to (default: one part for all)."""

    def __init__(self, spark: SparkSession, path: str, part: Column | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.part = F.lit(WHOLE) if part is None else part
        self._jvm = spark.sparkContext._jvm
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- pointer files --------------------------------------------------------

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, path: str) -> list[str]:
        p = self._hadoop(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _pointer(self, version: int) -> str:
        return f"{self.path}/pointers/{version:012d}.json"

    def _parsed(self, version: int) -> Snapshot | None:
        stream = self._fs.open(self._hadoop(self._pointer(version)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            d = json.loads(text)
        except ValueError:
            return None
        return Snapshot(d["version"], d["schema"], d["base"], tuple((f, tuple(ps)) for f, ps in d["deltas"]),
                        tuple(d["loads"]), d["marks"], d.get("weights", {}))

    def _versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.path}/pointers") if n.endswith(".json")]

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The given or the latest version; an empty one of a table that isn't there."""
        for v in sorted(self._versions() if version is None else [version], reverse=True):
            found = self._parsed(v)
            if found is not None:
                return found
        return Snapshot()

    def _commit(self, snap: Snapshot) -> None:
        version = max(self._versions(), default=0) + 1
        latest = self.snapshot().version
        if latest != snap.version:
            raise RuntimeError(f"{self.path} went on to version {latest} while version {snap.version} was changed")
        body = json.dumps({"version": version, "schema": snap.schema, "base": snap.base, "deltas": snap.deltas,
                           "loads": snap.loads, "marks": snap.marks, "weights": snap.weights})
        stream = self._fs.create(self._hadoop(self._pointer(version)), False)    # fails if another one made it
        try:
            stream.write(body.encode())
        finally:
            stream.close()

    # --- data folders ---------------------------------------------------------

    def stage(self, df: DataFrame) -> str:
        """Write ``df`` to a folder of its own, which belongs to no version yet. Rows that carry their
        part already (and are sorted by it) are written as they come."""
        folder = uuid.uuid4().hex
        rows = df if PART in df.columns else df.withColumn(PART, self.part)
        rows.write.options(**STORED).partitionBy(PART).parquet(f"{self.path}/data/{folder}")
        return folder

    def _parts(self, folder: str) -> list[str]:
        return [n[len(PART) + 1:] for n in self._names(f"{self.path}/data/{folder}") if n.startswith(f"{PART}=")]

    def _read(self, snap: Snapshot, entries: Iterable[tuple[str, str]]) -> DataFrame:
        """Rows of (folder, part) entries; the files are the parts' own, nothing else is listed."""
        schema = T.StructType.fromJson(json.loads(snap.schema))
        paths = [f"{self.path}/data/{folder}/{PART}={part}" for folder, part in entries]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def folder(self, folder: str, snap: Snapshot | None = None) -> DataFrame:
        """The rows staged in a folder."""
        return self._read(snap or self.snapshot(), [(folder, p) for p in self._parts(folder)])

    def base(self, snap: Snapshot, parts: Callable[[str], bool] | None = None) -> DataFrame:
        return self._read(snap, [(f, p) for p, f in sorted(snap.base.items()) if parts is None or parts(p)])

    def deltas(self, snap: Snapshot, parts: Callable[[str], bool] | None = None) -> DataFrame:
        return self._read(snap, [(f, p) for f, ps in snap.deltas for p in ps if parts is None or parts(p)])

    # --- loads ----------------------------------------------------------------

    def holds(self, load_id: str | tuple[str, int], snap: Snapshot | None = None) -> bool:
        snap = snap or self.snapshot()
        if isinstance(load_id, tuple):
            return load_id[1] <= snap.marks.get(load_id[0], -1)
        return load_id in snap.loads

    def _load(self, df: DataFrame, load_id, validate, place: Callable[[Snapshot, str, list[str]], Snapshot]) -> bool:
        snap = self.snapshot()
        if self.holds(load_id, snap):
            return False
        snap = replace(snap, schema=snap.schema or df.drop(PART).schema.json())
        folder = self.stage(df.select(*T.StructType.fromJson(json.loads(snap.schema)).fieldNames(),
                                      *[c for c in df.columns if c == PART]))
        if validate is not None:
            validate(self.folder(folder, snap))
        new = place(snap, folder, self._parts(folder))
        if isinstance(load_id, tuple):
            new = replace(new, marks={**snap.marks, load_id[0]: load_id[1]})
        else:
            new = replace(new, loads=(*snap.loads, load_id))
        self._commit(new)
        return True

    def append(self, df: DataFrame, load_id: str | tuple[str, int],
               validate: Callable[[DataFrame], None] | None = None) -> bool:
        """Add rows under ``load_id`` (an id, or writer and number); False if it is there already.
        ``validate`` sees the staged rows and raises to keep them out."""
        return self._load(df, load_id, validate, lambda s, folder, parts: replace(
            s, deltas=(*s.deltas, (folder, tuple(parts)))))

    def replace(self, df: DataFrame, load_id: str | tuple[str, int],
                validate: Callable[[DataFrame], None] | None = None,
                parts: Callable[[str], bool] | None = None) -> bool:
        """Put ``df`` in the place of all rows, or of the rows of ``parts``, in one step."""
        def place(s: Snapshot, folder: str, written: list[str]) -> Snapshot:
            stays = (lambda p: False) if parts is None else (lambda p: not parts(p))
            strange = [p for p in written if stays(p)]
            if strange:
                raise ValueError(f"rows outside the replaced parts: {strange[:5]}")
            base = {p: f for p, f in s.base.items() if stays(p)} | {p: folder for p in written}
            return replace(s, base=base, deltas=tuple((f, kept) for f, ps in s.deltas if (kept := tuple(filter(stays, ps)))))
        return self._load(df, load_id, validate, place)

    def read(self, parts: Callable[[str], bool] | None = None, version: int | None = None) -> DataFrame:
        """All rows of a version, or of some parts of it: no other files are opened."""
        snap = self.snapshot(version)
        if snap.schema is None:
            raise ValueError(f"nothing has been loaded into {self.path}")
        return self.base(snap, parts).unionByName(self.deltas(snap, parts))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the folders that none of the last ``keep`` versions is made of, and the
        pointers before those. Not while a load is running. Returns the folders removed."""
        kept = sorted(self._versions())[-keep:]
        used = {f for v in kept if (s := self._parsed(v)) for f in (*s.base.values(), *(f for f, _ in s.deltas))}
        gone = [f for f in self._names(f"{self.path}/data") if f not in used]
        for folder in gone:
            self._fs.delete(self._hadoop(f"{self.path}/data/{folder}"), True)
        for v in self._versions():
            if v not in kept:
                self._fs.delete(self._hadoop(self._pointer(v)), False)
        return gone


class MergeTable(VersionedTable):
    """A versioned table of which ``merge`` leaves one row per key. ``part`` must follow from the
    key: then only parts that were written to since the last compaction need merging."""

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], part: Column | None = None):
        super().__init__(spark, path, part)
        self.merge = merge

    def latest(self, parts: Callable[[str], bool] | None = None, version: int | None = None) -> DataFrame:
        """The current row of every key."""
        snap = self.snapshot(version)
        touched = snap.touched()
        wanted = (lambda p: True) if parts is None else parts
        still = self.base(snap, lambda p: p not in touched and wanted(p))
        if not any(map(wanted, touched)):
            return still
        return still.unionByName(self._merged(snap, lambda p: p in touched and wanted(p)).drop(PART))

    def _merged(self, snap: Snapshot, parts: Callable[[str], bool]) -> DataFrame:
        # one scan, so that the merge can tell the size of what it reads
        stored = [(f, p) for p, f in sorted(snap.base.items())] + [(f, p) for f, ps in snap.deltas for p in ps]
        return self.merge(self._read(snap, [(f, p) for f, p in stored if parts(p)]))

    def compact(self) -> bool:
        """Merge what was written since the last compaction into the base. Parts that nothing was
        written to keep their files."""
        snap = self.snapshot()
        if not snap.deltas:
            return False
        touched = snap.touched()
        folder = self.stage(self._merged(snap, touched.__contains__))
        base = {p: f for p, f in snap.base.items() if p not in touched} | {p: folder for p in self._parts(folder)}
        self._commit(replace(snap, base=base, deltas=(), weights={BASE: snap.weights.get(BASE, 0) + sum(_weights(snap))}))
        return True

    def fold(self, every: int) -> bool:
        """Once ``every`` loads have gathered (a base of one load counts too): ``compact`` if they hold as many loads as the base, else
        make one folder of the newest ones. The base is so rewritten when the table has doubled, and a row about
        as often as loads can be doubled, not once in ``every`` loads; a reader opens the base and fewer than ``every``
        folders, and one more for each such doubling."""
        snap = self.snapshot()
        if len(snap.deltas) + (snap.weights.get(BASE) == 1) < every:
            return False
        weights = _weights(snap)
        if sum(weights) >= snap.weights.get(BASE, 0):
            return self.compact()
        n = 1       # the newest folders, up to one that holds more loads than all of them
        while n < len(weights) and weights[-n - 1] <= sum(weights[-n:]):
            n += 1
        if n < every:
            return False
        newest = snap.deltas[-n:]
        folder = self.stage(self.merge(self._read(snap, [(f, p) for f, ps in newest for p in ps])))
        kept = {f: w for f, w in snap.weights.items() if f not in dict(newest)}
        self._commit(replace(snap, deltas=(*snap.deltas[:-n], (folder, tuple(self._parts(folder)))),
                             weights=kept | {folder: sum(weights[-n:])}))
        return True

    def upsert(self, df: DataFrame, load_id: str | tuple[str, int], compact_every: int = 0, merged: bool = False) -> bool:
        """``append``, then ``fold`` once ``compact_every`` loads have gathered. ``merged``: ``df`` has one row per
        key, so the first load of a table is its base as it comes; folding then rewrites the parts of later loads alone."""
        def place(s: Snapshot, folder: str, parts: list[str]) -> Snapshot:
            if merged and not s.base and not s.deltas:
                return replace(s, base=dict.fromkeys(parts, folder), weights={BASE: 1})
            return replace(s, deltas=(*s.deltas, (folder, tuple(parts))))
        new = self._load(df, load_id, None, place)
        if compact_every:
            self.fold(compact_every)
        return new


def _weights(snap: Snapshot) -> list[int]:
    """Loads that each delta folder holds."""
    return [snap.weights.get(f, 1) for f, _ in snap.deltas]


#: Tasks that may share the rows of a part before it is cut into slices.
TASKS_A_SLICE = 64
SLICE = "_slice"


def dealt_by_part(rows: DataFrame, part: Column, key: str, tasks: int) -> DataFrame:
    """``rows`` with their part and a slice of it, by a hash of ``key``, dealt by both into ``tasks`` partitions.
    Dealt otherwise, each task holds rows of every part and writes a file for each: files then grow with tasks times
    parts. Here a part has as many as slices, which follow the tasks."""
    slices = max(1, tasks // TASKS_A_SLICE)
    return (rows.withColumns({PART: part, SLICE: F.pmod(F.xxhash64(key), F.lit(slices))})
            .repartition(tasks, PART, SLICE))
