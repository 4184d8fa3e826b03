import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from barlens.session import scratch_path
from barlens.streaming import bars as S
from barlens.versioned import MergeTable, VersionedTable
from helpers import T0, raw_rows


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k long, p string, v long")


def table(spark, name="versioned"):
    return VersionedTable(spark, scratch_path(spark, name), F.col("p"))


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_replayed_loads_are_recognised(spark):
    t = table(spark)
    a, b = rows(spark, (1, "x", 1), (2, "y", 1)), rows(spark, (3, "x", 1))
    assert t.append(a, "load-1") and t.append(b, "load-2")
    assert not t.append(a, "load-1") and not t.append(b, "load-2")
    assert content(t.read()) == [(1, "x", 1), (2, "y", 1), (3, "x", 1)]
    assert t.append(b, ("stream", 0)) and not t.append(b, ("stream", 0)) and t.append(b, ("stream", 4))
    assert not t.append(b, ("stream", 3))
    assert t.read().count() == 5


def test_stop_between_stage_and_swap(spark, monkeypatch):
    """A load that dies before its pointer is written leaves the table as it was; the replay loads it."""
    t = table(spark)
    t.append(rows(spark, (1, "x", 1)), "load-1")

    def dies(snap):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(t, "_commit", dies)
        for call in (t.append, t.replace):
            with pytest.raises(KeyboardInterrupt):
                call(rows(spark, (2, "x", 2)), "load-2")
    assert content(t.read()) == [(1, "x", 1)] and not t.holds("load-2")
    assert t.append(rows(spark, (2, "x", 2)), "load-2")
    assert content(t.read()) == [(1, "x", 1), (2, "x", 2)]
    assert len(t.vacuum()) == 2                     # the two folders that nothing points to
    assert content(t.read()) == [(1, "x", 1), (2, "x", 2)]


def test_pointer_cut_off_does_not_count(spark):
    t = table(spark)
    t.append(rows(spark, (1, "x", 1)), "load-1")
    out = t._fs.create(t._hadoop(t._pointer(2)), False)
    out.write(b'{"version": 2, "ba')
    out.close()
    assert t.snapshot().version == 1
    assert t.append(rows(spark, (2, "x", 2)), "load-2") and t.snapshot().version == 3
    assert t.read().count() == 2


def test_validation_keeps_rows_out(spark):
    t = table(spark)

    def positive(df):
        if not df.filter("v < 0").isEmpty():
            raise ValueError("negative")

    t.append(rows(spark, (1, "x", 1)), "load-1", positive)
    with pytest.raises(ValueError):
        t.replace(rows(spark, (2, "x", -2)), "load-2", positive)
    assert content(t.read()) == [(1, "x", 1)]
    assert t.replace(rows(spark, (2, "x", 2)), "load-2", positive)
    assert content(t.read()) == [(2, "x", 2)] and content(t.read(version=1)) == [(1, "x", 1)]


def test_replace_some_parts(spark):
    t = table(spark)
    t.append(rows(spark, (1, "x", 1), (2, "y", 1)), "load-1")
    assert t.replace(rows(spark, (3, "x", 5)), "load-2", parts=lambda p: p == "x")
    assert content(t.read()) == [(2, "y", 1), (3, "x", 5)]
    with pytest.raises(ValueError):
        t.replace(rows(spark, (4, "y", 5)), "load-3", parts=lambda p: p == "x")
    assert content(t.read(lambda p: p == "y")) == [(2, "y", 1)]
    assert all("_p=y" in f for f in t.read(lambda p: p == "y").inputFiles())


def test_two_writers_of_one_version(spark):
    t = table(spark)
    t.append(rows(spark, (1, "x", 1)), "load-1")
    old = t.snapshot()
    t.append(rows(spark, (2, "x", 1)), "load-2")
    with pytest.raises(RuntimeError):
        t._commit(old)


def newest(df):
    return df.groupBy("k", "p").agg(F.max("v").alias("v"))


def test_merge_reads_base_and_few_folders(spark):
    t = MergeTable(spark, scratch_path(spark, "merge"), newest, F.col("p"))
    want = {}
    for n in range(11):
        batch = [(k, "even" if k % 2 == 0 else "odd", 100 * n + k) for k in range(n, n + 3)]
        want |= {k: v for k, _, v in batch}
        t.upsert(rows(spark, *batch), ("s", n), compact_every=4)
        assert len(t.snapshot().deltas) < 4
        assert {r["k"]: r["v"] for r in t.latest().collect()} == want
        folders = {f.split("/data/")[1].split("/")[0] for f in t.latest().inputFiles()}
        assert len(folders) <= 4
        assert not t.upsert(rows(spark, *batch), ("s", n), compact_every=4)


def test_folding_writes_a_row_as_often_as_loads_double(spark, monkeypatch):
    """Sixteen loads of a row each: folded into the base every second load, they write 72 rows beside the loads."""
    t = MergeTable(spark, scratch_path(spark, "fold"), newest, F.col("p"))
    staged, stage = [], t.stage
    monkeypatch.setattr(t, "stage", lambda df: staged.append(df.count()) or stage(df))
    for n in range(16):
        assert t.upsert(rows(spark, (n % 12, "x", n)), ("s", n), compact_every=2)
        assert len(t.snapshot().deltas) <= 4
    assert content(t.latest()) == [(k, "x", k + 12 if k < 4 else k) for k in range(12)]
    assert sum(staged) - 16 <= 48
    # a pointer written before loads were counted
    t._commit(replace(t.snapshot(), weights={}))
    assert t.upsert(rows(spark, (1, "x", 99)), ("s", 16), compact_every=1) and not t.snapshot().deltas
    assert (1, "x", 99) in content(t.latest()) and t.latest().count() == 12


def test_compaction_leaves_untouched_parts(spark):
    t = MergeTable(spark, scratch_path(spark, "merge"), newest, F.col("p"))
    t.upsert(rows(spark, (1, "x", 1), (2, "y", 1)), ("s", 0))
    t.compact()
    before = t.snapshot()
    t.upsert(rows(spark, (1, "x", 7)), ("s", 1))
    reader = t.latest()
    assert t.compact() and not t.compact()
    after = t.snapshot()
    assert after.base["y"] == before.base["y"] and after.base["x"] != before.base["x"]
    assert content(t.latest()) == [(1, "x", 7), (2, "y", 1)]
    assert content(reader) == [(1, "x", 7), (2, "y", 1)]            # a reader's version stays readable
    assert set(t.vacuum()) and content(t.latest()) == [(1, "x", 7), (2, "y", 1)]


def _feed(spark, rows_):
    return raw_rows(spark, rows_).withColumn("frequency", F.lit("daily"))


def test_stream_compacts_and_survives_a_crash(spark, monkeypatch):
    base = scratch_path(spark, "live")
    landing, target, ckpt = f"{base}/in", f"{base}/t", f"{base}/ck"
    day = dt.date(2024, 1, 30)
    want = {}

    def deliver():
        S.run_available_now(S.stream_bars(spark, landing, max_files=1).writeStream
                            .foreachBatch(S.upsert_latest(target, compact_every=3)).option("checkpointLocation", ckpt))

    for n in range(5):
        price = str(10 + n)
        _feed(spark, [(k, day + dt.timedelta(days=k), price, T0 + dt.timedelta(hours=n)) for k in range(n, n + 2)]) \
            .coalesce(1).write.mode("append").parquet(landing)
        want |= {k: f"{price}.0000" for k in range(n, n + 2)}
        if n == 3:      # the job dies after staging, before the pointer
            with monkeypatch.context() as m:
                m.setattr(MergeTable, "_commit", lambda self, snap: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(Exception):
                    deliver()
        deliver()
        assert len(S.live_bars(spark, target).snapshot().deltas) < 3
        assert {r["pair_id"]: str(r["last_close"]) for r in S.latest_view(spark, target).collect()} == want
    assert {r["pair_id"] for r in S.latest_view(spark, target, lambda p: p.endswith("2024-01")).collect()} == {0, 1}


def test_a_batch_makes_one_file_of_a_month(spark):
    target = scratch_path(spark, "months")
    bars = [(k, dt.date(2024, 1 + m, 1 + d), f"{m}.{d}", T0) for k in range(3) for m in range(12) for d in range(20)]
    merge_small = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(merge_small)
    for n in range(2):      # a load, and one that is folded into it
        spark.conf.set(merge_small, "false")       # as with much data, whose partitions are not merged
        S.upsert_latest(target, compact_every=2)(_feed(spark, bars).repartition(4), n)
        spark.conf.set(merge_small, held)
        files = S.latest_view(spark, target).inputFiles()
        assert len(files) == 12 and S.latest_view(spark, target).count() == len(bars), (n, len(files))


def test_slices_follow_the_tasks(spark):
    from barlens.versioned import SLICE, TASKS_A_SLICE, dealt_by_part
    df = spark.range(1000)
    for tasks, slices in ((4, 1), (3 * TASKS_A_SLICE, 3)):
        dealt = dealt_by_part(df, F.lit("p"), "id", tasks)
        assert dealt.select(SLICE).distinct().count() == slices and dealt.rdd.getNumPartitions() == tasks


def test_repeats_go_and_corrections_stay(spark):
    """Deliveries that overlap by the span; the state keeps one span of bars."""
    base = scratch_path(spark, "repeats")
    landing, out, ckpt = f"{base}/in", f"{base}/out", f"{base}/ck"
    start, want, kept = dt.date(2024, 1, 1), [], []
    for n in range(12):
        loaded = T0 + dt.timedelta(days=10 * n)
        bars = [(k, start + dt.timedelta(days=10 * n - back), f"{k + 1}.5", loaded) for k in range(3) for back in range(15)]
        if n:       # an old bar, corrected
            bars.append((0, start - dt.timedelta(days=3), f"{90 + n}", loaded))
        _feed(spark, bars).coalesce(1).write.mode("append").parquet(landing)
        want += [b[:3] for b in bars if b[:3] not in want]
        q = (S.without_repeats(S.stream_bars(spark, landing), arrived=F.col("record_created_on")).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        kept.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r["pair_id"], r["row_date_timestamp"].date(), r["last_close"]) for r in spark.read.parquet(out).collect())
    assert got == sorted(want)
    assert max(kept[6:]) <= max(kept[2:6]) + 5, kept       # doesn't grow with the stream
