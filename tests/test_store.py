"""Stored facts: merges, compaction, crashes, retention."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millgauge.session import scratch_path
from millgauge.sources import store

SCHEMA = "k string, ts timestamp, n bigint, note string"
KEYS = ("k", "ts")


def at(month, day=1):
    return dt.datetime(2024, month, day, 12, tzinfo=dt.timezone.utc)


def rows(spark, *found):
    return spark.createDataFrame([(k, at(m), n, note) for k, m, n, note in found], SCHEMA)


@pytest.fixture
def table(spark):
    out = store.Store(spark, scratch_path(spark, "store"), SCHEMA, "ts")
    out.append(rows(spark, *[(k, m, m, None) for k in "abc" for m in (1, 2, 3)]))
    return out


def content(t, **kw):
    return sorted((r.k, r.ts.month, r.n, r.note) for r in t.read(**kw).collect())


def files(t):
    """Each file behind the table with its time of change."""
    found = t._rows(t.manifest()).select("_metadata.file_path", "_metadata.file_modification_time", "part").distinct().collect()
    return {(r.part, r.file_path, r.file_modification_time) for r in found}


def test_merge_rewrites_only_what_changes(spark, table):
    before, base = files(table), content(table)
    changes = rows(spark, ("a", 1, 1, None), ("b", 2, 20, "x"), ("d", 3, 9, None))
    assert table.upsert(changes, KEYS) == {"update": 1, "insert": 1}
    after = files(table)
    assert {f for f in before if f[0] != "202402"} <= after  # January untouched, March only gained a file
    assert not {f for f in before if f[0] == "202402"} & after
    assert content(table) == sorted({*base} - {("b", 2, 2, None)} | {("b", 2, 20, "x"), ("d", 3, 9, None)})
    version = table.manifest().version
    assert table.upsert(changes, KEYS) == {} and table.manifest().version == version and files(table) == after


def test_insert_ignore_update_and_orphans(spark, table):
    assert table.insert_ignore(rows(spark, ("a", 1, 99, None), ("z", 5, 5, None)), KEYS) == {"insert": 1}
    assert ("a", 1, 1, None) in content(table) and ("z", 5, 5, None) in content(table)
    ends = rows(spark, ("a", 1, 7, None), ("b", 2, 8, None), ("q", 2, 8, None))
    assert table.update(ends, KEYS, ["n"], F.col("n") < 2) == {"update": 1}
    assert ("a", 1, 7, None) in content(table) and ("b", 2, 2, None) in content(table)
    assert table.update(ends, KEYS, ["n"], F.col("n") < 2) == {}
    assert table.drop_orphans(table.read().where("k <> 'c'"), KEYS, ["202401", "202402"]) == {"delete": 2}
    assert [r for r in content(table) if r[0] == "c"] == [("c", 3, 3, None)]


def test_accumulate_counts_a_batch_once(spark, table):
    add = lambda df: df.groupBy("k", "ts").agg(F.sum("n").alias("n"), F.max("note").alias("note"))
    batch = rows(spark, ("a", 1, 10, "m"), ("new", 1, 1, None))
    for _ in range(2):
        table.accumulate(batch, KEYS, add, "stream", 4)
    assert {("a", 1, 11, "m"), ("new", 1, 1, None), ("b", 1, 1, None)} <= set(content(table))
    assert table.accumulate(batch, KEYS, add, "stream", 3) == {}  # an older one either


def test_sync_and_diff(spark, table):
    source = table.read().where("k <> 'a' OR ts > '2024-02-20'").withColumn("n", F.when(F.col("k") == "b", F.col("n") + F.month("ts") % 2).otherwise(F.col("n")))
    source = source.unionByName(rows(spark, ("e", 7, 1, None)))
    kinds = {(r.k, r.ts.month, r["_change"]) for r in table.diff(source, KEYS).collect()}
    assert kinds == {("a", 1, "delete"), ("a", 2, "delete"), ("b", 1, "update"), ("b", 3, "update"), ("e", 7, "insert")}
    march = {f for f in files(table) if f[0] == "202403"}
    assert table.sync(source, KEYS, ["202401", "202402"]) == {"delete": 2, "update": 1}
    assert march <= files(table)
    want = sorted((r.k, r.ts.month, r.n, r.note) for r in source.collect())
    assert table.sync(source, KEYS) == {"update": 1, "insert": 1} and content(table) == want
    assert table.sync(source, KEYS) == {} and table.diff(source, KEYS).count() == 0


def test_follow_reads_only_changed_partitions(spark, table, monkeypatch):
    copy = store.Store(spark, scratch_path(spark, "copy"), SCHEMA, "ts")
    copy.append(rows(spark, ("a", 1, 100, None), ("gone", 2, 1, None), ("old", 9, 1, None)))
    only = lambda df: df.where("k <> 'c'")
    assert copy.follow(table, KEYS, only) == {"update": 1, "insert": 5, "delete": 2}
    assert content(copy) == [r for r in content(table) if r[0] != "c"]
    assert copy.follow(table, KEYS, only) == {}
    before = files(copy)
    table.upsert(rows(spark, ("b", 2, 22, None)), KEYS)
    read, plain = [], store.Store._rows
    monkeypatch.setattr(store.Store, "_rows", lambda self, m, parts=None: (read.append(parts), plain(self, m, parts))[1])
    assert copy.follow(table, KEYS, only) == {"update": 1}
    assert read and all(list(p) == ["202402"] for p in read)
    monkeypatch.undo()
    assert {f for f in before if f[0] != "202402"} <= files(copy)
    assert content(copy) == [r for r in content(table) if r[0] != "c"]


def test_null_keys_and_times(spark):
    t = store.Store(spark, scratch_path(spark, "store"), SCHEMA, "ts")
    odd = spark.createDataFrame([(None, None, 1, "a"), (None, at(1), 2, "b"), ("x", None, 3, "c")], SCHEMA)
    assert t.upsert(odd, KEYS) == {"insert": 3}
    assert t.upsert(odd, KEYS) == {}
    assert t.upsert(odd.withColumn("n", F.lit(7)), KEYS) == {"update": 3}
    assert sorted(r.note for r in t.read().where("n = 7").collect()) == ["a", "b", "c"]
    assert t.read(["none"]).count() == 2


def test_crash_before_the_swap_loses_nothing(spark, table, monkeypatch):
    base, seen = content(table), table.read()
    with monkeypatch.context() as m:
        m.setattr(store.Store, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("power cut")))
        for work in (lambda: table.upsert(rows(spark, ("a", 1, 50, None)), KEYS), table.compact, lambda: table.append(rows(spark, ("y", 1, 1, None)))):
            try:
                work()
            except RuntimeError:
                pass
            assert content(table) == base
    assert table.upsert(rows(spark, ("a", 1, 50, None)), KEYS) == {"update": 1}
    assert ("a", 1, 50, None) in content(table)
    assert sorted((r.k, r.ts.month, r.n, r.note) for r in seen.collect()) == base  # an older reader reads on
    assert table.vacuum(0) > 0 and ("a", 1, 50, None) in content(table)


def test_half_written_manifest_is_passed_over(spark, table):
    base, m = content(table), table.manifest()
    files_, where = table._file("_manifests", f"{m.version + 1:012d}.json")
    stream = files_.create(where, False)
    stream.write(b'{"groups": {"202401"')
    stream.close()
    assert content(table) == base and table.manifest() == m
    assert table.append(rows(spark, ("y", 1, 1, None))) and len(content(table)) == len(base) + 1
    assert table.manifest().version == m.version + 2


def test_second_writer_is_refused(spark, table):
    stale = table.manifest()
    table.append(rows(spark, ("y", 1, 1, None)))
    with pytest.raises(store.Conflict):
        table.commit(stale, stale.groups)


def test_compaction_under_batches(spark):
    """Listing does not grow with batches, a batch counts once, readers see the same rows throughout."""
    t = store.Store(spark, scratch_path(spark, "store"), SCHEMA, "ts")
    for batch in range(12):
        for _ in range(2):
            t.append(rows(spark, ("k%d" % batch, 1 + batch // 6, batch, None)), "s", batch, max_folders=3)
        assert len(content(t)) == batch + 1
        assert all(len(g) <= 3 for g in t.manifest().groups.values())
    assert len(t._versions()) <= store.KEPT_MANIFESTS
    before, reader = content(t), t.read()
    assert t.compact() and content(t) == before
    assert sorted((r.k, r.ts.month, r.n, r.note) for r in reader.collect()) == before
    assert not t.append(rows(spark, ("again", 1, 1, None)), "s", 11) and content(t) == before
    assert [(r.part, r.folders) for r in t.partitions().collect()] == [("202401", 1), ("202402", 1)]
    t.vacuum(0)
    assert content(t) == before


def test_only_named_partitions_are_listed(spark, table):
    assert {r.ts.month for r in table.read(["202402"]).collect()} == {2}
    assert {r.ts.month for r in table.between("202402", "202403").collect()} == {2, 3}
    assert len(table.read(["202402"]).inputFiles()) < len(table.read().inputFiles())


def test_retention(spark, table):
    as_of = F.lit("2024-03-20").cast("date")
    assert [r.part for r in table.expired(as_of, 1).collect()] == ["202401"]
    assert len(content(table)) == 9
    gone = [f for p, f, _ in files(table) if p == "202401"]
    assert table.drop_expired(as_of, 1) == ["202401"] and table.drop_expired(as_of, 1) == []
    assert {r[1] for r in content(table)} == {2, 3}
    fs, _ = table._file()
    assert gone and not any(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f)) for f in gone)


def test_keys_must_name_the_partition(spark, table):
    with pytest.raises(ValueError):
        table.upsert(rows(spark, ("a", 1, 1, None)), ["k"])


def test_a_large_file_is_read_by_several_tasks(spark):
    import glob

    import pyarrow.parquet as pq

    path = scratch_path(spark, "row_groups")
    df = spark.range(2_000_000, numPartitions=1).select(
        F.lit("a").alias("k"), F.lit(at(1)).cast("timestamp").alias("ts"), F.xxhash64("id").alias("n"), F.lit(None).cast("string").alias("note"))
    out = store.Store(spark, path, SCHEMA, "ts")
    out.append(df)
    files = glob.glob(f"{path}/data/*/*/*.parquet")
    assert sum(pq.ParquetFile(f).num_row_groups for f in files) > len(files) and out.read().count() == 2_000_000
