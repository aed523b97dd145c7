"""Facts kept as Parquet folders by month (or day), with keyed merges.

A write goes into a folder of its own and counts once a manifest names it: manifests are numbered files, created without
overwriting, and the newest complete one holds. So a crash before it leaves the table as it was, two writers cannot both win, and a
reader goes on with the folders of its manifest while others merge or compact. Folders that no kept manifest names go with ``vacuum``.

A merge reads only the partitions that its rows fall into, works out which rows really change, appends to partitions
that only gain rows and rewrites those that change others. Batches of a stream carry their number; the manifest holds the highest
of each source, so a batch that is run again changes nothing. Rows of a batch and of the table are joined by sorting: a broadcast would
send them through the driver, batch after batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import month_of_partition

PART = "part"  # partition column
NO_TIME = "none"  # partition of rows without a time
KEPT_MANIFESTS = 5
ROW_GROUP = 8 << 20  # bytes; a file is read by as many tasks as it has row groups


@dataclass(frozen=True)
class Manifest:
    """What counts: folders of every partition, and the highest batch of every source."""

    version: int = 0
    groups: dict[str, list[str]] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)
    followed: dict[str, dict[str, list[str]]] = field(default_factory=dict)  # what the table had seen of another one


class Conflict(RuntimeError):
    """Another writer committed first; nothing was changed."""


class Store:
    """A table of ``schema`` below ``path``, partitioned by ``ts`` in the form ``unit``."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, ts: str, unit: str = "yyyyMM") -> None:
        self.spark, self.path, self.ts, self.unit = spark, path.rstrip("/"), ts, unit
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    @classmethod
    def like(cls, df: DataFrame, path: str, ts: str, unit: str = "yyyyMM") -> "Store":
        """A table for rows such as those of ``df``."""
        fields = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
        return cls(df.sparkSession, path, T.StructType(fields), ts, unit)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "Store":
        """The table at ``path``, as its newest manifest describes it."""
        out = cls(spark, path, T.StructType([]), "")
        for version in reversed(out._versions()):
            about = out._load(version)
            if about is not None:
                return cls(spark, path, T.StructType.fromJson(about["schema"]), about["ts"], about["unit"])
        raise FileNotFoundError(f"no stored table at {path}")

    # ---- files and manifests ----
    def _file(self, *names: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *names)))
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _names(self, *names: str) -> list:
        files, where = self._file(*names)
        return list(files.listStatus(where)) if files.exists(where) else []

    def _versions(self) -> list[int]:
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in self._names("_manifests"))

    def _load(self, version: int) -> dict | None:
        files, where = self._file("_manifests", f"{version:012d}.json")
        stream = files.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:  # its writer died within it
            return None
        finally:
            stream.close()

    def _read_manifest(self, version: int) -> Manifest | None:
        about = self._load(version)
        return about and Manifest(version, about["groups"], about["applied"], about["followed"])

    def manifest(self) -> Manifest:
        found = (self._read_manifest(v) for v in reversed(self._versions()))
        return next((m for m in found if m is not None), Manifest())

    def commit(self, before: Manifest, groups: dict[str, list[str]], source: str | None = None, batch: int | None = None,
               followed: dict[str, dict[str, list[str]]] | None = None) -> Manifest:
        """Make ``groups`` the content. Raises ``Conflict`` if the table is no longer at ``before``."""
        versions = self._versions()
        if versions and versions[-1] > before.version and self.manifest().version > before.version:
            raise Conflict(f"{self.path} is past version {before.version}")
        applied = before.applied if batch is None else {**before.applied, source or "": batch}
        after = Manifest(max([before.version, *versions]) + 1, {p: g for p, g in groups.items() if g}, applied,
                         {**before.followed, **(followed or {})})
        files, where = self._file("_manifests", f"{after.version:012d}.json")
        try:
            stream = files.create(where, False)
        except Py4JJavaError as exc:
            raise Conflict(f"{self.path} version {after.version} is taken") from exc
        about = {"schema": json.loads(self.schema.json()), "ts": self.ts, "unit": self.unit}
        stream.write(json.dumps({**about, "groups": after.groups, "applied": after.applied, "followed": after.followed}).encode())
        stream.close()
        for old in versions[: -KEPT_MANIFESTS + 1]:
            files.delete(self._file("_manifests", f"{old:012d}.json")[1], False)
        return after

    def vacuum(self, older_than_hours: float = 24.0) -> int:
        """Remove folders that no kept manifest names; young ones may belong to a writer at work."""
        kept = [m for m in map(self._read_manifest, self._versions()) if m is not None]
        named = {g for m in kept for groups in m.groups.values() for g in groups}
        files, _ = self._file()
        now = self.spark._jvm.java.lang.System.currentTimeMillis()
        gone = [s.getPath() for s in self._names("data") if s.getPath().getName().removeprefix("write=") not in named
                and now - s.getModificationTime() >= older_than_hours * 3_600_000]
        for where in gone:
            files.delete(where, True)
        return len(gone)

    # ---- reading ----
    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def _part(self) -> Column:
        return F.coalesce(F.date_format(self.ts, self.unit), F.lit(NO_TIME))

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).withColumn(PART, self._part())

    def read(self, parts: Iterable[str] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """Rows of all or some partitions; only their folders are listed."""
        return self._rows(manifest or self.manifest(), parts).select(*self.columns)

    def _rows(self, manifest: Manifest, parts: Iterable[str] | None = None) -> DataFrame:
        wanted = manifest.groups if parts is None else {p: manifest.groups[p] for p in parts if p in manifest.groups}
        paths = [f"{self.path}/data/write={g}/{PART}={p}" for p, groups in sorted(wanted.items()) for g in groups]
        schema = T.StructType([*self.schema.fields, T.StructField("write", T.StringType()), T.StructField(PART, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)

    def between(self, start: str, end: str) -> DataFrame:
        """Rows of partitions from ``start`` to ``end``, both by name."""
        m = self.manifest()
        return self.read([p for p in m.groups if start <= p <= end], m)

    def partitions(self) -> DataFrame:
        """(part, folders) as the manifest has them: the catalogue, without reading rows."""
        rows = [(p, len(g)) for p, g in sorted(self.manifest().groups.items())]
        return self.spark.createDataFrame(rows, f"{PART} string, folders int")

    # ---- writing ----
    def _write(self, placed: DataFrame) -> tuple[str, list[str]]:
        """Store rows in a new folder: its name and the partitions it has. Nothing counts yet."""
        name = uuid.uuid4().hex
        rows = placed.hint("rebalance", PART).sortWithinPartitions(PART, self.ts)
        rows.write.option("parquet.block.size", ROW_GROUP).partitionBy(PART).parquet(f"{self.path}/data/write={name}")
        found = [s.getPath().getName() for s in self._names("data", f"write={name}")]
        return name, [n.removeprefix(f"{PART}=") for n in found if n.startswith(f"{PART}=")]

    def done(self, source: str, batch: int | None, manifest: Manifest | None = None) -> bool:
        """Whether this batch, or a later one, is in the table."""
        return batch is not None and (manifest or self.manifest()).applied.get(source, -1) >= batch

    def append(self, df: DataFrame, source: str = "", batch: int | None = None, max_folders: int | None = None,
               fold: Callable[[DataFrame], DataFrame] | None = None) -> bool:
        """Add rows; partitions that then have more than ``max_folders`` folders are compacted."""
        m = self.manifest()
        if self.done(source, batch, m):
            return False
        name, parts = self._write(self._placed(df))
        groups = {**m.groups, **{p: [*m.groups.get(p, []), name] for p in parts}}
        m = self.commit(m, groups, source, batch)
        if max_folders is not None:
            self.compact(max_folders, fold, m)
        return True

    def overwrite(self, df: DataFrame) -> Manifest:
        """Replace the whole content."""
        m = self.manifest()
        name, parts = self._write(self._placed(df))
        return self.commit(m, {p: [name] for p in parts})

    def compact(self, max_folders: int = 1, fold: Callable[[DataFrame], DataFrame] | None = None, manifest: Manifest | None = None) -> list[str]:
        """Merge the folders of partitions that have more than ``max_folders``; ``fold`` may combine their rows."""
        m = manifest or self.manifest()
        many = [p for p, g in m.groups.items() if len(g) > max_folders]
        if many:
            rows = self._rows(m, many).drop("write")
            rows = rows if fold is None else self._placed(fold(rows.drop(PART)))
            name, parts = self._write(rows)
            self.commit(m, {**{p: g for p, g in m.groups.items() if p not in many}, **{p: [name] for p in parts}})
        return many

    # ---- merging ----
    def _old(self, m: Manifest, parts: Iterable[str] | None) -> DataFrame:
        rows = self._rows(m, parts)
        return rows.select(*[F.col(c).alias(f"_old_{c}") for c in self.columns], F.lit(True).alias("_there"))

    def _touched(self, placed: DataFrame) -> list[str]:
        return [r[0] for r in placed.select(PART).distinct().collect()]  # names of partitions

    def _match(self, keys: Sequence[str]) -> Column:
        if self.ts not in keys:
            raise ValueError(f"keys need {self.ts}, or a row could lie in another partition")
        return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])

    def _differs(self, columns: Iterable[str]) -> Column:
        return reduce(Column.__or__, [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in columns], F.lit(False))

    def _apply(self, m: Manifest, changes: DataFrame, keys: Sequence[str], source: str | None, batch: int | None,
               followed: dict[str, dict[str, list[str]]] | None = None) -> dict[str, int]:
        """``changes`` are rows with their partition and ``_change`` (insert, update, delete): store them, then swap."""
        staged = f"{self.path}/_staged/{uuid.uuid4().hex}"
        changes.write.parquet(staged)
        changes = self.spark.read.schema(changes.schema).parquet(staged)
        counts: dict[str, int] = {}
        rewritten: set[str] = set()
        for r in changes.groupBy(PART, "_change").count().collect():  # a row for each touched partition
            counts[r["_change"]] = counts.get(r["_change"], 0) + r["count"]
            if r["_change"] != "insert":
                rewritten.add(r[PART])
        if counts:
            fresh = changes.where("_change <> 'delete'").select(*self.columns, PART)
            if rewritten:
                new_keys = changes.select(*[F.col(k).alias(f"_old_{k}") for k in keys])
                stay = self._rows(m, rewritten).drop("write").join(new_keys.hint("merge"), self._match(keys), "left_anti")
                fresh = fresh.unionByName(stay)
            name, parts = self._write(fresh)
            groups = {p: g for p, g in m.groups.items() if p not in rewritten}
            self.commit(m, {**groups, **{p: [*groups.get(p, []), name] for p in parts}}, source, batch, followed)
        elif batch is not None or followed:
            self.commit(m, m.groups, source, batch, followed)
        files, where = self._file("_staged")
        files.delete(where, True)
        return counts

    def insert_ignore(self, incoming: DataFrame, keys: Sequence[str], source: str = "", batch: int | None = None) -> dict[str, int]:
        """Add rows whose key is new. The keys of ``incoming`` must be unique, here and below."""
        m = self.manifest()
        if self.done(source, batch, m):
            return {}
        placed = self._placed(incoming)
        new = placed.join(self._old(m, self._touched(placed)), self._match(keys), "left_anti")
        return self._apply(m, new.withColumn("_change", F.lit("insert")), keys, source, batch)

    def upsert(self, incoming: DataFrame, keys: Sequence[str], source: str = "", batch: int | None = None) -> dict[str, int]:
        """Replace rows with an equal key where a value differs, add the others."""
        m = self.manifest()
        if self.done(source, batch, m):
            return {}
        placed = self._placed(incoming)
        rest = [c for c in self.columns if c not in keys]
        change = F.when(F.col("_there").isNull(), "insert").when(self._differs(rest), "update")
        met = placed.join(self._old(m, self._touched(placed)).hint("merge"), self._match(keys), "left").withColumn("_change", change)
        return self._apply(m, met.where("_change IS NOT NULL").select(*self.columns, PART, "_change"), keys, source, batch)

    def accumulate(self, incoming: DataFrame, keys: Sequence[str], fold: Callable[[DataFrame], DataFrame], source: str,
                   batch: int | None) -> dict[str, int]:
        """Combine rows of an equal key by ``fold``, add the others; only a batch number keeps a repeat from counting twice."""
        m = self.manifest()
        if self.done(source, batch, m):
            return {}
        placed = self._placed(incoming)
        touched = self._touched(placed)
        old = self._rows(m, touched).select(*self.columns)
        asked = placed.select(*[F.col(k).alias(f"_old_{k}") for k in keys])
        there = old.select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.lit(True).alias("_there"))
        both = fold(placed.select(*self.columns).unionByName(old.join(asked, self._match(keys), "left_semi")))
        change = F.when(F.col("_there").isNull(), "insert").otherwise("update")
        return self._apply(m, self._placed(both).join(there, self._match(keys), "left").select(*self.columns, PART, change.alias("_change")),
                           keys, source, batch)

    def update(self, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str], guard: Column | None = None, source: str = "",
               batch: int | None = None) -> dict[str, int]:
        """Set ``columns`` from the row of an equal key, where ``guard`` holds on the stored row and a value differs."""
        m = self.manifest()
        if self.done(source, batch, m):
            return {}
        named = {f.name: f.dataType for f in self.schema.fields}
        new = incoming.select(*[F.col(c).cast(named[c]).alias(f"_old_{c}") for c in (*keys, *columns)])
        touched = self._touched(new.select(F.col(f"_old_{self.ts}").alias(self.ts)).withColumn(PART, self._part()))
        rows = self._rows(m, touched).drop("write")
        rows = rows if guard is None else rows.where(F.coalesce(guard, F.lit(False)))
        met = rows.join(new.hint("merge"), self._match(keys)).where(self._differs(columns))
        value = lambda c: F.col(f"_old_{c}").alias(c) if c in columns else F.col(c)
        return self._apply(m, met.select(*map(value, self.columns), PART, F.lit("update").alias("_change")), keys, source, batch)

    def drop_orphans(self, source_rows: DataFrame, keys: Sequence[str], parts: Iterable[str] | None = None) -> dict[str, int]:
        """Delete rows whose key the source lacks, in all or some partitions."""
        m = self.manifest()
        there = source_rows.select(*[F.col(k).alias(f"_old_{k}") for k in keys])
        gone = self._rows(m, parts).drop("write").join(there, self._match(keys), "left_anti")
        return self._apply(m, gone.withColumn("_change", F.lit("delete")), keys, None, None)

    def diff(self, source_rows: DataFrame, keys: Sequence[str], parts: Iterable[str] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """Rows by which table and source differ, with ``_change``: what has to happen to the table. Each side is read once."""
        m = manifest or self.manifest()
        placed = self._placed(source_rows).withColumn("_new", F.lit(True))
        if parts is not None:
            parts = list(parts)
            placed = placed.where(F.col(PART).isin(*parts) if parts else F.lit(False))
        old = self._rows(m, parts).select(*[F.col(c).alias(f"_old_{c}") for c in self.columns], F.col(PART).alias(f"_old_{PART}"), F.lit(True).alias("_there"))
        rest = [c for c in self.columns if c not in keys]
        change = F.when(F.col("_there").isNull(), "insert").when(F.col("_new").isNull(), "delete").when(self._differs(rest), "update")
        value = lambda c: F.when(F.col("_new"), F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c)
        return placed.join(old, self._match(keys), "full").withColumn("_change", change).where("_change IS NOT NULL").select(
            *map(value, self.columns), value(PART), "_change")

    def sync(self, source_rows: DataFrame, keys: Sequence[str], parts: Iterable[str] | None = None) -> dict[str, int]:
        """Bring the table to the source: rows added, changed and dropped, in all or some partitions."""
        m = self.manifest()
        return self._apply(m, self.diff(source_rows, keys, parts, m), keys, None, None)

    def follow(self, other: "Store", keys: Sequence[str], rows: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, int]:
        """Bring the table to ``rows`` of another one: only partitions whose folders changed there since the last time are read, once on each side."""
        if (self.ts, self.unit) != (other.ts, other.unit):
            raise ValueError("both tables need the same partitions")
        m, theirs = self.manifest(), other.manifest()
        seen = m.followed.get(other.path)
        known = m.groups if seen is None else seen
        parts = sorted(p for p in {*theirs.groups, *known} if seen is None or theirs.groups.get(p) != seen.get(p))
        if not parts:
            return {}
        changes = self.diff(rows(other.read(parts, theirs)), keys, parts, m)
        return self._apply(m, changes, keys, None, None, {other.path: theirs.groups})

    # ---- retention ----
    def expired(self, as_of: Column, months: int) -> DataFrame:
        """(part) of partitions that end before the cutoff; the dry run of ``drop_expired``."""
        return self.partitions().where(self._month() < F.add_months(F.trunc(as_of, "month"), -months)).select(PART)

    def _month(self) -> Column:
        return month_of_partition(F.substring(PART, 1, 6))

    def drop_expired(self, as_of: Column, months: int) -> list[str]:
        """Take expired partitions out of the table and remove their folders; returns their names."""
        m = self.manifest()
        names = sorted(r[0] for r in self.expired(as_of, months).collect())
        if names:
            self.commit(m, {p: g for p, g in m.groups.items() if p not in names})
            for p in names:
                for group in m.groups[p]:
                    files, where = self._file("data", f"write={group}", f"{PART}={p}")
                    files.delete(where, True)
        return names
