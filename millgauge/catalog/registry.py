"""Registration of queries and the context they run in."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.star import Star
from ..session import pin_utc, scratch_path
from ..sources import tables
from ..sources.store import Store
from . import sql

REARM_MINUTES = 60

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_RUNS: dict[tuple, object] = {}


def once(x: "Context", name: str, start):
    """One run per session, state of the events and name: what was written is read by all queries after it."""
    at = (x.spark.sparkContext.applicationId, *tables.file_states(x.spark, x.folder, "events"), name)
    if at not in _RUNS:
        _RUNS[at] = start()
    return _RUNS[at]


class Context:
    """What a registered query may use: the tables of one folder and the star over them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = pin_utc(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.folder, name)

    @cached_property
    def star(self) -> Star:
        return Star.from_tables(self.spark, self.folder, rearm_minutes=REARM_MINUTES)

    @cached_property
    def facts(self) -> Star:
        """The star as stored facts, written once."""
        base = once(self, "facts", lambda: self.star.write(self.path("facts")).base)
        return Star.open(self.spark, base, rearm_minutes=REARM_MINUTES)

    def kept(self, name: str, rows: Callable[[], DataFrame], ts: str) -> DataFrame:
        """Rows stored once under ``name`` and read back."""
        def write() -> str:
            path = self.path(name)
            found = rows()
            Store.like(found, path, ts).overwrite(found)
            return path

        return Store.open(self.spark, once(self, name, write)).read()

    @cached_property
    def readings(self) -> DataFrame:
        return self.star.readings

    def newest(self, name: str = "as_of") -> DataFrame:
        """One row: the time of the newest reading."""
        return self.readings.agg(F.max("event_time").alias(name))

    def path(self, name: str) -> str:
        return scratch_path(self.spark, name)


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone and decimals as doubles, for comparison across engines."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, body: str | None = None):
    """Register ``fn(context)`` under ``name``; ``body`` is SQL over the shared relations."""

    def wrap(fn: Callable[[Context], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: _plain(fn(Context(spark, folder)))
        if body is not None:
            ORACLES[name] = sql.complete(body)
        return fn

    return wrap
