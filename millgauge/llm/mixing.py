"""Mixing sources to target weights by entropy balancing.

Method: every document gets a rate between 0 and ``MOST`` copies. Among all rates that give a source its target of words, those with
the largest entropy (of a share taken and a share left) are wanted; they are exponentially tilted by the document's size over the
mean size of its source, ``MOST / (1 + exp(-tilt * size / mean))``, so a tilt of 0 is one copy of each. The convex dual has one tilt a
source, found by Newton steps: a distributed sum of words and of their slope for each source, a bracket that holds the root, a
step. Rates become copies by rounding their running sum over the sizes of a source, largest first, which keeps the words within half
a document of the target; rounds of the largest size that still fits then use up what is left.

Documents of one source and size have one rate, so Newton steps and rounding run over the table of (source, size, documents). Which of
them take the rounded copies follows the order of a hash of the id. Sums are of whole numbers (rates in units of 2**-30): they do not depend on
the order of tasks, and reruns agree.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share 150 % of all words; a target stops at ``MOST`` times the
words of its source and the rest is shared by weight among the others, until none is above.

Defined cases: null texts have no words; documents without words take none; a null source is one of its own, a null id is an id; rows with one
id, source and size are told apart by nothing and share their copies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import written

WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
UNIT = 1 << 30
CLOSE = 1e-7  # of the target
MAX_STEPS = 60
BUCKET_ROWS = 50_000
WORD = r"[^\x20\x09-\x0D]+"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = pc.fill_null(pc.count_substring_regex(batch.column("text"), WORD), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("source"), counts], ["id", "source", "size"])


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``number``, the place of ``source`` in code point order, null last."""
    order = F.col("source").asc_nulls_last()
    ranged = written(sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()), "sources")
    part, before = F.shiftright("at", 33), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(part.alias("part")).count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))  # a row a partition
    return (ranged.withColumn("part", part).join(F.broadcast(starts), "part")
            .withColumn("number", F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "start", "at"))


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` and ``full`` (the target is the most there is) to (number, source_size, ...)."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    wide = lambda c: c.cast("decimal(38,0)")
    rows = sources.withColumn("weight", weight)
    budget = share * int(rows.agg(F.sum("source_size")).first()[0] or 0)
    per, full = Fraction(0), F.lit(False)
    while True:
        left = rows.agg(F.sum(F.when(full, F.col("source_size") * most)).alias("used"), F.sum(F.when(~full, F.col("weight"))).alias("free")).first()
        if not left.free:
            break
        found = (budget - (left.used or 0)) / left.free
        if found == per:
            break
        per = found
        full = wide(F.col("source_size")) * wide(F.lit(most * per.denominator)) <= wide(F.col("weight")) * wide(F.lit(per.numerator))
    shared = F.element_at(F.create_map(*[F.lit(x) for w in sorted(set(weights)) for x in (w, float(w * per))]), F.col("weight"))
    target = F.when(full, (F.col("source_size") * most).cast("double")).otherwise(shared)
    return rows.withColumn("target", target).withColumn("full", full).drop("weight")


def _rate(tilt: Column, size: Column, mean: Column, full: Column, most: int) -> Column:
    """Copies in units of 2**-30."""
    return F.when(full, F.lit(most * UNIT)).otherwise(F.floor(most / (1 + F.exp(-tilt * size / mean)) * UNIT + 0.5)).cast("bigint")


def tilted(sizes: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (number, source_size, docs, target, full) with ``tilt``, such that rates give the targets."""
    wide = lambda c: c.cast("decimal(38,0)")
    state = sources.select("number", F.col("target").alias("aim"), "full", (F.col("source_size") / F.col("docs")).alias("mean"),
                           F.lit(0.0).alias("tilt"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
                           (F.col("full") | (F.col("source_size") == 0)).alias("done"))
    state = written(state, "tilts")
    for _ in range(MAX_STEPS):
        if state.where("not done").isEmpty():
            break
        rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"), F.col("full"), most)
        share = rate / UNIT
        slope = F.floor(F.col("size") / F.col("mean") * share * (1 - share / most) * UNIT + 0.5)
        words = wide(F.col("n") * F.col("size"))
        sums = (sizes.join(state.where("not done").withColumnRenamed("number", "of"), F.col("number") == F.col("of"))
                .groupBy("of").agg(F.sum(words * wide(rate)).alias("words"), F.sum(words * wide(slope)).alias("slope")))
        over = F.col("words").cast("double") / UNIT - F.col("aim")
        near = F.abs(over) <= F.greatest(F.col("aim") * CLOSE, F.lit(0.25))
        reach = 2 * F.greatest(F.lit(1.0), F.abs("tilt"))
        step = F.coalesce(F.least(F.greatest(F.try_divide(over, F.col("slope").cast("double") / UNIT), -reach), reach), F.signum(over) * reach)
        moved = (state.join(sums, F.col("number") == F.col("of"), "left")
                 .withColumns({"high": F.when(over > 0, F.col("tilt")).otherwise(F.col("high")), "low": F.when(over < 0, F.col("tilt")).otherwise(F.col("low")),
                               "next": F.col("tilt") - step, "near": F.coalesce(near, F.lit(False))}))
        inside = (F.col("next") > F.col("low")) & (F.col("next") < F.col("high"))
        still = F.col("done") | F.col("near")
        state = written(moved.select(
            "number", "aim", "full", "mean",
            F.when(still, F.col("tilt")).when(inside, F.col("next")).otherwise((F.col("low") + F.col("high")) / 2).alias("tilt"),
            "low", "high", still.alias("done")), "tilts")
    return sources.join(state.select(F.col("number").alias("of"), "tilt", "mean"), F.col("number") == F.col("of")).drop("of")


def rounded(sizes: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """(number, size, n, rate, copies): whole copies of all documents of a source and size together."""
    by = Window.partitionBy("number").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)  # distinct sizes of a source
    rates = (sizes.join(sources.select(F.col("number").alias("of"), "tilt", "mean", "full"), F.col("number") == F.col("of"))
             .withColumn("rate", _rate(F.col("tilt"), F.col("size"), F.coalesce(F.nullif("mean", F.lit(0.0)), F.lit(1.0)), F.col("full"), most)))
    whole = F.col("n").cast("decimal(20,0)") * F.col("rate").cast("decimal(18,0)")
    down = lambda c: F.floor((c + F.lit(UNIT // 2)) / F.lit(UNIT)).cast("bigint")
    runs = (rates.withColumn("whole", whole).withColumn("sum", F.sum("whole").over(by))
            .withColumn("copies", down(F.col("sum")) - down(F.col("sum") - F.col("whole"))).select("number", "size", "n", "rate", "copies"))
    runs = written(runs, "copies")
    aims = sources.select(F.col("number").alias("of"), F.floor(F.col("target") + 0.5).alias("aim"))
    for _ in range(MAX_STEPS):
        over = (runs.groupBy("number").agg(F.sum(F.col("copies") * F.col("size")).alias("words")).join(aims, F.col("number") == F.col("of"))
                .select("of", (F.col("words") - F.col("aim")).alias("over")).where("over <> 0"))
        can = F.when(F.col("over") > 0, F.col("copies")).otherwise(most * F.col("n") - F.col("copies"))
        fits = (runs.join(over, F.col("number") == F.col("of")).withColumn("can", can).where((F.col("size") > 0) & (F.col("can") > 0) & (F.col("size") <= F.abs("over")))
                .groupBy("of").agg(F.max_by(F.struct("size", "can", "over"), "size").alias("best")))
        change = written(fits.select("of", F.col("best.size").alias("at"), (
            -F.signum("best.over").cast("bigint") * F.least("best.can", F.expr("abs(best.over) div best.size"))).alias("change")), "changes")
        if change.isEmpty():
            break
        runs = written(runs.join(change, (F.col("number") == F.col("of")) & (F.col("size") == F.col("at")), "left")
                       .select("number", "size", "n", "rate", (F.col("copies") + F.coalesce("change", F.lit(0))).alias("copies")), "copies")
    return runs


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
        share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken), one row for each of ``docs``."""
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, source_col)]
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("text"))
    rows = picked.mapInArrow(_sizes, f"id {kinds[0]}, source {kinds[1]}, size bigint")
    ids = written(rows.groupBy("id", "source", "size").agg(F.count("*").alias("m")), "sizes")
    by_size = written(ids.groupBy("source", "size").agg(F.sum("m").alias("n")), "size-counts")
    totals = by_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("docs"))
    sources = written(with_targets(written(numbered(totals), "numbered"), weights, share, most), "targets")
    known = sources.select(F.col("source").alias("known"), "number")
    sizes = written(by_size.join(known, F.col("source").eqNullSafe(F.col("known"))).select("number", "size", "n"), "sizes-by-source")
    sources = written(tilted(sizes, sources, most), "tilted")
    runs = rounded(sizes, sources, most)
    runs = runs.join(sources.select(F.col("number").alias("of"), F.col("source").alias("known"), "source_size", "target"), F.col("number") == F.col("of")).select(
        "known", F.col("size").alias("known_size"), "source_size", "target", (F.col("rate") / UNIT).alias("rate"), F.expr("copies div n").alias("least"),
        (F.col("copies") % F.col("n")).alias("more"), F.ceil(F.col("n") / BUCKET_ROWS).alias("buckets"))
    placed = (ids.join(runs, F.col("source").eqNullSafe(F.col("known")) & (F.col("size") == F.col("known_size"))).drop("known", "known_size")
              .withColumn("bucket", F.pmod(F.xxhash64("id"), F.col("buckets"))))
    placed = written(placed, "placed")
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy("source", "size", "bucket").agg(F.sum("m").alias("sum"))
              .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("bucket").alias("b"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("source", "size", "bucket").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (placed.withColumn("first", F.coalesce(F.sum("m").over(within), F.lit(0)))
              .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("bucket") == F.col("b"))))
    extra = F.least(F.greatest(F.col("more") - F.col("start") - F.col("first"), F.lit(0)), F.col("m"))
    each = ranked.withColumn("extra", extra).withColumn("k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))))
    copies = F.col("least") + F.when(F.col("k") <= F.col("extra"), 1).otherwise(0)
    return each.withColumn("copies", copies).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
