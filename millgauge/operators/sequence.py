"""Ordered operators that survive a key holding most of the rows.

A plain window over one machine puts the machine's whole history into one task.
Here a window only ever covers one (key, time chunk). What a chunk must know of
its neighbours is one small summary row per chunk; those summaries are chained
in a window of their own and joined back on (key, chunk). The chunk length caps
the rows per task; the number of chunks caps the summaries per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600


def _chunk(ts: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (seconds * 1_000_000)).cast("bigint")


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: Sequence[str] = (),
    lag: dict[str, Column] | None = None,
    lead: dict[str, Column] | None = None,
    last: dict[str, Column] | None = None,
    total: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
    highest: dict[str, Column] | None = None,
    chunk_seconds: int = HOUR,
) -> DataFrame:
    """Add columns in (ts, ties) order within ``keys``: value of the row before (`lag`)
    or after (`lead`), last non-null so far (`last`), running sum (`total`), next non-null
    from here on (`following`), and largest value of all rows before (`highest`).

    The input is read twice, for the summaries and for the rows, whatever is asked for in one call.
    Nested calls double that each time; for results that build on each other see ``scanned``."""
    lag, lead, last, total, following = lag or {}, lead or {}, last or {}, total or {}, following or {}
    highest = highest or {}
    keys = list(keys)
    order = F.struct(ts, *ties) if ties else F.struct(ts)
    src = df.withColumn("_chunk", _chunk(ts, chunk_seconds))
    for group, exprs in (("g", lag), ("d", lead), ("l", last), ("t", total), ("f", following), ("h", highest)):
        for name, expr in exprs.items():
            src = src.withColumn(f"_{group}_{name}", expr)

    # One summary row per (key, chunk).
    summary = []
    if lag:
        summary.append(F.max_by(F.struct(*[F.col(f"_g_{n}").alias(n) for n in lag]), order).alias("_tail"))
    if lead:
        summary.append(F.min_by(F.struct(*[F.col(f"_d_{n}").alias(n) for n in lead]), order).alias("_head"))
    for n in last:
        summary.append(
            F.max_by(F.col(f"_l_{n}"), F.when(F.col(f"_l_{n}").isNotNull(), order)).alias(f"_last_{n}")
        )
    for n in total:
        summary.append(F.sum(f"_t_{n}").alias(f"_sum_{n}"))
    for n in following:
        summary.append(
            F.min_by(F.col(f"_f_{n}"), F.when(F.col(f"_f_{n}").isNotNull(), order)).alias(f"_first_{n}")
        )
    for n in highest:
        summary.append(F.max(f"_h_{n}").alias(f"_max_{n}"))
    chunks = src.groupBy(*keys, "_chunk").agg(*summary)

    # Chain the summaries.
    chain = Window.partitionBy(*keys).orderBy("_chunk")
    before = chain.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.col(k) for k in keys] + [F.col("_chunk")]
    if lag:
        carried.append(F.lag("_tail").over(chain).alias("_tail_c"))
    if lead:
        carried.append(F.lead("_head").over(chain).alias("_head_c"))
    for n in last:
        carried.append(F.last(f"_last_{n}", ignorenulls=True).over(before).alias(f"_last_c_{n}"))
    for n in total:
        carried.append(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_sum_c_{n}"))
    for n in following:
        carried.append(F.last(f"_first_{n}", ignorenulls=True).over(after).alias(f"_first_c_{n}"))
    for n in highest:
        carried.append(F.max(f"_max_{n}").over(before).alias(f"_max_c_{n}"))
    carry = chunks.select(*carried)

    # Windows inside one chunk, then the carried values at its edges.
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts, *ties)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = [F.col(c) for c in df.columns] + [F.col("_chunk")]
    if lag:
        local.append(F.lag(F.struct(*[F.col(f"_g_{n}").alias(n) for n in lag])).over(inside).alias("_prev"))
    if lead:
        local.append(F.lead(F.struct(*[F.col(f"_d_{n}").alias(n) for n in lead])).over(inside).alias("_next"))
    for n in last:
        local.append(F.last(f"_l_{n}", ignorenulls=True).over(upto).alias(f"_run_{n}"))
    for n in total:
        local.append(F.sum(f"_t_{n}").over(upto).alias(f"_acc_{n}"))
    for n in highest:
        local.append(F.max(f"_h_{n}").over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_high_{n}"))
    if following:
        # Backwards order: a growing frame costs one step per row, a shrinking one does not.
        back = Window.partitionBy(*keys, "_chunk").orderBy(F.desc(ts), *[F.desc(c) for c in ties])
        back = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for n in following:
            local.append(F.last(f"_f_{n}", ignorenulls=True).over(back).alias(f"_fol_{n}"))
    joined = src.select(*local).join(carry, [*keys, "_chunk"], "left")

    out = [F.col(c) for c in df.columns]
    out += [F.coalesce("_prev", "_tail_c")[n].alias(n) for n in lag]
    out += [F.coalesce("_next", "_head_c")[n].alias(n) for n in lead]
    out += [F.coalesce(f"_run_{n}", f"_last_c_{n}").alias(n) for n in last]
    out += [(F.coalesce(F.col(f"_acc_{n}"), F.lit(0)) + F.col(f"_sum_c_{n}")).alias(n) for n in total]
    out += [F.coalesce(f"_fol_{n}", f"_first_c_{n}").alias(n) for n in following]
    out += [F.greatest(f"_high_{n}", f"_max_c_{n}").alias(n) for n in highest]
    return joined.select(*out)


def scanned(
    df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], local, summary: dict[str, Column], chain: Sequence,
    out: dict[str, Column], chunk_seconds: int = HOUR,
) -> DataFrame:
    """One associative scan in (ts, ties) order within ``keys``, for results that build on each other.

    ``local(upto, before)`` gives steps of columns from windows over one chunk; ``summary`` condenses a chunk to one row, from those
    columns too; each step of ``chain(before, order)`` adds columns to the summaries from a window over the chunks before; ``out``
    puts both together for every row. The input is read twice whatever the number of steps.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(ts, *ties)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn("_chunk", _chunk(ts, chunk_seconds))
    for step in local(upto, inside.rowsBetween(Window.unboundedPreceding, -1)):
        rows = rows.withColumns(step)
    chunks = rows.groupBy(*keys, "_chunk").agg(*[c.alias(n) for n, c in summary.items()])
    order = Window.partitionBy(*keys).orderBy("_chunk")
    for step in chain(order.rowsBetween(Window.unboundedPreceding, -1), order):
        chunks = chunks.withColumns(step)
    joined = rows.join(chunks, [*keys, "_chunk"], "left")
    return joined.select(*[F.col(c) for c in df.columns], *[c.alias(n) for n, c in out.items()])


def count_starts(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], active: Column, name: str = "episode", **kw) -> DataFrame:
    """Number of runs of ``active`` rows that have begun so far. A chunk knows its first and last state and the runs that begin in it; a
    run that began before does not begin again."""
    order = F.struct(ts, *ties)
    on = F.coalesce(active, F.lit(False))
    goes_on = (F.col("_first_on") & F.coalesce("_carried_on", F.lit(False))).cast("bigint")
    return scanned(
        df, keys, ts, ties,
        lambda upto, before: [{"_on": on}, {"_was_on": F.last("_on").over(before)},
                              {"_begun": F.sum((F.col("_on") & ~F.coalesce("_was_on", F.lit(False))).cast("bigint")).over(upto)}],
        {"_first_on": F.min_by("_on", order), "_last_on": F.max_by("_on", order), "_all_begun": F.max("_begun")},
        lambda before, chunks: [{"_carried_on": F.lag("_last_on").over(chunks)},
                                {"_begun_before": F.coalesce(F.sum(F.col("_all_begun") - goes_on).over(before), F.lit(0))}],
        {name: F.col("_begun_before") + F.col("_begun") - goes_on}, **kw)


def number_gaps(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], end: Column, gap_seconds: float, name: str = "episode", **kw) -> DataFrame:
    """Number of the episode a row belongs to; one starts where ``ts`` is more than the gap after the latest end so far.

    A chunk keeps the times at which episodes would start in it. Ends from before take away the first of them, never later ones.
    """
    at, gap = F.unix_micros(F.col(ts).cast("timestamp")), int(gap_seconds * 1_000_000)
    fresh = F.coalesce(F.col("_at") - F.col("_top") > gap, F.lit(True))
    stay = F.size(F.filter("_heads", lambda h: F.coalesce(h - F.col("_reach") > gap, F.lit(True)))).cast("bigint")
    return scanned(
        df, keys, ts, ties,
        lambda upto, before: [{"_at": at, "_end": F.unix_micros(end.cast("timestamp"))}, {"_top": F.max("_end").over(before)},
                              {"_fresh": fresh}, {"_here": F.sum(F.col("_fresh").cast("bigint")).over(upto)}],
        {"_most": F.max("_end"), "_heads": F.collect_list(F.when(F.col("_fresh"), F.col("_at")))},
        lambda before, chunks: [{"_reach": F.max("_most").over(before)}, {"_stay": stay},
                                {"_earlier": F.coalesce(F.sum("_stay").over(before), F.lit(0))}],
        {name: F.col("_earlier") + F.greatest(F.col("_here") - (F.size("_heads") - F.col("_stay")), F.lit(0))}, **kw)


def run_lengths(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], hit: Column, name: str = "run", **kw) -> DataFrame:
    """Length of the unbroken run of ``hit`` rows that ends here; 0 where it is not one. It is the hits so far less those up to the last miss."""
    is_hit = F.coalesce(hit, F.lit(False))
    base = F.coalesce(F.col("_hits_before") + F.col("_base"), F.col("_base_before"), F.lit(0))
    return scanned(
        df, keys, ts, ties,
        lambda upto, before: [{"_hit": is_hit}, {"_hits": F.sum(F.col("_hit").cast("bigint")).over(upto)},
                              {"_base": F.max(F.when(~F.col("_hit"), F.col("_hits"))).over(upto)}],
        {"_all_hits": F.max("_hits"), "_last_base": F.max(F.when(~F.col("_hit"), F.col("_hits")))},
        lambda before, chunks: [{"_hits_before": F.coalesce(F.sum("_all_hits").over(before), F.lit(0))},
                                {"_known": F.col("_hits_before") + F.col("_last_base")},
                                {"_base_before": F.last("_known", ignorenulls=True).over(before)}],
        {name: F.when(F.col("_hit"), F.col("_hits_before") + F.col("_hits") - base).otherwise(0)}, **kw)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key as an aggregate: partial results shrink before the shuffle."""
    return _pick(df, keys, F.min_by, order)


def newest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, F.max_by, order)


def _pick(df: DataFrame, keys: Sequence[str], by, order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def gap_starts(
    df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], gap_seconds: float, **kw
) -> DataFrame:
    """Threshold islands: rows with no predecessor, or one more than the gap ago."""
    seen = ordered_columns(df, keys, ts, ties, lag={"_prev_ts": F.col(ts)}, **kw)
    quiet = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col("_prev_ts").cast("timestamp"))
    return seen.where(F.col("_prev_ts").isNull() | (quiet > int(gap_seconds * 1_000_000)))


def episodes(
    df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], active: Column, **kw
) -> DataFrame:
    """State islands: one row per run of ``active`` rows, its first, with ``ended_at``
    of the first inactive row after it (null while the run is open).

    An active row's end is the next inactive time, whatever lies between, so one
    pass finds starts and ends together.
    """
    flagged = df.withColumn("_on", F.coalesce(active, F.lit(False)))
    seen = ordered_columns(
        flagged, keys, ts, ties,
        lag={"_was_on": F.col("_on")},
        following={"ended_at": F.when(~F.col("_on"), F.col(ts))},
        **kw,
    )
    starts = F.col("_on") & ~F.coalesce("_was_on", F.lit(False))
    return seen.where(starts).drop("_on", "_was_on")
