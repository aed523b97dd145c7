"""Source divergence audit with hash-consed segment trees over term ids.

Method: the kept terms of a language get an id, a chunk and a place in it, frequent terms first. For every group (language and
source) a segment tree stands over the places of a chunk; leaves are counts. Trees are built level by level for all groups of a task
at once, and a node is known by its pair of children, so equal count subtrees are one node wherever they stand, in whichever group.
The trees of two groups are walked together: each level holds the distinct node pairs met, leaf pairs are priced once, and prices are
summed on the way back. Chunk prices add up to the divergence of the two groups. The same leaf pairs of a group and its language
name the terms that stand out.

Rows are counted where they are read; what is shuffled are distinct (language, source, term). A task holds the counts of one chunk of about
``CHUNK_TERMS`` terms for two blocks of about ``SOURCES_AT_ONCE`` sources. Ids come from windows over one chunk, no vocabulary is
gathered anywhere.

All arithmetic is in whole numbers. Defined cases: null text, lang and source count as empty; a group without terms and a language
without kept terms have prices all the same; repeated rows are documents of their own; ties go to the smaller item in UTF-8; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import written

MIN_DOCS = 3
UNIT = 10**9
TOP_TERMS = 200
CHUNK_TERMS = 8192
SOURCES_AT_ONCE = 64
FLUSH_TERMS = 200_000
PIECE_BYTES = 1 << 22

# Bytes outside terms become spaces and A-Z becomes a-z; bytes of other letters stay.
FOLDED = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))
PRICED = "lang string, part string, source string, item string, chunk int, place int, value bigint"


def terms_of(text: str) -> Iterator[list[bytes]]:
    """Terms in order, in lists of bounded length."""
    data = text.encode("utf-8", "replace").translate(FOLDED)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + PIECE_BYTES) if len(data) - start > PIECE_BYTES else -1
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flushed() -> pd.DataFrame:
        rows = [(*group, term.decode(), n, docs[term]) for group, (counts, docs) in held.items() for term, n in counts.items()]
        held.clear()
        return pd.DataFrame(rows, columns=["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(counts), set()
            for words in terms_of(text):
                counts.update(words)
                seen.update(words)
            docs.update(seen)
            size += len(counts) - before
            if size > FLUSH_TERMS:
                yield flushed()
                size = 0
    yield flushed()


class Forest:
    """Segment trees over the columns of ``counts``, one for each row, with all equal subtrees shared."""

    def __init__(self, counts: np.ndarray) -> None:
        width = 1 << max(0, counts.shape[1] - 1).bit_length()
        filled = np.zeros((len(counts), width), np.int64)
        filled[:, : counts.shape[1]] = counts
        self.values, nodes = np.unique(filled, return_inverse=True)
        nodes = nodes.reshape(filled.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # children of the nodes, the lowest level first
        kinds = len(self.values)
        while nodes.shape[1] > 1:
            children, up = np.unique(nodes[:, 0::2] * kinds + nodes[:, 1::2], return_inverse=True)
            self.levels.append((children // kinds, children % kinds))
            nodes, kinds = up.reshape(len(counts), -1), len(children)
        self.roots = nodes[:, 0]

    def priced(self, first: int, others: np.ndarray, price) -> np.ndarray:
        """Sum of ``price(other, left values, right values)`` over all places, for the tree ``first`` against each of ``others``.

        Unfilled places are not taken out; the caller does that.
        """
        which = np.arange(len(others))
        left, right = np.full(len(others), self.roots[first]), self.roots[others]
        back = []
        for a, b in reversed(self.levels):
            met = np.concatenate((left, left)), np.concatenate((right, right)), np.concatenate((which, which))
            half = len(left)
            met[0][:half], met[0][half:] = a[left], b[left]
            met[1][:half], met[1][half:] = a[right], b[right]
            span = int(max(met[0].max(), met[1].max())) + 1
            pairs, inverse = np.unique((met[2] * span + met[0]) * span + met[1], return_inverse=True)
            right, rest = pairs % span, pairs // span
            left, which = rest % span, rest // span
            back.append(inverse)
        prices = price(which, left, right)
        for inverse in reversed(back):
            half = len(inverse) // 2
            prices = prices[inverse[:half]] + prices[inverse[half:]]
        return prices


def shares(counts: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / (total + kinds))."""
    whole = total + kinds
    if (int(counts.max(initial=0)) + 1) * UNIT < 1 << 63:
        return 1 + UNIT * (counts.astype(np.int64) + 1) // whole
    return np.array([1 + UNIT * (int(c) + 1) // whole for c in counts], dtype=np.int64)


def _prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _group_prices(groups: pd.DataFrame, cells: pd.DataFrame, i: int, j: int, top: int) -> list[tuple]:
    """Rows (part, source, item, place, value) of one chunk for the sources of block i against those of block j."""
    groups = groups.drop_duplicates("source").sort_values("source").reset_index(drop=True)
    names, own = groups["source"].to_numpy(), groups["own"].to_numpy()
    kinds = int(groups["kinds"].iloc[0])
    width = int(cells["place"].max()) + 1 if len(cells) else 1
    width = max(width, int(groups["width"].iloc[0]))
    counts = np.zeros((len(names), width), np.int64)
    rows = pd.Index(names).get_indexer(cells["source"])
    counts[rows, cells["place"].to_numpy(np.int64)] = cells["n"].to_numpy(np.int64)
    forest = Forest(counts)
    tables = [shares(forest.values, int(total), kinds) if kinds else np.ones(len(forest.values), np.int64) for total in groups["total"]]
    filled = (1 << len(forest.levels)) - (width if kinds else 0)  # places that stand for no term
    zero = int(np.searchsorted(forest.values, 0))
    out = []
    others = np.flatnonzero(own == j)
    for k in np.flatnonzero(own == i):
        against = others[others != k]
        if not len(against):
            continue
        table = np.stack([tables[s] for s in against])
        price = lambda which, a, b: _prices(tables[k][a], table[which, b])  # noqa: B023, E731
        found = forest.priced(k, against, price)
        if filled:
            found = found - filled * price(np.arange(len(against)), np.full(len(against), zero), np.full(len(against), zero))
        out += [("pair", names[k], names[s], None, int(x)) for s, x in zip(against, found)]
    if i == j and kinds:
        totals = shares(cells["sum"].to_numpy(np.int64), int(groups["whole"].iloc[0]), kinds)
        for k, name in enumerate(names):
            mine = np.flatnonzero(rows == k)
            n = cells["n"].to_numpy(np.int64)[mine]
            p, q = shares(n, int(groups["total"].iloc[k]), kinds), totals[mine]
            mine, value = mine[p > q], _prices(p, q)[p > q]
            if len(value) > top:
                least = np.partition(value, len(value) - top)[len(value) - top]
                mine, value = mine[value >= least], value[value >= least]
            out += [("term", name, None, int(x), int(y)) for x, y in zip(cells["place"].to_numpy()[mine], value)]
    return out


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
          top_terms: int = TOP_TERMS, chunk_terms: int = CHUNK_TERMS, sources_at_once: int = SOURCES_AT_ONCE) -> DataFrame:
    """(lang, source, part, item, value, rank): each group's divergence from every other source of its language, and its most divergent terms."""
    whole = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    read = docs.select(whole(lang_col).alias("lang"), whole(source_col).alias("source"), whole(text_col).alias("text"))
    counted = read.mapInPandas(_counted, "lang string, source string, term string, n bigint, docs bigint")
    counts = written(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("sum"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = written(kept.select("lang", "term", "sum"), "kept-terms")
    names = read.select("lang", "source").distinct()
    sizes = (names.groupBy("lang").agg(F.ceil(F.count("*") / sources_at_once).cast("int").alias("sides"))
             .join(kept.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("sum").alias("whole")), "lang", "left").na.fill(0, ["kinds", "whole"])
             .withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("kinds") / chunk_terms)).cast("int")))
    sizes = written(sizes, "languages")
    inside = Window.partitionBy("lang", "chunk").orderBy(F.desc("sum"), "term")
    placed = (kept.join(sizes.select("lang", "chunks"), "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int"))
              .withColumn("place", F.row_number().over(inside) - 1).drop("chunks"))
    placed = written(placed, "placed-terms")
    cells = written(counts.select("lang", "source", "term", "n").join(placed, ["lang", "term"]).drop("term"), "cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = names.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(sizes, "lang")
    widths = placed.groupBy("lang", "chunk").agg(F.count("*").cast("int").alias("width"))
    of_chunk = (groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                .join(widths, ["lang", "chunk"], "left").na.fill(0, ["width"]))
    counted_cells = cells.join(sizes.select("lang", "sides"), "lang")

    def price(key: tuple, group_rows: pd.DataFrame, cell_rows: pd.DataFrame) -> pd.DataFrame:
        lang, chunk, i, j = key
        found = _group_prices(group_rows, cell_rows, i, j, top_terms) if len(group_rows) else []
        out = pd.DataFrame(found, columns=["part", "source", "item", "place", "value"])
        return out.assign(lang=lang, chunk=chunk)[["lang", "part", "source", "item", "chunk", "place", "value"]].astype({"place": "Int32", "value": "int64"})

    keys = ["lang", "chunk", "i", "j"]
    met = _sides(of_chunk).groupBy(*keys).cogroup(_sides(counted_cells).groupBy(*keys)).applyInPandas(price, PRICED)
    priced = written(met, "priced")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    pairs = priced.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    terms = (priced.where("part = 'term'").drop("item").withColumn("best", F.rank().over(by_value)).where(F.col("best") <= top_terms)
             .join(placed.select("lang", "chunk", "place", F.col("term").alias("item")), ["lang", "chunk", "place"]))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.select("lang", "source", "part", "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs).union(ranked(terms).where(F.col("rank") <= top_terms))


def _sides(rows: DataFrame) -> DataFrame:
    """Rows copied to every pair of source blocks that holds their own."""
    own = F.pmod(F.xxhash64("source"), F.col("sides")).cast("int")
    every = F.sequence(F.lit(0), F.col("sides") - 1)
    pair: Column = F.array_distinct(F.concat(F.transform(every, lambda x: F.struct(F.col("own").alias("i"), x.alias("j"))),
                                             F.transform(every, lambda x: F.struct(x.alias("i"), F.col("own").alias("j")))))
    return rows.withColumn("own", own).withColumn("to", F.explode(pair)).withColumns({"i": F.col("to.i"), "j": F.col("to.j")}).drop("to", "sides")
