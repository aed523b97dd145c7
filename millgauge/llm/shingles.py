"""Near-duplicates by the similarity of word shingles.

Method: a text is the set of its shingles of ``WIDTH`` words; two texts are near copies if their sets have a Jaccard similarity
of ``SIMILARITY`` or more. Pairs are met in two ways and compared by the sets themselves; groups are connected components of those that hold.

- SimHash: majority bits of the set make a fingerprint; all fingerprints at most four bits apart meet through the one-wildcard signatures
  of ``simhash.links``. Every pair of groups with such fingerprints is compared, none is left out.
- Bands, for similarities at which some ten bits differ: minima of the set under ``BANDS`` times ``ROWS`` hash functions are cut into
  bands; texts that agree in a band are compared with one text of that band.

Texts that the bands have put in one group are not compared again: a large group of near copies makes no pairs of fingerprints to read texts for.

Two texts of similarity 0.8 agree in some band with probability 1 - (1 - 0.8 ** ROWS) ** BANDS = 0.9993. In a band of more than two
texts, only pairs with its chosen text are compared, so that a group of any size makes no more rows than it has texts; the
choice differs between bands. Recall measured by ``tests/llm/test_shingles.py``.

Defined cases: case (A-Z) and white space do not count; a text of fewer words than a shingle is one shingle; texts without a word
(null too) are copies of each other; texts of equal words are one node; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .simhash import links, majority, shingle_hashes

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 6
ORDERS = 4  # in which the text of a band is chosen
SEED = 42

_draw = np.random.default_rng(SEED)
FLIPS, FACTORS = (_draw.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) for _ in range(2))
FACTORS |= np.uint64(1)


def bands(hashes: np.ndarray) -> list[int]:
    """A signed key for each band of minima of a set of hashes."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, ((hashes[at : at + 1024] ^ FLIPS) * FACTORS).min(axis=1))
    keys = [xxhash.xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.searchsorted(a, b)
    common = int((a[np.minimum(both, len(a) - 1)] == b).sum())
    return common / (len(a) + len(b) - common)


def near_copies(docs: DataFrame, id_col: str, text_col: str = "text", width: int = WIDTH, least: float = SIMILARITY) -> DataFrame:
    """(id, component) for every row of ``docs``; rows of one component are near copies."""
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes, keys, fps = [], [], []
            for text in batch["text"]:
                line = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
                hashes = np.unique(shingle_hashes(text, width))
                nodes.append(xxhash.xxh64_intdigest(line, SEED))
                keys.append(bands(hashes) if line else [])
                fps.append(majority(hashes))
            yield pd.DataFrame({"id": batch["id"], "node": np.array(nodes, dtype=np.uint64).view(np.int64), "keys": pd.Series(keys, dtype=object),
                                "fp": np.array(fps, dtype=np.uint64).view(np.int64)})

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = lru_cache(64)(lambda text: np.unique(shingle_hashes(text, width)))
        for batch in batches:
            held = [similarity(whole(x), whole(y)) >= least for x, y in zip(batch["x"], batch["y"])]
            yield batch.loc[np.array(held, dtype=bool), ["a", "b"]]

    prints = written(picked.mapInPandas(keyed, f"id {kind}, node bigint, keys array<bigint>, fp bigint"), "shingle-bands")
    nodes = written(prints.groupBy("node").agg(F.min("id").alias("number"), F.first("keys").alias("keys"), F.first("fp").alias("fp")), "shingle-nodes")

    def alike(pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs (a, b) of nodes whose texts are near copies."""
        met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        numbers = nodes.select("node", "number").join(met.hint("merge"), "node")  # files and arrays are larger in memory than Spark's estimate: no broadcast
        texts = written(picked.join(numbers, F.col("id") == F.col("number")).select("node", "text"), f"{name}-texts")
        both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")).hint("merge"), "b")
                .join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")).hint("merge"), "a").select("a", "b", "x", "y"))
        return written(both.mapInPandas(verified, "a bigint, b bigint"), f"{name}-alike")

    found = alike(banded(nodes), "shingle")
    roots = components(found)
    more = alike(fingerprinted(nodes, roots), "simhash")
    if not more.isEmpty():
        roots = components(found.union(more))
    return prints.select("id", "node").join(roots.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left").select(
        F.col("id").alias(id_col), F.coalesce("root", "node").alias("component"))


def banded(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes: the chosen text of every band with the others of it."""
    spread = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    order = F.xxhash64("node", F.col("band") % ORDERS)
    chosen = spread.groupBy("key").agg(F.min_by("node", order).alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return written(spread.join(chosen.hint("merge"), "key").where("a <> node").select("a", F.col("node").alias("b")).distinct(), "shingle-pairs")


def fingerprinted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different groups, equal fingerprints or such as differ in at most four bits: of every group and
    fingerprint one text, the one of the smallest node."""
    grouped = nodes.join(roots.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
    holders = written(grouped.groupBy("fp", F.coalesce("root", "node").alias("group")).agg(F.min("node").alias("node")), "simhash-holders")
    linked = written(links(holders.select("fp").distinct()), "simhash-links")
    several = holders.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    side = lambda c: holders.select(F.col("fp").alias(c), F.col("group").alias(f"{c}_group"), F.col("node").alias(f"{c}_node"))
    met = linked.union(several).join(side("a"), "a").join(side("b"), "b")
    met = met.where((F.col("a_group") < F.col("b_group")) | (F.col("a") != F.col("b")) & (F.col("a_group") != F.col("b_group")))
    return written(met.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct(), "simhash-pairs")
