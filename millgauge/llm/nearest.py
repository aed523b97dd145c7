"""Exact top-k search by inner product with one KD-tree per shard.

Method: vectors are spread over shards by a hash of their id. A shard orders its vectors into a
KD-tree: median splits along the widest side, tight boxes around every node. A query takes nodes
from a queue, best bound first; the bound of a box is the largest inner product any point in it
could reach. It stops when the best bound is below its kth score. The kth score a query reached in
its own shard is carried to all other shards, where the search starts with it. Blocks of queries
meet blocks of shards in a co-group; what a task holds is one shard and ``BLOCKS_AT_ONCE`` blocks of queries.

Where sums could leave the exact range of doubles, scores are computed in 64-bit integers and
bounds are not used.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, and neither
do rows with a null id; rows that repeat an id count once, with the smallest of their vectors; shorter vectors are
filled up with zeros; ties go to the smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import written

SHARD_ROWS = 16384
LEAF_ROWS = 256
BLOCKS_AT_ONCE = 32
TOP = 20
SCALE = 64
EXACT = 2.0**53


class Tree:
    """Points in leaf order; node (start, end) splits in the middle, so the shape follows from the count."""

    def __init__(self, ids: np.ndarray, points: np.ndarray) -> None:
        self.ids, self.points = ids, points
        self.spans, self.children = [], []
        stack = [(0, len(ids), -1)]
        while stack:
            start, end, parent = stack.pop()
            if parent >= 0:
                self.children[parent].append(len(self.spans))
            here = len(self.spans)
            self.spans.append((start, end))
            self.children.append([])
            if end - start > LEAF_ROWS:
                middle = (start + end) // 2
                stack += [(start, middle, here), (middle, end, here)]
        self.low = np.array([points[a:b].min(axis=0) for a, b in self.spans])
        self.high = np.array([points[a:b].max(axis=0) for a, b in self.spans])

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray) -> Tree:
        order = np.argsort(ids, kind="stable")
        stack = [(0, len(ids))]
        while stack:
            start, end = stack.pop()
            if end - start > LEAF_ROWS:
                part = points[order[start:end]]
                side = int((part.max(axis=0) - part.min(axis=0)).argmax())
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(part[:, side], middle)]
                stack += [(start, start + middle), (start + middle, end)]
        return cls(ids[order], points[order])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its number, and ids and scores that may belong to its top; ``kth``: scores below need not be found."""
        reach = max(abs(float(x)) for x in (self.low.min(), self.high.max())) * float(np.abs(queries).max(initial=0))
        exact = reach * queries.shape[1] < EXACT
        points = self.points.astype(np.float64 if exact else np.int64)
        queries = queries.astype(points.dtype)
        if exact:
            bounds = np.maximum(queries, 0) @ self.high.T.astype(float) + np.minimum(queries, 0) @ self.low.T.astype(float)
        else:
            bounds = np.full((len(queries), len(self.spans)), np.inf)
        for number, (own, query) in enumerate(zip(query_ids, queries)):
            ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
            least = kth[number]
            queue = [(-bounds[number, 0], 0)]
            while queue and -queue[0][0] >= least:
                _, node = heapq.heappop(queue)
                if self.children[node]:
                    for child in self.children[node]:
                        if bounds[number, child] >= least:
                            heapq.heappush(queue, (-bounds[number, child], child))
                    continue
                start, end = self.spans[node]
                found = points[start:end] @ query
                keep = np.flatnonzero((found >= least) & (self.ids[start:end] != own))
                if not len(keep):
                    continue
                ids = np.concatenate((ids, self.ids[start:end][keep]))
                scores = np.concatenate((scores, found[keep].astype(np.int64)))
                if len(ids) > top:
                    best = np.lexsort((ids, -scores))[:top]
                    ids, scores = ids[best], scores[best]
                if len(ids) == top:
                    least = max(least, scores.min())
            yield number, ids, scores


def _usable(vector: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: fine(x.cast("double")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _packed(points: np.ndarray) -> tuple[bytes, str]:
    most = np.abs(points).max(initial=0)
    kind = next((k for k in ("int8", "int16", "int32") if most <= np.iinfo(k).max), "int64")
    return points.astype(kind).tobytes(), kind


def _unpacked(data: bytes, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=kind).reshape(-1, width).astype(np.int64)


def top_products(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``top`` rows with the largest inner product of floor(64 x)."""
    vector = F.col(f"`{vector_col}`")
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    rows = (vectors.where(F.col(f"`{id_col}`").isNotNull() & _usable(vector))
            .select(F.col(f"`{id_col}`").cast("bigint").alias("id"), is_query.alias("asks"), whole.alias("v"))
            .groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")))
    rows = written(rows, "vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = size.width or 1

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        held = [batch for batch in batches if len(batch)]
        if not held:
            return
        data = pd.concat(held, ignore_index=True)
        ids, points = data["id"].to_numpy(np.int64), _matrix(data["v"], width)
        tree = Tree.build(ids, points)
        packed, kind = _packed(tree.points)
        asks = np.flatnonzero(data["asks"].to_numpy(bool))
        queries, query_kind = _packed(points[asks])
        out = {"shard": shard, "ids": tree.ids.tobytes(), "points": packed, "kind": kind,
               "query_ids": ids[asks].tobytes(), "queries": queries, "query_kind": query_kind}
        kth = np.full(len(asks), -np.inf)
        hits = []
        for number, found, scores in tree.search(ids[asks], points[asks], kth, top):
            if len(found) == top:
                kth[number] = scores.min()
            hits += [{"query_id": int(ids[asks[number]]), "vec_id": int(i), "score": int(s)} for i, s in zip(found, scores)]
        yield pd.DataFrame([out | {"kth": kth.tobytes(), "hits": hits}])

    schema = ("shard int, ids binary, points binary, kind string, query_ids binary, queries binary, query_kind string, kth binary, "
              "hits array<struct<query_id: bigint, vec_id: bigint, score: bigint>>")
    shards = written(rows.repartition(max(1, -(-size.n // shard_rows)), "id").mapInPandas(build, schema), "shards")
    names = sorted(r.shard for r in shards.select("shard").collect())  # one number a shard
    each = lambda numbers: F.explode(F.array(*map(F.lit, sorted(numbers))).cast("array<int>"))
    slab = F.floor(F.col("shard") / BLOCKS_AT_ONCE).cast("int")
    trees = shards.select("shard", "ids", "points", "kind", each({n // BLOCKS_AT_ONCE for n in names}).alias("slab"))
    blocks = shards.where(F.length("query_ids") > 0).select(
        F.col("shard").alias("home"), slab.alias("slab"), "query_ids", "queries", "query_kind", "kth",
        each(names).alias("shard")).where("shard <> home")

    def meet(tree_rows: pd.DataFrame, block_rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(tree_rows) and len(block_rows):
            row = tree_rows.iloc[0]
            tree = Tree(np.frombuffer(row["ids"], np.int64), _unpacked(row["points"], row["kind"], width))
            for block in block_rows.itertuples():
                ids = np.frombuffer(block.query_ids, np.int64)
                queries = _unpacked(block.queries, block.query_kind, width)
                for number, found, scores in tree.search(ids, queries, np.frombuffer(block.kth), top):
                    out.append(pd.DataFrame({"query_id": ids[number], "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    met = trees.groupBy("shard", "slab").cogroup(blocks.groupBy("shard", "slab")).applyInPandas(meet, "query_id bigint, vec_id bigint, score bigint")
    found = shards.select(F.explode("hits").alias("h")).select("h.query_id", "h.vec_id", "h.score").union(met)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
