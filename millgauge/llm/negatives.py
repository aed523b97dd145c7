"""Hard-negative mining with rotated one-bit codes and deterministic residual intervals.

Method: vectors are turned by a seeded random rotation (sign flips and Walsh-Hadamard steps) and cut to one bit a
component. Beside its code a vector keeps its length and its alignment, the cosine between it and its code vector. An
anchor is turned the same way and rounded to ``PLANES`` bit planes, so popcounts estimate its product with a code.
The rounding error and, by Cauchy-Schwarz, what the vector and the anchor have beside the code vector bound the true
product from both sides: no interval misses it. Rows whose interval reaches neither the window nor the best scores that
others are sure of are left out; the rest are scored in whole numbers. Codes are only a filter, results are exact.

Rows lie in blocks of about ``BLOCK_ROWS``; a block holds several small labels or a salted part of a large one. Anchors
look for positives only in blocks of their label, for negatives in all. Both searches have two rounds: about the square root of
the blocks first, whose kth scores the other blocks start with. A task holds one block and one slab of anchors.

Defined cases: rows with a null id, label or vector, or with null or non-finite components, take no part; an empty vector is
a zero vector and shorter ones are filled up with zeros; rows that repeat an id count once, as the smallest (vector, label);
ties go to the smaller id; components and scores beyond 64 bits stay at the ends of that range; an anchor without positives, or a
positive without negatives, gives no row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import written
from .nearest import EXACT, _packed, _unpacked

BLOCK_ROWS = 32768
SLAB_ROWS = 8192
PLANES = 6
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
SLACK = 1e-6  # far above the rounding of doubles, far below one step of a code
LONG = (-(1 << 63), (1 << 63) - 1)

BLOCK = "block int, ids binary, labels binary, points binary, kind string, words binary, norms binary, aligned binary"
POSITIVE = "anchor bigint, vec_id bigint, score bigint"
NEGATIVE = "anchor bigint, positive_score bigint, vec_id bigint, score bigint"


def turned(units: np.ndarray) -> np.ndarray:
    """Rows after a rotation that depends on the width alone, filled up to a power of two of at least 64."""
    width = max(64, 1 << max(0, units.shape[1] - 1).bit_length())
    out = np.zeros((len(units), width))
    out[:, : units.shape[1]] = units
    rng = np.random.default_rng(width)
    for _ in range(3):
        out *= rng.integers(0, 2, width) * 2.0 - 1.0
        half = 1
        while half < width:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(len(out), width)
            half *= 2
        out /= np.sqrt(width)
    return out


def _units(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((points.astype(float) ** 2).sum(axis=1))
    return points / np.where(norms > 0, norms, 1)[:, None], norms


def _bits(rows: np.ndarray) -> np.ndarray:
    return np.packbits(rows, axis=-1).view(np.uint64)


class Codes:
    """One block: rows in the order of label and id, their codes, lengths and alignments."""

    def __init__(self, row: pd.Series, width: int) -> None:
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.points = _unpacked(row["points"], row["kind"], width)
        self.words = np.frombuffer(row["words"], np.uint64).reshape(len(self.ids), -1)
        self.norms, self.aligned = np.frombuffer(row["norms"]), np.frombuffer(row["aligned"])
        self.beside = np.sqrt(np.maximum(0, 1 - self.aligned**2))
        self.ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        self.most = int(np.abs(self.points).max(initial=0))

    @staticmethod
    def pack(block: int, ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> dict:
        units, norms = _units(points)
        around = turned(units)
        aligned = np.minimum(1, np.abs(around).sum(axis=1) / np.sqrt(around.shape[1]))
        data, kind = _packed(points)
        return {"block": block, "ids": ids.tobytes(), "labels": labels.tobytes(), "points": data, "kind": kind,
                "words": _bits(around > 0).tobytes(), "norms": norms.tobytes(), "aligned": aligned.tobytes()}

    def label(self, value: int) -> slice:
        return slice(*np.searchsorted(self.labels, [value, value + 1]))

    def intervals(self, around: np.ndarray, length: float, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """Ends between which the product of an anchor with each of ``rows`` must lie."""
        root = np.sqrt(len(around))
        least, step = around.min(), (around.max() - around.min()) / (2**PLANES - 1) or 1.0
        levels = np.rint((around - least) / step).astype(np.uint8)
        rounded = least + step * levels
        total = np.zeros(rows.stop - rows.start)
        for j in range(PLANES):
            plane = _bits(levels >> j & 1)
            for word in np.flatnonzero(plane):
                total += float(1 << j) * np.bitwise_count(self.words[rows, word] & plane[word])
        along = (2 * (least * self.ones[rows] + step * total) - rounded.sum()) / root
        error = np.abs(around - rounded).sum() / root + 1e-12
        low, high = np.clip(along - error, -1, 1), np.clip(along + error, -1, 1)
        aligned, beside = self.aligned[rows], self.beside[rows]
        best, worst = np.clip(aligned, low, high), np.clip(-aligned, low, high)
        lengths = length * self.norms[rows]
        above = aligned * best + beside * np.sqrt(1 - best**2) + SLACK
        below = aligned * worst - beside * np.sqrt(1 - worst**2) - SLACK
        return below * lengths - SLACK, above * lengths + SLACK

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        reach = self.most * int(np.abs(anchor).max(initial=0)) * self.points.shape[1]
        kind = np.float64 if reach < EXACT else np.int64 if reach <= LONG[1] else object
        found = self.points[rows].astype(kind) @ anchor.astype(kind)
        if kind is object:
            found = np.array([min(max(x, LONG[0]), LONG[1]) for x in found], dtype=np.int64)
        return found.astype(np.int64)

    def best(self, rows: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
        """Places in ``rows`` of the best, ties to the smaller id."""
        return np.lexsort((self.ids[rows], -scores))[:count]


def _sure(below: np.ndarray, count: int) -> float:
    """A score that ``count`` rows reach at least."""
    return np.partition(below, len(below) - count)[len(below) - count] if len(below) >= count else -np.inf


def positives_in(codes: Codes, anchor: int, label: int, point: np.ndarray, around: np.ndarray, length: float,
                 floor: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of rows of the label that may be among the anchor's best."""
    rows = codes.label(label)
    below, above = codes.intervals(around, length, rows)
    others = codes.ids[rows] != anchor
    met = np.flatnonzero(others & (above >= max(floor, _sure(below[others], count)))) + rows.start
    found = codes.scores(met, point)
    met, found = met[found >= floor], found[found >= floor]
    top = codes.best(met, found, count)
    return codes.ids[met[top]], found[top]


def window_of(score: int, low: int = LOW_PERCENT, high: int = HIGH_PERCENT) -> tuple[int, int]:
    """Least and greatest whole score n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def negatives_in(codes: Codes, label: int, point: np.ndarray, around: np.ndarray, length: float, windows: list[tuple[int, int]],
                 count: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each window (least, greatest) its number, and ids and scores of rows of other labels that may be among its best."""
    below, above = codes.intervals(around, length, slice(0, len(codes.ids)))
    other = np.ones(len(codes.ids), bool)
    other[codes.label(label)] = False
    reached = np.zeros(len(codes.ids), bool)
    for least, greatest in windows:
        inside = below[other & (below >= least) & (above <= greatest)]
        reached |= (above >= max(least, _sure(inside, count))) & (below <= greatest)
    met = np.flatnonzero(reached & other)
    found = codes.scores(met, point)
    for number, (least, greatest) in enumerate(windows):
        fits = np.flatnonzero((found >= least) & (found <= greatest))
        top = fits[codes.best(met[fits], found[fits], count)]
        yield number, codes.ids[met[top]], found[top]


def _usable(vector: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: fine(x.cast("double")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _block_of(label: Column, salt: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(label, salt.cast("bigint")), F.lit(count)).cast("int")


def _ranked(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _rounds(blocks: DataFrame, rounds: int, visits: Callable[[int, DataFrame | None], DataFrame], search, schema: str, name: str) -> DataFrame:
    """Rows found by ``search`` in all rounds; ``visits(number, found so far)`` gives the anchors, each with the blocks it goes to."""
    found = None
    for number in range(rounds):
        going = visits(number, found).withColumn("block", F.explode("places")).drop("places")
        met = going.select(F.col("block").alias("to_block"), F.col("slab").alias("to_slab")).distinct()
        sent = blocks.join(met, F.col("block") == F.col("to_block")).drop("to_block")
        got = written(sent.groupBy("block", "to_slab").cogroup(going.groupBy("block", "slab")).applyInPandas(search, schema), name)
        found = got if found is None else found.union(got)
    return found


def mine(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT,
         block_rows: int = BLOCK_ROWS, slab_rows: int = SLAB_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) by the product of floor(256 x).

    Labels that are not whole numbers are told apart by a 64-bit hash.
    """
    vector, label = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`")
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    kind = F.xxhash64(label) if not isinstance(vectors.schema[label_col].dataType, T.IntegralType) else label.cast("bigint")
    rows = (vectors.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & _usable(vector))
            .select(F.col(f"`{id_col}`").cast("bigint").alias("id"), is_anchor.alias("asks"), whole.alias("v"), kind.alias("label"))
            .groupBy("id").agg(F.min(F.struct("v", "label")).alias("row"), F.max("asks").alias("asks"))
            .select("id", "asks", "row.v", "row.label"))
    rows = written(rows, "labelled-vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.count(F.when(F.col("asks"), 1)).alias("anchors")).first()
    width, count = size.width or 1, max(1, -(-size.n // block_rows))
    slabs = max(1, -(-size.anchors // slab_rows))
    parts = rows.groupBy("label").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    placed = rows.join(parts, "label").withColumn("block", _block_of(F.col("label"), F.pmod(F.xxhash64("id"), F.col("parts")), count))

    def encode(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["label", "id"])
        points = _matrix(held["v"], width)
        return pd.DataFrame([Codes.pack(int(held["block"].iloc[0]), held["id"].to_numpy(np.int64), held["label"].to_numpy(np.int64), points)])

    blocks = written(placed.groupBy("block").applyInPandas(encode, BLOCK), "codes")
    anchors = written(placed.where("asks").select(F.col("id").alias("anchor"), "label", "v", "parts", F.pmod(F.xxhash64("id"), F.lit(slabs)).alias("slab")), "anchors")

    def arrived(block: pd.DataFrame, going: pd.DataFrame):
        if len(block) and len(going):
            codes, points = Codes(block.iloc[0], width), _matrix(going["v"], width)
            units, lengths = _units(points)
            yield from zip(going.itertuples(), points, turned(units), lengths, [codes] * len(going))

    def look_for_positives(block: pd.DataFrame, going: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row, point, around, length, codes in arrived(block, going):
            ids, scores = positives_in(codes, row.anchor, row.label, point, around, length, row.floor, positives)
            out.append(pd.DataFrame({"anchor": row.anchor, "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"anchor": [], "vec_id": [], "score": []}, dtype="int64")

    def look_for_negatives(block: pd.DataFrame, going: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row, point, around, length, codes in arrived(block, going):
            wanted = [(max(least, int(f)), greatest) for (least, greatest), f in
                      ((window_of(int(p), low, high), f) for p, f in zip(row.wanted, row.floors))]
            for number, ids, scores in negatives_in(codes, row.label, point, around, length, wanted, negatives):
                out.append(pd.DataFrame({"anchor": row.anchor, "positive_score": row.wanted[number], "vec_id": ids, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"anchor": [], "positive_score": [], "vec_id": [], "score": []}, dtype="int64")

    def part_of(places: Column, number: int, count: int | Column) -> Column:
        """The first square root of the places, or the others."""
        first = F.ceil(F.sqrt(F.lit(count))).cast("int") if isinstance(count, int) else F.ceil(F.sqrt(count)).cast("int")
        return F.slice(places, F.lit(1), first) if number == 0 else F.slice(places, first + 1, F.greatest(F.size(places) - first, F.lit(0)))

    def label_visits(number: int, found: DataFrame | None) -> DataFrame:
        own = F.array_distinct(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda s: _block_of(F.col("label"), s, count)))
        going = anchors.withColumn("places", part_of(own, number, F.col("parts"))).drop("parts")
        if found is None:
            return going.withColumn("floor", F.lit(LONG[0]))
        known = _ranked(found, ["anchor"], positives).where(F.col("rank") == positives).select("anchor", F.col("score").alias("kth"))
        return going.join(known, "anchor", "left").withColumn("floor", F.coalesce("kth", F.lit(LONG[0]))).drop("kth")

    near = _rounds(blocks, 1 if count == 1 else 2, label_visits, look_for_positives, POSITIVE, "positives")
    near = written(_ranked(near, ["anchor"], positives).drop("rank"), "positives")
    wanted = near.where("score >= 0").select("anchor", F.col("score").alias("p")).distinct()

    def all_visits(number: int, found: DataFrame | None) -> DataFrame:
        every = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda b: F.pmod(b + F.col("slab"), F.lit(count)).cast("int"))
        floors = wanted.withColumn("f", F.lit(LONG[0]))
        if found is not None:
            known = (_ranked(found, ["anchor", "positive_score"], negatives).where(F.col("rank") == negatives)
                     .select("anchor", F.col("positive_score").alias("p"), F.col("score").alias("kth")))
            floors = wanted.join(known, ["anchor", "p"], "left").select("anchor", "p", F.coalesce("kth", F.lit(LONG[0])).alias("f"))
        asked = floors.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("p", "f"))).alias("asked"))  # at most ``positives`` of an anchor
        return (anchors.join(asked, "anchor").withColumn("places", part_of(every, number, count))
                .select("anchor", "label", "v", "slab", "places", F.col("asked.p").alias("wanted"), F.col("asked.f").alias("floors")))

    far = _rounds(blocks, 1 if count == 1 else 2, all_visits, look_for_negatives, NEGATIVE, "negatives")
    hard = _ranked(far, ["anchor", "positive_score"], negatives).select(
        F.col("anchor").alias("of"), "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return near.join(hard, (F.col("anchor") == F.col("of")) & (F.col("score") == F.col("positive_score"))).select(
        F.col("anchor").alias("anchor_id"), F.col("vec_id").alias("positive_id"), "rank", "negative_id", "positive_score", "negative_score")
