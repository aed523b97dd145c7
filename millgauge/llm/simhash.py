"""SimHash near-duplicates through deletion-variant signatures.

Method: a 64-bit fingerprint is cut into three segments. Two fingerprints that differ in at
most four bits differ in at most one bit of some segment, so the signatures "segment with one
position blanked" of that segment meet in an equality join. Every met pair is verified on all
64 bits inside the join; connected components follow from the verified links.

Defined cases: null or word-free text has fingerprint zero and is linked like any other; rows
with a null id keep a row, and take the smallest id of their component (null if it has none);
repeated rows come back as often as they came in; an empty table gives an empty result. Columns
besides id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

BITS = 64
MAX_DIFFERENT = 4
SHINGLE_WORDS = 4
SEED = 42


def shingle_hashes(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """The hash of every word shingle of the whole text; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space are touched
    if not words:
        return np.zeros(0, dtype="<u8")
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())],
        dtype="<u8",
    )


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Majority bits over the hashes of all word shingles of the whole text."""
    return majority(shingle_hashes(text, width))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes; zero if there are none."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) with fp the fingerprint as a signed long."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"id": batch["id"], "fp": fps.view(np.int64)})

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return picked.mapInPandas(run, f"id {kind}, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def variant_masks(max_different: int = MAX_DIFFERENT) -> list[int]:
    """One mask per signature: a segment less one position, over the fewest segments that leave one bit."""
    segments = max_different // 2 + 1
    edges = [BITS * k // segments for k in range(segments + 1)]
    masks = []
    for lo, hi in zip(edges, edges[1:]):
        whole = ((1 << hi) - 1) ^ ((1 << lo) - 1)
        masks += [_signed(whole & ~(1 << bit)) for bit in range(lo, hi)]
    return masks


def links(prints: DataFrame) -> DataFrame:
    """(a, b) for all pairs of distinct fingerprints ``fp`` at most four bits apart, each pair once.

    A pair meets under several signatures; only the first of them, a function of the differing
    bits, lets it through, so the join makes no more rows than there are links. A fingerprint makes a
    row per signature, which Spark's estimate leaves out; so the join is never broadcast.
    """
    masks = variant_masks()
    segments = MAX_DIFFERENT // 2 + 1
    edges = [BITS * k // segments for k in range(segments + 1)]
    wholes = [_signed(((1 << hi) - 1) ^ ((1 << lo) - 1)) for lo, hi in zip(edges, edges[1:])]
    signed = prints.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(v).cast("short").alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("sig"))
                            for v, m in enumerate(masks)])).alias("s"),
    ).select("fp", "s.v", "s.sig")
    x = "(l.fp ^ r.fp)"
    first = " ".join(
        f"WHEN bit_count({x} & {whole}L) <= 1 THEN l.v = {lo} AND {x} & {whole}L = 0 "
        f"OR l.v BETWEEN {lo} AND {hi - 1} AND shiftright({x}, l.v) & 1L = 1 AND {x} & {whole}L <> 0"
        for whole, lo, hi in zip(wholes, edges, edges[1:])
    )
    met = f"l.v = r.v AND l.sig = r.sig AND l.fp < r.fp AND bit_count({x}) <= {MAX_DIFFERENT} AND CASE {first} ELSE false END"
    return signed.alias("l").join(signed.hint("merge").alias("r"), F.expr(met)).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Equal fingerprints are one node, so copies are never expanded into pairs; a third of all rows
    with one text is one node and a join key that adaptive execution splits.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "nodes")
    roots = components(links(nodes))
    labelled = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = written(labelled.join(least, "root").select(F.col("fp").alias("label_fp"), "component_id"), "labels")
    return prints.join(labels, prints.fp == labels.label_fp, "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
