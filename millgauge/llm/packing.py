"""Best-fit packing of tokenised documents into sequences of fixed length.

Method: bulk-synchronous best fit. Documents are cut into pieces of at most ``CAPACITY`` tokens.
Pieces are sorted by length with a range partitioning (ties by row, so one common length spreads
over many partitions) and numbered within their length. Rounds then match pieces and gaps, both
in order of size: each piece goes for the successor of its length among the gaps, conflicts over
a gap are settled by rank (longer first), gaps shrink, and the losers go on in the next round.
Pieces without a gap open new sequences. Since equal lengths are interchangeable, a round works on
runs "so many pieces of this length" and "so many gaps of this size": at most ``CAPACITY`` of each
whatever the number of documents, so the rounds need no further pass over the rows. Every row then
finds its own place from its number within its length, in one pass on the executors.

Defined cases: null text is empty text and holds only the end mark; an empty table gives an empty
result; repeated rows are packed each on their own, rows with a null id too; a text longer than a
sequence is cut, the first piece takes what is over; a text with a very long run of white space goes through ``tokenizers`` itself; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k"

# The splitting pattern of this vocabulary. The short form equals it for texts in which no
# two white-space characters meet, and runs faster.
SHORT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
LONG_SPACES = r"\s{10000}"  # runs on which the look-ahead of the whole pattern would use up the stack of its engine


def vocabulary_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(f"{name}.tiktoken")


def encoder(path: str):
    """text -> ids as little-endian 32-bit bytes; the ids are those of the library ``tokenizers`` with the same vocabulary."""
    import re
    import sys

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    short, full = (tiktoken.Encoding("pieces", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
                   for p in (SHORT_PATTERN, public_tokenizers.PATTERN))
    meet, long = re.compile(r"\s\s").search, re.compile(LONG_SPACES).search
    assert array("I").itemsize == 4 and sys.byteorder == "little"

    def slow(text: str) -> list[int]:
        from tokenizers import Tokenizer  # few texts need it; workers without them stay small

        tokenizer = Tokenizer.from_file(path.removesuffix(".tiktoken") + ".json")
        tokenizer.encode_special_tokens = True
        return tokenizer.encode(text, add_special_tokens=False).ids

    def encode(text: str) -> bytes:
        spaced = meet(text)
        return array("I", (short if not spaced else slow if long(text) else full)(text)).tobytes()

    return encode


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32) and, if asked for, ids (32-bit little-endian) for each piece."""
    path = path or vocabulary_path()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"], batch["text"]):
                ids = (encode(text) if text else b"") + end
                count = len(ids) // 4
                edges = [0, *range(count % capacity or capacity, count + 1, capacity)]
                for number, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[4 * a : 4 * b]
                    rows.append((key, number, a, b - a, zlib.crc32(part), *([part] if keep_ids else ())))
            out = pd.DataFrame(rows, columns=names)
            out["id"] = out["id"].astype(batch["id"].dtype)
            yield out

    names = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return picked.mapInPandas(run, schema)


def numbered(rows: DataFrame) -> DataFrame:
    """Rows range-sorted by length, with ``part`` and ``idx``, the number within the length and partition."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, count = None, 0
        for batch in batches:
            length = batch["length"].to_numpy()
            first = np.flatnonzero(np.diff(length, prepend=-1))
            idx = np.arange(len(length)) - np.repeat(first, np.diff(np.append(first, len(length))))
            if len(length):
                head = length == length[0]
                head[int(head.argmin()) if not head.all() else len(head) :] = False
                idx[head] += count if length[0] == last else 0
                last, count = length[-1], int(idx[-1]) + 1
            yield batch.assign(idx=idx)

    ranged = rows.repartitionByRange("length", "uid").sortWithinPartitions("length", "uid").withColumn("part", F.spark_partition_id())
    return ranged.mapInPandas(number, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema) + ", idx bigint")


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rounds of best fit over runs: (length, first rank, count, first sequence, offset), and the number of sequences."""
    left = {n: k for n, k in counts.items() if k}
    rank: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = {}  # size of gap -> (first sequence, count)
    runs, opened = [], 0
    while left:
        sizes = sorted(gaps)
        wanted: dict[int, list[int]] = defaultdict(list)
        homeless = 0
        for length in sorted(left, reverse=True):
            k = int(np.searchsorted(sizes, length))
            if k < len(sizes):
                wanted[sizes[k]].append(length)
            else:
                homeless += length * left[length]
        if homeless:
            more = -(-homeless // capacity)
            gaps.setdefault(capacity, []).append((opened, more))
            opened += more
        shrunk = []
        for size, lengths in wanted.items():
            free = gaps.pop(size)
            for length in lengths:
                while free and left[length]:
                    first, count = free.pop()
                    taken = min(count, left[length])
                    runs.append((length, rank[length], taken, first, capacity - size))
                    shrunk.append((size - length, first, taken))
                    rank[length] += taken
                    left[length] -= taken
                    if taken < count:
                        free.append((first + taken, count - taken))
                if not left[length]:
                    del left[length]
                if not free:
                    break
            if free:
                gaps[size] = free
        for size, first, count in shrunk:
            if size:
                gaps.setdefault(size, []).append((first, count))
    return runs, opened


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, [ids], sequence_id, offset."""
    spark = docs.sparkSession
    cut = written(pieces(docs, id_col, text_col, capacity, path, keep_ids).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    ranged = written(numbered(cut.where(F.col("length") < capacity)), "ranged-pieces")
    held = ranged.groupBy("length", "part").agg(F.count("*").alias("n")).toPandas().sort_values(["length", "part"])
    held["before"] = held.groupby("length")["n"].cumsum() - held["n"]
    runs, opened = sweep({int(k): int(n) for k, n in held.groupby("length")["n"].sum().items()}, capacity)
    runs.sort()
    table = np.array(runs, dtype=np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast((
        (held["length"].to_numpy(np.int64) << 32) + held["part"].to_numpy(np.int64), held["before"].to_numpy(np.int64),
        (table[:, 0] << 48) + table[:, 1], table,
    ))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups, before, keys, runs_of = shared.value
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            rank = batch["idx"].to_numpy(np.int64) + before[np.searchsorted(groups, (length << 32) + batch["part"].to_numpy(np.int64))]
            run = runs_of[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            yield batch[kept].assign(sequence_id=run[:, 3] + rank - run[:, 1], offset=run[:, 4])

    kept = [c for c in cut.columns if c != "uid"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema if f.name != "uid") + ", sequence_id bigint, offset bigint"
    whole = cut.where(F.col("length") == capacity).select(
        *kept, (F.col("uid") + F.lit(opened)).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return ranged.mapInPandas(place, schema).union(whole).withColumnRenamed("id", id_col)
