"""WARC fixity audit with Merkle trees over offset ranges.

Method: every record is hashed as it stands in its archive. The leaves of an archive are gathered by
ordered ranges of offsets into nodes, those by ``FANOUT`` into wider ranges, up to one root for each archive.
Two replicas are compared from the roots down: a level is read only below ranges that differ, until the records
that are altered, missing or extra remain. Hashing, trees and descent are DataFrame functions; a task
never holds more than one range, and windows run over the lengths of one archive of about ``ARCHIVE_BYTES``.

Defined cases: null urls and html count as empty, a null id as no id; repeated rows are records of their own; an empty
replica lacks every record; two empty ones agree; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import written

ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 64 << 10
FANOUT = 16


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    """Text of a WARC resource record."""
    text = F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length(text).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, text, F.lit("\r\n\r\n"))


def _placed(rows: DataFrame, archive_bytes: int) -> DataFrame:
    """Stored rows (row, length, ...) with their archive and offset, in the order of the rows."""
    total = rows.agg(F.sum("length").alias("n")).first()["n"] or 0
    count = max(1, -(-total // archive_bytes))
    before = Window.partitionBy("archive").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("archive", F.pmod(F.xxhash64("row"), F.lit(count)))
            .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, offset, length, record_id, url, body): pages laid out as records of archives, in the order of the table.

    A stored row number spreads rows evenly, repeated ones included.
    """
    rows = written(pages.select(F.col(f"`{id_col}`").alias("record_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{body_col}`").alias("body"))
                   .withColumn("row", F.monotonically_increasing_id()), "records")
    lengths = rows.select("row", F.octet_length(warc_record(F.col("record_id"), F.col("url"), F.col("body"))).cast("bigint").alias("length"))
    placed = _placed(lengths, archive_bytes).withColumnRenamed("row", "placed_row")
    return rows.join(placed, F.col("row") == F.col("placed_row")).select("archive", "offset", "length", "record_id", "url", "body")


def inventory(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", archive_bytes: int = ARCHIVE_BYTES,
              **copies: Column) -> DataFrame:
    """(archive, offset, length, record_id, digest, ...): records hashed where they are read, each body once; no body is stored or shuffled.

    ``copies`` are bodies that replicas hold at the same places; each adds a column of its name with the digest of that record.
    """
    key, url, body = (F.col(f"`{c}`") for c in (id_col, url_col, body_col))
    digest = lambda of: F.sha2(warc_record(key, url, of).cast("binary"), 256)
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.octet_length(warc_record(key, url, body)).cast("bigint").alias("length"),
                        key.alias("record_id"), digest(body).alias("digest"), *[digest(c).alias(name) for name, c in copies.items()])
    return _placed(written(rows, "inventory"), archive_bytes).drop("row")


def leaves(records: DataFrame) -> DataFrame:
    """(archive, offset, record_id, digest) of a replica."""
    if "digest" in records.columns:
        return records.select("archive", "offset", "record_id", "digest")
    text = warc_record(F.col("record_id"), F.col("url"), F.col("body"))
    return records.select("archive", "offset", "record_id", F.sha2(text.cast("binary"), 256).alias("digest"))


def _gathered(rows: DataFrame, place: str, width: int) -> DataFrame:
    """Nodes (archive, node, hash) over ordered ranges of ``width`` of the places below."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(place).alias("place"), F.col("hash"))))
    line = F.array_join(F.transform(parts, lambda p: F.concat_ws(":", p["place"].cast("string"), p["hash"])), ",")
    return rows.groupBy("archive", F.floor(F.col(place) / width).cast("bigint").alias("node")).agg(F.sha2(line, 256).alias("hash"))


def tree(leaf_rows: DataFrame, levels: int) -> list[DataFrame]:
    """Levels of nodes, the narrowest ranges first; the last holds one root for each archive."""
    out = [written(_gathered(leaf_rows.withColumnRenamed("digest", "hash"), "offset", RANGE_BYTES), "ranges")]
    for _ in range(levels - 1):
        out.append(_gathered(out[-1], "node", FANOUT))
    return out


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    other = b.select(*[F.col(k).alias(f"b_{k}") for k in keys], F.col("hash").alias("b_hash"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"b_{k}") for k in keys])
    return a.join(other, same, "full").where(~F.col("hash").eqNullSafe(F.col("b_hash"))).select(
        *[F.coalesce(k, f"b_{k}").alias(k) for k in keys])


def _below(rows: DataFrame, parents: DataFrame, parent: Column) -> DataFrame:
    up = parents.select(F.col("archive").alias("up_archive"), F.col("node").alias("up_node"))
    return rows.join(up, (F.col("archive") == F.col("up_archive")) & (parent == F.col("up_node")), "left_semi")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(archive, offset, record_id, kind, expected_sha256, found_sha256) of the records at which the second replica differs.

    Both have the columns of ``archive`` or of ``inventory``; kind is altered, missing or extra.
    """
    sides = [written(leaves(r), "leaves") for r in (first, second)]
    end = max(s.agg(F.max("offset").alias("m")).first()["m"] or 0 for s in sides)
    levels = 1
    while RANGE_BYTES * FANOUT ** (levels - 1) <= end:
        levels += 1
    trees = [tree(s, levels) for s in sides]
    bad = written(_differing(trees[0][-1], trees[1][-1], ["archive", "node"]), "differing")
    for level in range(levels - 2, -1, -1):
        up = F.floor(F.col("node") / FANOUT).cast("bigint")
        bad = written(_differing(_below(trees[0][level], bad, up), _below(trees[1][level], bad, up), ["archive", "node"]), "differing")
    place = F.floor(F.col("offset") / RANGE_BYTES).cast("bigint")
    a, b = (_below(s, bad, place) for s in sides)
    b = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    met = a.join(b, (F.col("archive") == F.col("b_archive")) & (F.col("offset") == F.col("b_offset")), "full")
    kind = F.when(F.col("b_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("altered")
    return met.where(~F.col("digest").eqNullSafe(F.col("b_digest"))).select(
        F.coalesce("archive", "b_archive").alias("archive"), F.coalesce("offset", "b_offset").alias("offset"),
        F.coalesce("record_id", "b_record_id").alias("record_id"), kind.alias("kind"),
        F.col("digest").alias("expected_sha256"), F.col("b_digest").alias("found_sha256"))
