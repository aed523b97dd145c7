import hashlib

import pytest

from millgauge.llm import fixity

SCHEMA = "page_id bigint, url string, html string, archive string, offset int"


def pages(spark, n=300):
    rows = [(k, f"http://h/{k}", "é" * (k * 37 % 900), "x", 1) for k in range(n)]
    return spark.createDataFrame(rows + [(None, None, None, "x", 1), (3, "http://h/3", "", "x", 1), (3, "http://h/3", "", "x", 1)], SCHEMA)


def text_of(r):
    body = r.body or ""
    return (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:{'' if r.record_id is None else r.record_id}>\r\nWARC-Target-URI: {r.url or ''}\r\n"
            f"Content-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n").encode()


@pytest.mark.parametrize("range_bytes", [200, 1 << 16])
def test_finds_exactly_the_damage(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(fixity, "RANGE_BYTES", range_bytes)
    good = fixity.written(fixity.archive(pages(spark), archive_bytes=40_000), "replica")
    records = good.collect()
    assert len({r.archive for r in records}) > 1
    ends = {}
    for r in sorted(records, key=lambda r: (r.archive, r.offset)):
        assert r.offset == ends.get(r.archive, 0) and r.length == len(text_of(r))
        ends[r.archive] = r.offset + r.length
    assert fixity.audit(good, good).count() == 0
    bad = good.where("record_id IS NULL OR record_id NOT IN (50, 51)").selectExpr(
        "archive", "offset", "length", "record_id", "url", "if(record_id IN (7, 299) OR record_id IS NULL, concat(coalesce(body, ''), '!'), body) AS body")
    bad = bad.union(good.where("record_id = 9").selectExpr("archive", "offset + 10000000", "length", "record_id", "url", "body"))
    got = {(r.record_id, r.kind): r for r in fixity.audit(good, bad).collect()}
    assert set(got) == {(50, "missing"), (51, "missing"), (7, "altered"), (299, "altered"), (None, "altered"), (9, "extra")}
    by_id = {r.record_id: r for r in records}
    assert got[50, "missing"].expected_sha256 == hashlib.sha256(text_of(by_id[50])).hexdigest()


def test_only_differing_ranges_are_read(spark, monkeypatch):
    monkeypatch.setattr(fixity, "RANGE_BYTES", 500)
    monkeypatch.setattr(fixity, "FANOUT", 4)
    good = fixity.written(fixity.archive(pages(spark)), "replica")
    bad = good.withColumn("body", fixity.F.expr("if(record_id = 150, 'rotten', body)"))
    read, below = [], fixity._below

    def counted(*args):
        out = below(*args)
        read.append((args[0].count(), out.count()))
        return out

    monkeypatch.setattr(fixity, "_below", counted)
    assert [r.record_id for r in fixity.audit(good, bad).collect()] == [150]
    assert len(read) > 8 and max(n for n, _ in read) > 200
    assert all(n <= 4 for _, n in read[:-2]) and all(n <= 12 for _, n in read[-2:])


@pytest.mark.parametrize("archive_bytes", [40_000, 1 << 26])
def test_inventory_equals_archive(spark, archive_bytes):
    table = pages(spark)
    other = fixity.F.concat(fixity.F.col("html"), fixity.F.lit("!"))
    held = fixity.inventory(table, archive_bytes=archive_bytes, other=other).collect()
    laid = fixity.archive(table, archive_bytes=archive_bytes).collect()
    key = lambda r: (r.archive, r.offset)
    want = [(*key(r), r.length, r.record_id, hashlib.sha256(text_of(r)).hexdigest()) for r in sorted(laid, key=key)]
    assert [(*key(r), r.length, r.record_id, r.digest) for r in sorted(held, key=key)] == want
    changed = fixity.archive(table.withColumn("html", other), archive_bytes=archive_bytes)
    assert sorted(r.other for r in held) == sorted(r.digest for r in fixity.leaves(changed).collect())


def test_empty(spark):
    none = fixity.archive(pages(spark).limit(0))
    assert none.count() == 0 and fixity.audit(none, none).count() == 0
    assert {r.kind for r in fixity.audit(fixity.archive(pages(spark, 5)), none).collect()} == {"missing"}
