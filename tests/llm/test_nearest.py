import math
import random

import pytest
from pyspark.sql import functions as F

from millgauge.llm import nearest


def brute(rows, top):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(64 * x) for x in v]
            usable[i] = min(usable.get(i, q), q)
    out = []
    for i, a in usable.items():
        if i % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in usable.items() if j != i)[:top]
            out += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_equals_brute_force(spark, shard_rows, monkeypatch):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0, 0.2) for _ in range(6)]) for k in range(300)]
    rows += [(k, rows[7][1]) for k in range(300, 360)]  # ties
    rows += [(400, None), (420, []), (440, [1.0, None]), (460, [float("nan"), 1.0]), (480, [float("inf")]), (None, [1.0]),
             (500, [0.5]), (40, [9.0, 9.0]), (520, [3e5] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, score int, rank int")
    got = nearest.top_products(df, F.col("vec_id") % 20 == 0, top=9, shard_rows=shard_rows).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 9)


def test_few_and_none(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert nearest.top_products(empty, F.col("vec_id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(20, [1.0]), (21, [-1.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in nearest.top_products(two, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 21, -4096)]
