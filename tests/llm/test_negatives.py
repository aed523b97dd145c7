import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millgauge.llm import negatives


def brute(rows, positives=5, count=3):
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = ([math.floor(256 * x) for x in v], label)
            usable[i] = min(usable.get(i, q), q)
    out = []
    for i, (a, own) in usable.items():
        if i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, label) for j, (b, label) in usable.items() if j != i)
        for s, p, label in [x for x in scored if x[2] == own][:positives]:
            fits = [(n, -t) for t, n, other in scored if other != own and 50 * -s <= 100 * -t <= 95 * -s][:count]
            out += [(i, p, k + 1, n, -s, t) for k, (n, t) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, score int, block string")
    found = negatives.mine(df, F.col("vec_id") % 50 == 0, **kw).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found)


@pytest.mark.parametrize("block_rows,slab_rows", [(60, 3), (100_000, 100_000)])
def test_equals_brute_force(spark, block_rows, slab_rows):
    rng = random.Random(4)
    middles = [[rng.gauss(0, 0.15) for _ in range(24)] for _ in range(4)]
    rows = []
    for k in range(900):
        label = 0 if k % 3 == 0 else rng.randrange(1, 40)  # a third of all rows has one label
        rows.append((k, [m + rng.gauss(0, 0.08) for m in middles[rng.randrange(4)]], label))
    rows += [(k, rows[50][1], k % 5) for k in range(900, 960)]  # ties, the anchor's own vector
    rows += [(1000, None, 1), (1050, [1.0, None], 1), (1100, [float("nan")], 1), (1150, [float("inf")], 1), (1200, [0.5], None),
             (None, [0.5], 1), (1250, [], 1), (1300, [0.4, 0.1], 0), (100, [5.0] * 24, 3), (1350, [0.0] * 24, 2)]
    expected = brute(rows)
    assert len(expected) > 100
    assert mined(spark, rows, block_rows=block_rows, slab_rows=slab_rows) == expected


@pytest.mark.parametrize("size", [3e5, 3e6])  # beyond doubles, and with sums that might leave 64 bits
def test_large_components(spark, size):
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0, 1) * size for _ in range(3)], k % 2) for k in range(120)]
    assert mined(spark, rows) == brute(rows)


def test_beyond_64_bits(spark):
    assert mined(spark, [(k, [3e38 * (k % 3 + 1)], k % 2) for k in range(60)]) == []


def test_few_and_none(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []
    assert mined(spark, [(50, [1.0], 1), (51, [1.0], 1)]) == []
    assert mined(spark, [(50, [1.0], 1), (51, [1.0], 1), (52, [0.7], 2)]) == [(50, 51, 1, 52, 65536, 256 * 179)]


def test_intervals_hold_the_product():
    rng = np.random.default_rng(6)
    for width in (1, 7, 64, 100):
        points = rng.integers(-300, 300, (500, width))
        points[:5] = 0
        codes = negatives.Codes(negatives.Codes.pack(0, np.arange(500), np.zeros(500, np.int64), points), width)
        asked = np.concatenate((points[:20], rng.integers(-300, 300, (20, width))))
        units, lengths = negatives._units(asked)
        for anchor, around, length in zip(asked, negatives.turned(units), lengths):
            below, above = codes.intervals(around, length, slice(0, 500))
            true = points @ anchor
            assert (below <= true).all() and (true <= above).all()


def test_window_ends():
    for score in (-7, 0, 1, 3, 99, 100, 101, 2**60):
        least, greatest = negatives.window_of(score)
        for n in (least - 1, least, greatest, greatest + 1):
            assert (50 * score <= 100 * n <= 95 * score) == (least <= n <= greatest)
