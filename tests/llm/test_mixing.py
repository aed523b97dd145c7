import math
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from millgauge.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(rows):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, out = Fraction(3, 2) * sum(sizes.values()), set(order), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / whole >= 2 * sizes[s]]
        if not above:
            out |= {s: left * weight[s] / whole for s in open_}
            break
        for s in above:
            out[s] = Fraction(2 * sizes[s])
            left -= out[s]
            open_.remove(s)
    return sizes, out


def mixed(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "doc_id bigint, text string, source string, size int, number string, target double")
    return mixing.mix(df.repartition(parts)).collect()


def corpus(n=3000, seed=3):
    rng = random.Random(seed)
    names = ["hot", "Z", "b", "é", "😀", "ｆ", None]  # the last two: code points, not UTF-16
    rows = []
    for k in range(n):
        source = "hot" if k % 3 == 0 else rng.choice(names)
        rows.append((k, "w " * int(rng.lognormvariate(3, 1)), source))
    return rows + [(n, None, "hot"), (None, "a b c", "Z"), (5, "x", "b"), (5, "x", "b"), (n + 1, "", "empty"), (n + 2, "   \tq\x0br", None)]


def test_targets_and_copies(spark):
    rows = corpus()
    sizes, wanted = targets(rows)
    found = mixed(spark, rows)
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted((i or -1, len(WORD.findall(t or ""))) for i, t, _ in rows)
    taken = defaultdict(int)
    for r in found:
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size
        assert r.source_size == sizes[r.source] and math.isclose(r.target, float(wanted[r.source]), rel_tol=1e-12, abs_tol=1e-12)
        taken[r.source] += r.taken
    assert len({s for s, t in wanted.items() if 0 < t < 2 * sizes[s]}) >= 2 and any(t == 2 * sizes[s] > 0 for s, t in wanted.items())
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 1


def plain_rates(sizes, target):
    mean, low, high = sum(sizes) / len(sizes), -1e3, 1e3
    rate = lambda tilt, s: 2 / (1 + math.exp(min(700, -tilt * s / mean)))
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if sum(s * rate(middle, s) for s in sizes) > target else (middle, high)
    return {s: rate(low, s) for s in sizes}


def test_rates_solve_the_dual(spark):
    rows = corpus()
    sizes, wanted = targets(rows)
    found = mixed(spark, rows)
    for source, target in wanted.items():
        if 0 < target < 2 * sizes[source]:
            mine = [r for r in found if r.source == source]
            expected = plain_rates([r.size for r in mine], float(target))
            assert all(abs(r.rate - expected[r.size]) < 1e-4 for r in mine)


def test_reruns_agree(spark):
    rows = corpus(600, 9)
    key = lambda found: sorted(map(repr, found))
    first = key(mixed(spark, rows, 2))
    random.Random(1).shuffle(rows)
    assert key(mixed(spark, rows, 5)) == first


def test_few_buckets_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 10)
    rows = [(k // 4, "a b c", "hot" if k % 2 else "b") for k in range(400)] + [(k, "a " * k, "c") for k in range(30)]
    sizes, wanted = targets(rows)
    taken = defaultdict(int)
    for r in mixed(spark, rows):
        assert r.copies in (0, 1, 2)
        taken[r.source] += r.taken
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 3


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")]])
def test_no_words(spark, rows):
    assert [(r.size, r.target, r.taken) for r in mixed(spark, rows)] == [(0, 0.0, 0)] * len(rows)


def test_very_long_text(spark):
    rows = [(1, "w " * 1_000_000, "a"), (2, "x" * 3_000_000, "a"), (3, "y z", "b")]
    assert sorted((r.doc_id, r.size) for r in mixed(spark, rows)) == [(1, 1_000_000), (2, 1), (3, 2)]
