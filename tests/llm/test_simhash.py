import random

import xxhash
from pyspark.sql import functions as F

from docs_fixture import docs_of  # noqa: F401
from millgauge.llm import simhash


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable, over all pairs."""
    root = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints:
            for j, b in prints:
                if (a ^ b).bit_count() <= 4 and root[j] < root[i]:
                    root[i] = root[j]
                    changed = True
    return root


def test_equals_all_pairs(spark, docs_of):
    rng = random.Random(3)
    base = [" ".join(rng.choice(["ab", "Cd", "é", "ef", "gh\x0bij", "k"]) + str(rng.randrange(40)) for _ in range(60)) for _ in range(12)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, t + " tail") for k, t in enumerate(base)] + [(200 + k, t) for k, t in enumerate(base[:4])]
    rows += [(300, ""), (301, None), (302, " \n\t"), (303, "one two"), (304, "ONE two"), (305, "x " * 3000)]
    rows = [(k * 7 % 401, t) for k, t in rows]
    want = {i: plain_fingerprint(t) for i, t in rows}
    root = plain_components(list(want.items()))
    got = {r.doc_id: r for r in simhash.near_duplicates(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == want
    assert {i: r.component_id for i, r in got.items()} == root


def test_signatures_meet_for_every_small_difference(spark):
    masks = [m % (1 << 64) for m in simhash.variant_masks()]
    rng = random.Random(5)
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(0, 5)):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_links_once(spark):
    rng = random.Random(8)
    values = [rng.getrandbits(63) for _ in range(20)]
    values += [v ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for v in values] + [0, 1, 3, 7, 15, 31]
    values = sorted(set(values))
    got = simhash.links(spark.createDataFrame([(v,) for v in values], "fp bigint")).collect()
    want = {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4}
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_null_ids_repeats_and_empty(spark, docs_of):
    rows = [(None, "a b c d e"), (None, "q r s t u v w"), (5, "a b c d e"), (5, "a b c d e"), (9, "a b c d e")]
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(docs_of(rows)).collect() if r.component_id)
    assert got == [(-1, 5), (5, 5), (5, 5), (9, 5)]
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_signatures_are_not_broadcast(spark):
    prints = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    found = simhash.links(prints)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
