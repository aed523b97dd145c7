import random

import numpy as np

import corpus_pipeline as pipeline
from docs_fixture import docs_of  # noqa: F401
from millgauge.llm import shingles


def plain_similarity(a, b):
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def near(rng, n=300, changes=None):
    words = [f"w{rng.randrange(3000)}" for _ in range(n)]
    other = list(words)
    for at in rng.sample(range(n), changes or rng.randrange(1, 7)):
        other[at] = f"x{rng.randrange(10**6)}"
    return " ".join(words), " ".join(other)


def test_similarity_is_exact():
    rng = random.Random(1)
    for _ in range(100):
        a, b = near(rng, rng.randrange(1, 60), 1)
        sets = [np.unique(shingles.shingle_hashes(t, 5)) for t in (a, b)]
        assert shingles.similarity(*sets) == plain_similarity(a, b)


def test_bands_meet_at_the_bound():
    rng, met, all_pairs = random.Random(2), 0, 0
    while all_pairs < 400:
        a, b = near(rng, changes=7)
        if 0.79 < plain_similarity(a, b) < 0.83:
            all_pairs += 1
            met += bool(set(shingles.bands(shingles.shingle_hashes(a, 5))) & set(shingles.bands(shingles.shingle_hashes(b, 5))))
    print("met at the bound:", met, "of", all_pairs)
    assert met >= 0.99 * all_pairs


def test_stage_drops_near_copies_and_keeps_others(spark, docs_of):
    rng, rows, copies = random.Random(3), [], set()
    for k in range(150):
        a, b = near(rng)
        rows += [(2 * k, a), (2 * k + 1, b.upper())]
        if plain_similarity(a, b) >= 0.8:
            copies.add(2 * k + 1)
    for k in range(20):  # much alike, but below the bound
        a, b = near(rng, 100, 12)
        rows += [(1000 + 2 * k, a), (1001 + 2 * k, b)]
        copies |= {1001 + 2 * k} if plain_similarity(a, b) >= 0.8 else set()
    group = near(rng)[0].split()
    rows += [(2000 + k, " ".join(group[:k] + ["other"] + group[k + 1 :])) for k in range(0, 300, 5)]  # one large group
    copies |= {2000 + k for k in range(5, 300, 5)}
    rows += [(3000, "one two"), (3001, "one  TWO"), (3002, "one two three"), (None, "one two")]
    copies.add(3001)
    kept = [r.doc_id for r in pipeline.drop_near_duplicates(spark, docs_of(rows), "").collect()]
    missed = set(kept) & copies
    print("copies:", len(copies), "missed:", len(missed))
    assert None not in kept and {i for i, _ in rows} - copies - {None} <= set(kept)
    assert len(kept) == len(set(kept)) and not missed


def test_fingerprints_meet_what_no_band_meets(spark, docs_of, monkeypatch):
    monkeypatch.setattr(shingles, "bands", lambda hashes: [])
    rng, rows, linked = random.Random(4), [], set()
    for k in range(60):
        a, b = near(rng, 400, 1)
        rows += [(2 * k, a), (2 * k + 1, b)]
        prints = [shingles.majority(np.unique(shingles.shingle_hashes(t, 5))) for t in (a, b)]
        linked |= {2 * k + 1} if (prints[0] ^ prints[1]).bit_count() <= 4 and plain_similarity(a, b) >= 0.8 else set()
    rows += [(500, rows[0][1].upper()), (501, None), (502, "")]
    kept = {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs_of(rows), "").collect()}
    assert len(linked) > 30 and kept == {i for i, _ in rows} - linked - {500, 502}


def test_exploded_sides_and_texts_are_not_broadcast(spark, docs_of, monkeypatch):
    plans, write = [], shingles.written

    def kept(df, name, **options):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name, **options)

    monkeypatch.setattr(shingles, "written", kept)
    rng = random.Random(5)
    shingles.near_copies(docs_of([(2 * k + j, t) for k in range(5) for j, t in enumerate(near(rng, 60, 1))]), "doc_id").collect()
    checked = [plan for name, plan in plans if name in ("shingle-pairs", "simhash-links", "shingle-alike", "simhash-alike")]
    assert len(checked) == 4 and all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in checked)
    assert all("SortMergeJoin" in plan for name, plan in plans if name.endswith("-texts"))
