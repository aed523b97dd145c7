import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millgauge.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    docs, counts, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, words = lang or "", TERM.findall((text or "").translate(FOLD))
        counts[lang, source or ""].update(words)
        total[lang].update(words)
        docs[lang].update(set(words))
    out = []
    for (lang, source), count in counts.items():
        kept = [t for t, n in docs[lang].items() if n >= 3]

        def share(c):
            size = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // size for t in kept}

        p, q = share(count), share(total[lang])
        value = lambda a, b: (a - b) ** 2 // b
        pairs = [(-sum(value(p[t], other[t]) for t in kept), name.encode()) for (tongue, name), c in counts.items()
                 if tongue == lang and name != source for other in [share(c)]]
        terms = [(-value(p[t], q[t]), t.encode()) for t in kept if count[t] and p[t] > q[t]]
        for part, found in (("pair", pairs), ("term", sorted(terms)[:200])):
            out += [(lang, source, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(sorted(found))]
    return sorted(out)


def audited(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], "text string, lang string, source string, value int, term string, chunk int")
    return sorted(tuple(r) for r in divergence.audit(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus():
    rng = random.Random(8)
    words = [w + c for w in ("alpha", "Beta", "gämma", "ДЕЛЬТА", "zeta'x", "eta-b") for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = []
    for k in range(400):
        source = "hot" if k % 3 == 0 else rng.choice(["a", "b", "é", "z", None])
        rows.append((" ".join(rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "de", None]), source))
    rows += [(None, "en", "silent"), ("", None, ""), ("one two two", "xx", "s1"), ("three", "xx", "s2"), ("1 2 3", "yy", "only"),
             ("Straße ÀÉ x " * 5, "en", "hot")] + [("same same row", "en", "a")] * 4
    return rows


@pytest.mark.parametrize("kw", [{}, {"chunk_terms": 20, "sources_at_once": 2}])
def test_equals_brute_force(spark, kw):
    rows = corpus()
    expected = brute(rows)
    assert {("xx", "s1", "pair", "s2", 0, 1), ("xx", "s2", "pair", "s1", 0, 1)} <= set(expected)
    assert audited(spark, rows, **kw) == expected


def test_only_two_hundred_terms(spark):
    rows = [(" ".join("w" + "".join(chr(97 + int(d)) for d in str(k)) for k in range(300)), "en", "a")] * 3 + [("other " * 50, "en", "b")] * 3
    found = audited(spark, rows, chunk_terms=64)
    assert found == brute(rows)
    assert max(r[5] for r in found if r[1] == "a" and r[2] == "term") == 200


def test_very_long_text_and_none(spark, monkeypatch):
    assert audited(spark, []) == []
    rows = [("Word other " * 300_000, "en", "a"), ("x" * 3_000_000, "en", "b"), ("word x", "en", "b"), ("word", "en", "c")]
    assert audited(spark, rows) == brute(rows)


def test_equal_subtrees_are_one_node():
    rng = np.random.default_rng(1)
    counts = np.zeros((3, 1024), np.int64)
    counts[0, :8], counts[1, 512:520] = np.arange(8), np.arange(8)  # the same subtree elsewhere in another group
    counts[2] = rng.integers(0, 3, 1024)
    forest = divergence.Forest(counts[:2])
    assert len(forest.levels[2][0]) == 2  # eight places: all zeros, or 0..7
    seen = []

    def price(which, a, b):
        seen.append(len(which))
        return (forest.values[a] - forest.values[b]) ** 2

    assert forest.priced(0, np.array([1]), price)[0] == ((counts[0] - counts[1]) ** 2).sum()
    assert seen == [15]  # (0,0) once, not a thousand times; seven values on either side against zero
    forest = divergence.Forest(counts)
    assert [int(x) for x in forest.priced(2, np.array([0, 1]), lambda w, a, b: (forest.values[a] - forest.values[b]) ** 2)] == [
        int(((counts[2] - counts[k]) ** 2).sum()) for k in (0, 1)]


def test_shares_beyond_64_bits():
    counts = np.array([0, 3, 10**11])
    assert divergence.shares(counts, 10**12, 50).tolist() == [1 + 10**9 * (c + 1) // (10**12 + 50) for c in (0, 3, 10**11)]
