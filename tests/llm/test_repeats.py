import hashlib
import random

import pytest

from docs_fixture import docs_of  # noqa: F401
from millgauge.llm import repeats


def brute(rows, window=13):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                first[g] = min(i, first.get(g, i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        left = [x for x, g in zip(w, gone) if not g]
        out.append((str(i), len(w), len(w) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot, batch", [(1000, 10_000), (3, 5)])
def test_equals_brute_force(docs_of, monkeypatch, hot, batch):
    monkeypatch.setattr(repeats, "HOT_TEXTS", hot)
    monkeypatch.setattr(repeats, "BATCH_ROWS", batch)
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(50)}" for _ in range(n))
    line, passage = text(9), text(60)
    rows = []
    for k in range(60):
        parts = [text(rng.randrange(0, 60))]
        if k % 3 == 0:
            parts.append(passage[rng.randrange(20) :])
        if k % 2:
            parts.append(line)
        parts.append(text(rng.randrange(0, 40)))
        rows.append((k * 17 % 61, "\n ".join(parts)))
    rows += [(100, rows[5][1]), (101, rows[5][1].replace("\n", " ")), (102, "a " * 500), (103, "a " * 40), (104, None), (105, ""), (106, text(12)),
             (None, passage), (None, rows[7][1]), (7, passage), (7, passage), (107, "é " * 13)]
    got = repeats.remove_repeats(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_one_notice_in_many_texts(spark, monkeypatch):
    """A passage of 15 words amid different words: all its excerpts share an anchor, no task holds more than a batch of them."""
    monkeypatch.setattr(repeats, "BATCH_ROWS", 300)
    monkeypatch.setattr(repeats, "CROWDED_ROWS", 300)
    monkeypatch.setattr(repeats, "HOT_TEXTS", 500)
    rng = random.Random(3)
    notice = " ".join(f"n{k}" for k in range(15))
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(6)) + f" {notice} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(6))) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = repeats.remove_repeats(df).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)
    batches = []

    class Spy:
        def __getattr__(self, name):
            return getattr(real, name)

        def concat(self, frames, **kw):
            out = real.concat(frames, **kw)
            batches.append(len(out))
            return out

    real = repeats.pd
    monkeypatch.setattr(repeats, "pd", Spy())
    frames = [real.DataFrame({"excerpt": range(a, a + 100), "words": [b" ".join(b"%d" % (a + k) for _ in range(13)) for k in range(100)],
                              "anchor": [(a + k) // 290 for k in range(100)], "low": 0, "high": 1}) for a in range(0, 3000, 100)]
    list(repeats._locate(13)(iter(frames)))
    assert batches and max(batches) <= 2 * 300 + 100


def test_very_long_text(spark):
    words = [f"w{k}" for k in range(200_000)]
    rows = [(1, " ".join(words)), (2, "x " + " ".join(words[150_000:150_100])), (3, "y" * 2_000_000)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_empty(docs_of):
    assert repeats.remove_repeats(docs_of([])).count() == 0
