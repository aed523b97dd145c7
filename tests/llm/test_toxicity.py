import random

from docs_fixture import docs_of  # noqa: F401
from millgauge.llm import toxicity


def rows_of(n, rng):
    word = lambda: "".join(rng.choice(["ta", "re", "mi", "on", "el"]) for _ in range(rng.randrange(1, 4)))
    out = []
    for k in range(n):
        bad = k % 4 == 0
        words = [word() for _ in range(rng.randrange(5, 80))]
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["grumblefuz", "Skworlish!", "vuxpet"]))
        out.append((k, " ".join(words), int(bad)))
    return out


def test_separates_and_handles_odd_rows(spark, docs_of):
    rows = rows_of(800, random.Random(5))
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows[:500]] + [(3, 0, 1), (None, 1, 1), (9999, 1, 1), (5, None, 1)], "doc_id bigint, toxic int, text int")
    docs = docs_of([(i, t) for i, t, _ in rows] + [(2000, None), (2001, ""), (None, "vuxpet " * 5), (1, rows[1][1])])
    got = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r.score for r in got}
    held = [(by[i], y) for i, _, y in rows[500:]]
    assert sum((s >= 0.3) == bool(y) for s, y in held) / len(held) > 0.97
    assert by[2000] == by[2001] < 0.3


def test_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    docs = docs_of([(1, "a"), (2, None)])
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, one)).collect()} == {1.0}
    both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, toxic int")
    assert toxicity.score(docs_of([]), toxicity.learn(docs, both)).count() == 0


def test_no_marked_words(spark, docs_of):
    docs = docs_of([(k, "plain words " + "re" * (k % 7)) for k in range(60)])
    labels = spark.createDataFrame([(k, int(k < 15)) for k in range(60)], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()} == {0.25}


def test_held_out_on_labelled_table(spark):
    from millgauge.llm import queries

    folder = "/root/testdata/sf0.1"
    got = queries.QUERIES["op6_toxicity"](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    pairs = [(r.score, r.toxic) for r in got.join(labels, "doc_id").collect()]
    good, bad = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    assert sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad)) > 0.9
