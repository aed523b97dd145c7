import random
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from conftest import SMALL
from docs_fixture import docs_of  # noqa: F401
from millgauge.llm.common import written


def test_registration():
    names = entry.queries()
    assert "pipeline" in names
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]


def test_stages_on_odd_rows(spark, docs_of, tmp_path):
    rng = random.Random(4)
    text = lambda n=50: " ".join("".join(rng.choice(["tha", "ing", "er", "on"]) for _ in range(3)) for _ in range(n))
    item, copied = text(30), text()
    rows = [(k, text()) for k in range(20)] + [(30, copied), (31, copied), (None, copied), (32, f"{text()} {item} {text()}"), (None, item),
            (33, None), (34, ""), (35, "123 456"), (36, "mail a@b.cd " + text()), (20, copied), (20, copied)]
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = docs_of(rows)
    kept = []
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), name)
        if name != "packing":
            assert docs.columns == docs_of([]).columns
        kept.append([r.doc_id for r in docs.collect()])
    every = sorted([*range(20), 20, 20, 30, 31, 32, 36])
    assert sorted(i for i in kept[0] if i is not None) == every and kept[0].count(None) == 2
    assert sorted(i for i in kept[1] if i is not None) == [*range(21), 32, 36] and kept[1].count(None) == 1
    assert sorted(kept[2]) == sorted(kept[3]) == [*range(21), 36]
    assert sorted(set(kept[4])) == [*range(21), 36]


def test_clashing_names(spark, docs_of, tmp_path):
    """Columns named like those that stages make for themselves pass through untouched."""
    names = ["row number", "Row Number ", "text key", "text keyleak", "row numberkept", "masked id", "masked spans", "member", "kept", "in 0", "lang_pred"]
    docs = docs_of([(k, "thaing er onthater " * (k + 4) + f"mail a{k}@b.cd") for k in range(5)] + [(9, None)])
    docs = docs.select("*", *[pipeline.F.concat(pipeline.F.lit(n), pipeline.F.col("doc_id")).alias(n) for n in names])
    spark.createDataFrame([(1, "nothing of this is there at all")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, str(tmp_path)), f"clash-{name}")
        assert out.columns == docs.columns
        assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names), name
        docs = out
    assert docs.count() > 0


def test_empty(spark, docs_of):
    docs = docs_of([])
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), f"empty-{name}")
        assert docs.count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, SMALL), f"small-{name}")
        out.append((name, docs.collect(), after.collect()))
        docs = after
    return out


def test_clean_documents_stay(spark, stages):
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, before, after in stages:
        ids = {r.doc_id for r in after}
        if name == "language":
            assert {r.doc_id for r in before if any(map(str.isalpha, r.text or ""))} == ids
        if name == "decontamination":
            holds = lambda r: any(f" {i} " in f" {' '.join(re.findall(r'\w+', r.text.lower()))} " for i in items)
            assert {r.doc_id for r in before if not holds(r)} == ids
        if name == "personal_data":
            assert len(before) == len(after) and not any("@mail" in r.text for r in after)
