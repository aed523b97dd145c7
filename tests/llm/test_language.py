import random

import numpy as np
import pytest

from docs_fixture import docs_of  # noqa: F401
from millgauge.llm import language

SYLLABLES = {"aa": ["tha", "ing", "er"], "bb": ["sch", "ung", "keit"], "cc": ["жа", "ко", "ли"]}


def sentence(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(k, sentence(lang, 60, rng), lang) for k in range(40) for lang in SYLLABLES] + [(900, None, "aa"), (901, "x", None)]
    return language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))


def test_path_equals_search_over_all_paths():
    rng = np.random.default_rng(3)
    for _ in range(200):
        scores = -rng.integers(0, 7, (rng.integers(1, 7), 3)).astype(float)
        best = None
        for code in range(3 ** len(scores)):
            path = [code // 3**k % 3 for k in range(len(scores))]
            total = sum(scores[k, p] for k, p in enumerate(path)) - 4.5 * sum(a != b for a, b in zip(path, path[1:]))
            best = total if best is None else max(best, total)
        got = language.best_path(scores, 4.5)
        assert np.isclose(sum(scores[k, p] for k, p in enumerate(got)) - 4.5 * (np.diff(got) != 0).sum(), best)


def test_spans_of_mixed_text(spark, docs_of, model):
    rng = random.Random(2)
    parts = [sentence("aa", 40, rng), sentence("bb", 30, rng), sentence("cc", 20, rng)]
    got = language.identify(docs_of([(1, " ".join(parts)), (1, " ".join(parts))]).drop("score", "spans"), model).collect()
    assert len(got) == 2 and got[0] == got[1]
    assert got[0].lang_pred == "aa" and 0.3 < got[0].score < 0.6
    ends = [len(parts[0]), len(parts[0]) + 1 + len(parts[1]), len(" ".join(parts))]
    assert [s.lang for s in got[0].spans] == ["aa", "bb", "cc"]
    assert all(abs(s.end - e) <= 12 for s, e in zip(got[0].spans, ends))


def test_script_rules_out_languages(model):
    assert {s[2] for s in language.label("жако лижа " * 3, model)[2]} == {"cc"}


def test_words_end_where_scripts_change(spark):
    rng = random.Random(4)
    han = ["手机壳", "很好看", "我今天", "买了", "一二三", "天上", "看书"]
    kana = [chr(c) for c in range(0x3042, 0x3090)]
    unspaced = {"zh": lambda: "".join(rng.choices(han, k=80)), "ja": lambda: "".join(rng.choices(kana + ["食", "行", "見"], k=80)),
                "en": lambda: sentence("aa", 40, rng) + " iphone"}
    rows = [(k, make(), lang) for k in range(40) for lang, make in unspaced.items()]
    held = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    text = "iPhone手机壳很好看我今天买了一二三"
    main, share, spans = language.label(text, held)
    assert main == "zh" and 0.5 < share < 1 and spans == [(0, 6, "en"), (6, len(text), "zh")]
    text = "手机壳很好看我今天买了 thaing er 手机壳很好看我今天买了"
    assert [s[2] for s in language.label(text, held)[2]] == ["zh", "en", "zh"] and language.label(text, held)[0] == "zh"
    assert {s[2] for s in language.label("".join(kana[:40]) + "食" + "".join(kana[40:]), held)[2]} == {"ja"}
    accents = "tha" + chr(0x301) + "ing er"  # a mark splits no word
    assert len(language.word_scores(accents, held)[0]) == 2


def test_many_languages_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    rows = [(k, "thaing er", "l%d" % min(k % 10, 3)) for k in range(100)]
    held = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert held["languages"] == ["l0", "l3"]


def test_very_long_text(model):
    text = sentence("aa", 100_000, random.Random(1)) + " " + "жако" * 200_000
    main, share, spans = language.label(text, model)
    assert [s[2] for s in spans] == ["aa", "cc"] and spans[-1][1] == len(text)


def test_defined_cases(spark, docs_of, model):
    rows = [(1, None), (2, ""), (3, "123 !! ́"), (None, "thaing er"), (5, "İİ thaing"), (6, "漢字")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs_of(rows), model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[None] == ("aa", 1.0) and got[5][0] == "aa" and got[6][0] in SYLLABLES
    assert language.identify(docs_of([]), model).count() == 0
    none = language.learn(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert language.identify(docs_of([(1, "abc")]), none).first().lang_pred == "und"


def test_held_out_accuracy(spark):
    from millgauge.llm import queries

    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES["op10_language"](spark, folder).where("held_out")
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    right = got.join(truth, "doc_id").selectExpr("avg(cast(lang_pred = lang AS double)) AS a").first().a
    assert right > 0.98
