"""Language of a text and of its parts: script ranges, word scores, Viterbi with a switching penalty.

Method: a word is a run of letters of one script; scripts written without spaces are cut into words of
``UNSPACED_LETTERS``. Its score for a language is the sum of log shares of its letter trigrams, learned from labelled rows and kept in a table of fixed size. The script of the
word first narrows the candidates: a language that does not use the script is out of the race.
Viterbi then picks the sequence of languages with the best total, where each change of language
costs ``SWITCH_COST``; the runs of that sequence are the spans.

The main language is the one with most letters. Fitting takes a bounded sample: about ``SAMPLE_DOCS`` labelled documents of each
language, spread over the table by a hash, of the ``MAX_LANGUAGES`` most frequent languages. Prediction reads whole texts.

Defined cases: a null text, an empty one and one without a letter get ``und`` with score 0 and no
spans; without any labelled row every text gets ``und``; rows with a null id are never learned
from; equal totals go to the language that sorts first; repeated rows are predicted alike; other
columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
SAMPLE_DOCS = 3000
BUCKETS = 1 << 16
SMOOTHING = 0.1
WORD_CLIP = 6.0  # the most that one word can say against a language
SWITCH_COST = 12.0
MAX_LANGUAGES = 256  # the model holds BUCKETS numbers for each
UNSPACED_LETTERS = 6
SCRIPT_SHARE = 0.01  # of a language's letters, for the script to count as its own

# First and last code point of the letters of each script.
SCRIPTS = (
    ("latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("armenian", ((0x530, 0x58F),)),
    ("hebrew", ((0x590, 0x5FF),)),
    ("arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("indic", ((0x900, 0xDFF),)),
    ("thai", ((0xE00, 0xE7F),)),
    ("georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F))),
    ("hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))),
    ("han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)
NUMBERS = {name: number for number, (name, _) in enumerate(SCRIPTS, 1)}
UNSPACED = np.isin(np.arange(len(SCRIPTS) + 2), [NUMBERS[n] for n in ("thai", "kana", "han")])
# Words of one language mix these, so a change between them ends no word; marks go with the letter before.
TOGETHER = np.arange(len(SCRIPTS) + 2)
TOGETHER[NUMBERS["kana"]] = NUMBERS["han"]


def letter_classes() -> np.ndarray:
    """Per code point: 0 for no letter, else 1 + number of its script, the last one for other scripts.

    Combining marks count as letters so that they do not split words.
    """
    classes = np.zeros(0x110000, dtype=np.uint8)
    other = len(SCRIPTS) + 1
    for code in range(0x110000):
        if unicodedata.category(chr(code))[0] in "LM":
            classes[code] = other
    for number, (_, ranges) in enumerate(SCRIPTS, 1):
        for lo, hi in ranges:
            part = classes[lo : hi + 1]
            part[part > 0] = number
    return classes


def grams(text: str, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the letters of a text: gram bucket and script class; for its words: first letter and (start, end)."""
    lowered = text.lower()
    if len(lowered) != len(text):  # a few capitals grow when lowered; positions must stay those of the text
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    code = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    script = classes[code]
    at = np.flatnonzero(script)
    held = np.concatenate(([0], np.where(script > 0, code, 0), [0])).astype(np.uint32)
    mixed = held[at] * np.uint32(0x9E3779B1) + held[at + 1] * np.uint32(0x85EBCA77) + held[at + 2] * np.uint32(0xC2B2AE3D)
    bucket = (mixed ^ (mixed >> np.uint32(15))) & np.uint32(BUCKETS - 1)
    begins = np.diff(at, prepend=-2) > 1
    if len(at) and (UNSPACED[script[at[0]]] or (script[at] != script[at[0]]).any()):
        begins = _script_words(begins, script[at])
    first = np.flatnonzero(begins)
    starts = at[first]
    ends = at[np.concatenate((first[1:] - 1, [len(at) - 1]))] + 1 if len(at) else at
    return bucket, script[at], first, np.stack((starts, ends), axis=1)


def _script_words(begins: np.ndarray, script: np.ndarray) -> np.ndarray:
    """Where words begin among letters: after a gap, where the script changes, and within long runs of scripts without spaces."""
    order = np.arange(len(script))
    clear = (script <= len(SCRIPTS)) | begins  # the last class holds marks, which take the script before them
    kind = TOGETHER[script][np.maximum.accumulate(np.where(clear, order, 0))]
    begins = begins | (np.diff(kind, prepend=-1) != 0)
    since = order - np.maximum.accumulate(np.where(begins, order, 0))
    return begins | (UNSPACED[kind] & (since % UNSPACED_LETTERS == 0))


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", key_col: str = "doc_id",
          sample_docs: int = SAMPLE_DOCS) -> dict:
    """Model from rows with a language: {languages, table, scripts, classes}; its size is bounded by the languages."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"),
                       F.xxhash64(F.col(f"`{key_col}`"), F.col(f"`{text_col}`")).alias("h")).where("lang is not null and text is not null")
    frequent = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    counts = {r.lang: r.n for r in frequent.collect()}
    classes = letter_classes()
    model = {"languages": sorted(counts), "classes": classes}
    if not counts:
        return model
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample_docs / n)).otherwise(share)
    sample = rows.where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")
    shared = spark.sparkContext.broadcast(classes)
    kinds = len(SCRIPTS) + 2

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                bucket, script, _, _ = grams(text, shared.value)
                held = sums.setdefault(lang, np.zeros(BUCKETS + kinds, dtype=np.int64))
                held[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
                held[BUCKETS:] += np.bincount(script, minlength=kinds)
        for lang, held in sums.items():
            at = np.flatnonzero(held)
            yield pd.DataFrame({"lang": lang, "slot": at, "n": held[at]})

    found = (sample.mapInPandas(count, "lang string, slot bigint, n bigint")
             .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    held = np.zeros((BUCKETS + kinds, len(counts)))
    place = {lang: k for k, lang in enumerate(model["languages"])}
    held[found["slot"].to_numpy(), found["lang"].map(place).to_numpy()] = found["n"].to_numpy()
    seen, letters = held[:BUCKETS], held[BUCKETS:]
    table = np.log((seen + SMOOTHING) / (seen.sum(axis=0) + SMOOTHING * BUCKETS))
    table[seen.sum(axis=1) == 0] = 0  # says nothing
    model["table"] = table.astype(np.float32)
    model["scripts"] = letters >= SCRIPT_SHARE * np.maximum(letters.sum(axis=0), 1)
    return model


def word_scores(text: str, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words x languages) scores, at most 0, the (start, end) of each word in code points, and its letters."""
    bucket, script, first, places = grams(text, model["classes"])
    if not len(first):
        return np.zeros((0, len(model["languages"]))), places, first
    scores = np.add.reduceat(model["table"][bucket], first, axis=0)
    used = model["scripts"][script[first]]
    some = used.any(axis=1)
    scores = np.where(used | ~some[:, None], scores, -np.inf)
    scores -= scores.max(axis=1, keepdims=True)
    return np.maximum(scores, np.where(used | ~some[:, None], -WORD_CLIP, -2 * SWITCH_COST)).astype(float), places, np.diff(np.append(first, len(script)))


def best_path(scores: np.ndarray, switch_cost: float = SWITCH_COST) -> np.ndarray:
    """Index of the language of each word on the path with the best total.

    One language throughout is proven best when no stretch of words gains more than one change
    costs by leaving it; only other texts need the step-by-step search.
    """
    only = int(scores.sum(axis=0).argmax())
    gain = np.cumsum(scores - scores[:, [only]], axis=0)
    floor = np.minimum(np.minimum.accumulate(np.vstack((np.zeros((1, gain.shape[1])), gain))[:-1], axis=0), 0)
    if (gain - floor).max() <= switch_cost:
        return np.full(len(scores), only)
    count = scores.shape[1]
    total, back = list(scores[0]), []
    for row in scores[1:].tolist():
        top = max(range(count), key=total.__getitem__)
        least = total[top] - switch_cost
        back.append([k if total[k] >= least else top for k in range(count)])
        total = [max(total[k], least) + row[k] for k in range(count)]
    at = max(range(count), key=total.__getitem__)
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    return np.array(path[::-1])


def label(text: str | None, model: dict) -> tuple[str, float, list[tuple[int, int, str]]]:
    """Main language, share of letters in it, and the spans (start, end, language)."""
    if not text or not model["languages"] or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, []
    scores, places, letters = word_scores(text, model)
    path = best_path(scores)
    share = np.bincount(path, weights=letters, minlength=len(model["languages"])) / letters.sum()
    main = int(share.argmax())
    starts = np.flatnonzero(np.diff(path, prepend=-1))
    ends = np.concatenate((starts[1:], [len(path)])) - 1
    spans = [(int(places[a, 0]), int(places[b, 1]), model["languages"][path[a]]) for a, b in zip(starts, ends)]
    return model["languages"][main], float(share[main]), spans


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, extra columns, lang_pred, score, spans) for every row; spans are in code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [id_col, *extra]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [label(t, shared.value) for t in batch["text "]]
            out = batch[kept].copy()
            out["lang_pred"] = [r[0] for r in rows]
            out["score"] = [r[1] for r in rows]
            out["spans"] = [[{"start": a, "end": b, "lang": c} for a, b, c in r[2]] for r in rows]
            yield out

    picked = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("text "))
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return picked.mapInPandas(run, f"{types}, lang_pred string, score double, spans array<struct<start:bigint,end:bigint,lang:string>>")
