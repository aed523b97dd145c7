"""Toxicity by compression distance to two zstandard dictionaries.

Method: from labelled texts two dictionaries are trained: what ordinary texts repeat, and what toxic
texts repeat and ordinary ones do not (by likelihood ratio of the number of texts). A text is cut into windows
of ``WINDOW_WORDS`` words. Each window is compressed with the ordinary dictionary alone and with both; the
bytes that the toxic one saves are the window's distance. How large the savings are and how often they
occur in the whole text gives a score through a logistic curve, calibrated on the labelled texts and to
the share of toxic labels.

Every window starts with the same filler, which both dictionaries hold. Without it zstandard would
store most short windows as they are and their lengths would not differ.

Fitting takes a bounded sample: about ``SAMPLE_DOCS`` labelled texts of each label, spread by a hash.
Scores come from the text alone.

Defined cases: null and empty texts have no windows and get the score of a text without savings; without
labels of both kinds every score is the share of toxic labels (0 if there are none); labels of a
row that repeats count once, as toxic if any says so; rows with a null id are scored and never learned from; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SAMPLE_DOCS = 4000
WINDOW_WORDS = 3
STEM_CHARS = (4, 5, 6, 8, 10)
MIN_DOCS = 4  # toxic texts that hold a stem
MIN_LIKELIHOOD, LIKELIHOOD_SHARE = 15.0, 0.018  # least likelihood ratio, at all and for each sampled text
MIN_ODDS = 2.0  # natural logarithm
TOXIC_ENTRIES, ORDINARY_ENTRIES = 4000, 3000
THRESHOLD = 0.3
FILLER = bytes(range(1, 33))
LEVEL, MIN_MATCH = 3, 5
WORD = re.compile(r"\w+")


def _words(text: str | None) -> list[bytes]:
    return [w.encode("utf-8", "surrogatepass") for w in WORD.findall((text or "").lower())]


def _stems(text: str | None) -> set[bytes]:
    """Each different word of a text between spaces, and its beginnings."""
    out = set()
    for w in set(_words(text)):
        out.add(b" " + w + b" ")
        out.update(b" " + w[:n] for n in STEM_CHARS if len(w) >= n)
    return out


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, window_log=17, min_match=MIN_MATCH, write_content_size=False, write_checksum=False, write_dict_id=False,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params)


class Distance:
    """Savings of the toxic dictionary over the windows of a text."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.plain = _compressor(ordinary + FILLER).compress
        self.both = _compressor(ordinary + toxic + FILLER).compress

    def savings(self, text: str | None) -> np.ndarray:
        words = _words(text)
        plain, both = self.plain, self.both
        out = []
        for at in range(0, len(words), WINDOW_WORDS):
            window = FILLER + b" " + b" ".join(words[at : at + WINDOW_WORDS]) + b" "
            out.append(len(plain(window)) - len(both(window)))
        return np.array(out, dtype=float)

    def features(self, text: str | None) -> list[float]:
        x = self.savings(text)
        if not len(x):
            return [0.0] * 8
        shares = [100 * (x >= 5).mean(), 100 * (x >= 3).mean(), 10 * x.mean()]
        counts = [min(x.max(), 12), (x >= 2).sum(), (x >= 4).sum(), (x >= 5).sum(), *shares, len(x)]
        return [math.log1p(max(float(v), 0.0)) for v in counts]


def _longest(entries: pd.DataFrame) -> pd.DataFrame:
    """Without beginnings that nearly always go on in the same way."""
    held = dict(zip(entries["stem"], entries["toxic"]))
    longer: Counter[bytes] = Counter()
    for stem, n in held.items():
        for k in range(2, len(stem)):
            if stem[:k] in held:
                longer[stem[:k]] = max(longer[stem[:k]], n)
    return entries[np.array([longer[s] < 0.8 * n for s, n in held.items()], dtype=bool)]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), slope)
    return w


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_docs: int = SAMPLE_DOCS) -> dict:
    """Dictionaries and curve from the labels given; the size of the model is bounded by the entry limits."""
    spark = docs.sparkSession
    known = (labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isin(0, 1))
             .groupBy(F.col(f"`{id_col}`").alias("label_id")).agg(F.max(f"`{label_col}`").alias("y")))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    if not counts.get(0) or not counts.get(1):
        return {"prior": prior}
    share = F.when(F.col("y") == 1, min(1.0, sample_docs / counts[1])).otherwise(min(1.0, sample_docs / counts[0]))
    picked = known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 20)) < share * (1 << 20))
    # The sample holds about two times ``sample_docs`` ids, whatever the size of the tables.
    texts = (docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
             .join(F.broadcast(picked), F.col("id") == F.col("label_id")).select("text", "y"))


    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, Counter[bytes]] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                sums[y].update(_stems(text))
                sums[y][b""] += 1
        for y, found in sums.items():
            yield pd.DataFrame({"stem": list(found), "y": y, "n": list(found.values())})

    stems = (texts.mapInPandas(count, "stem binary, y int, n bigint").groupBy("stem")
             .agg(F.sum(F.col("n") * F.col("y")).alias("toxic"), F.sum(F.col("n") * (1 - F.col("y"))).alias("ordinary")))
    stems = written(stems, "stems")
    sizes = stems.where(F.length("stem") == 0).first()
    if not sizes or not sizes["toxic"] or not sizes["ordinary"]:
        return {"prior": prior}
    words = stems.where(F.length("stem") > 0)
    usual = words.where("ordinary > 0").orderBy(F.desc("ordinary"), "stem").limit(ORDINARY_ENTRIES).toPandas()
    ordinary = b"".join(map(bytes, usual["stem"][::-1]))  # the most frequent last, nearest to the text
    toxic = b"".join(_longest(_marked(words, sizes["toxic"], sizes["ordinary"]))["stem"][::-1])
    if not toxic:
        return {"prior": prior}
    rows = texts.mapInPandas(_measure(ordinary, toxic), MEASURED).toPandas()
    x, y = np.array(rows["x"].tolist()).reshape(-1, 8), rows["y"].to_numpy(float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    weights = _logistic(np.c_[(x - mean) / scale, np.ones(len(x))], y)
    weights[-1] += math.log(prior / (1 - prior)) - math.log(y.mean() / (1 - y.mean()))
    return {"prior": prior, "ordinary": ordinary, "toxic": toxic, "mean": mean, "scale": scale, "weights": weights}


MEASURED = "x array<double>, y int"


def _measure(ordinary: bytes, toxic: bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        distance = Distance(ordinary, toxic)
        for batch in batches:
            yield pd.DataFrame({"x": [distance.features(t) for t in batch["text"]], "y": batch["y"]})

    return run


def _marked(words: DataFrame, toxic_docs: int, ordinary_docs: int) -> pd.DataFrame:
    """Stems that toxic texts hold far oftener than ordinary ones, best first: (stem, toxic, ratio)."""
    a, b = F.col("toxic"), F.col("ordinary")
    both = (a + b) / (toxic_docs + ordinary_docs)
    part = lambda n, of: F.when(n > 0, n * F.log(n / of / both)).otherwise(0.0)
    odds = F.log(((a + 0.5) / toxic_docs) / ((b + 0.5) / ordinary_docs))
    least = max(MIN_LIKELIHOOD, LIKELIHOOD_SHARE * (toxic_docs + ordinary_docs))
    found = (words.where((a >= MIN_DOCS) & (odds > MIN_ODDS))
             .select("stem", "toxic", (2 * (part(a, toxic_docs) + part(b, ordinary_docs))).alias("ratio"))
             .where(F.col("ratio") >= least).orderBy(F.desc("ratio"), "stem").limit(TOXIC_ENTRIES).toPandas())
    return found.assign(stem=found["stem"].map(bytes))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, extra columns, score, predicted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [id_col, *extra]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value
        distance = Distance(held["ordinary"], held["toxic"]) if "weights" in held else None
        for batch in batches:
            out = batch[kept].copy()
            if distance:
                x = np.array([distance.features(t) for t in batch["text "]]).reshape(-1, 8)
                z = np.c_[(x - held["mean"]) / held["scale"], np.ones(len(x))] @ held["weights"]
                out["score"] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                out["score"] = held["prior"]
            out["predicted"] = (out["score"] >= THRESHOLD).astype("int32")
            yield out

    picked = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").alias("text "))
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return picked.mapInPandas(run, f"{types}, score double, predicted int")
