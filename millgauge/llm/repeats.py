"""Removal of repeated passages with sharded Aho-Corasick automata.

A window is ``WINDOW`` consecutive words. A word goes if a window that covers it also starts in a
document with a smaller id. Method:

1. Every text yields anchors: of each window the five-word group with the least hash. Equal windows have
   equal anchors, so a window can only recur where its anchor does, and anchors are a fifth of the words.
2. Texts with anchors that recur send excerpts, the words around such an anchor, to the shard of the
   anchor. Equal excerpts of a task are sent once. A shard confirms the windows that recur, compiles them (as
   word sequences) into an automaton and streams its excerpts through it, which locates every
   occurrence and gives the smallest id of each. Shards work in batches of bounded size.
3. The excerpts of an anchor that many texts hold are told apart by a second anchor, the group with the
   largest hash of each window, which equal windows share as well.
4. An anchor with more than ``CROWDED_ROWS`` different excerpts goes to no single task. Its windows become rows, and Spark
   aggregates the smallest and largest id of each.
5. Every text learns from its excerpts which windows to cut, in a join that adaptive execution splits.

Texts equal to the last character are one text with the smallest id of its rows; in later rows every window repeats.

Defined cases: null text has no words; texts shorter than a window keep all; a row with a null id keeps
all its words and takes none from others; rows that repeat an id do not count against each other;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

WINDOW = 13
ANCHOR_WORDS = 5
ANCHOR_BITS = 44
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
HOT_TEXTS = 1000  # texts with an anchor from which on a second anchor tells its excerpts apart
BATCH_ROWS = 10_000  # excerpts that one automaton is built from, but for the last anchor
CROWDED_ROWS = 100_000  # excerpts of an anchor beyond which no task holds them


def _hashes(words) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), dtype=">u8").astype(np.uint64)


def _rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive words, out of the hashes of the words."""
    out = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for k in range(width):
        out = out * MULTIPLIER + hashes[k : k + len(out)]
    out ^= out >> np.uint64(32)
    return out * MULTIPLIER


def _groups(hashes: np.ndarray) -> np.ndarray:
    return (_rolling(hashes, ANCHOR_WORDS) >> np.uint64(64 - ANCHOR_BITS)).astype(np.int64)


def _anchors(groups: np.ndarray, window: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Per window: place and hash of its anchor, or of its second anchor."""
    views = np.lib.stride_tricks.sliding_window_view(-groups if second else groups, window - ANCHOR_WORDS + 1)
    place = np.empty(len(views), dtype=np.int64)
    for at in range(0, len(views), 1 << 16):
        place[at : at + (1 << 16)] = views[at : at + (1 << 16)].argmin(axis=1) + np.arange(at, min(at + (1 << 16), len(views)))
    return place, groups[place]


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _kept(words: list[bytes], removed: np.ndarray) -> tuple[int, str]:
    left = [w for w, gone in zip(words, removed.tolist()) if not gone]
    return len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest()


def _survey(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch["text"]):
                words = _words(text)
                found = np.unique(_anchors(_groups(_hashes(words)), window)[1]) if len(words) >= window else np.empty(0, np.int64)
                rows.append((key, len(words), hashlib.sha256(b" ".join(words)).hexdigest(), found))
            out = pd.DataFrame(rows, columns=["key", "n_words", "whole_sha256", "anchors"])
            out.insert(0, "id", batch["id"].to_numpy() if len(rows) else [])
            yield out

    return run


def _among(values: np.ndarray, wanted) -> np.ndarray:
    wanted = np.sort(np.asarray(wanted, dtype=np.int64))
    if not len(wanted):
        return np.zeros(len(values), bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def _cuts(groups: np.ndarray, window: int, a: int, b: int, anchor: int) -> Iterator[tuple[int, int, int]]:
    """The windows from a to b, which share a hot anchor, cut where their second anchor changes: (start, end, both anchors)."""
    place, other = _anchors(groups[a : b + window - ANCHOR_WORDS], window, second=True)
    edge = np.flatnonzero(np.diff(place, prepend=-1)).tolist()
    for start, end in zip(edge, [*edge[1:], b - a]):
        both = (anchor * 31 + int(other[start]) + (1 << 63)) % (1 << 64) - (1 << 63)
        yield a + start, a + end, both


def _excerpts(window: int):
    """For the stretches of windows that share a recurring anchor: (id, excerpt) of each text, and the excerpts themselves."""
    columns = ["id", "excerpt", "anchor", "words", "low", "high"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[int, tuple[int, bytes, set[int]]] = {}
            for number, text, wanted, hot in zip(batch["id"], batch["text"], batch["anchors"], batch["hot"]):
                words = _words(text)
                if len(words) < window:
                    continue
                groups = _groups(_hashes(words))
                place, value = _anchors(groups, window)
                first = np.flatnonzero(np.diff(place, prepend=-1))
                ends = np.append(first[1:], len(place))
                hit = np.flatnonzero(_among(value[first], wanted))
                many = _among(value[first], hot)
                for k in hit.tolist():
                    a, b = int(first[k]), int(ends[k])
                    for at, end, anchor in _cuts(groups, window, a, b, int(value[a])) if many[k] else ((a, b, int(value[a])),):
                        part = b" ".join(words[at : end - 1 + window])
                        name = xxhash.xxh3_64_intdigest(part) - (1 << 63)
                        if name in seen:
                            seen[name][2].add(number)
                        else:
                            seen[name] = (anchor, part, {number})
            rows = []
            for name, (anchor, part, numbers) in seen.items():
                low, high = min(numbers), max(numbers)
                rows.append((low, name, anchor, part, low, high))
                rows += [(number, name, None, None, None, None) for number in numbers if number != low]
            yield pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in columns if c != "words"})

    return run


def _windows(parts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of excerpts together: numbers of their words, where each excerpt starts (and the end), and every window's hash, place and excerpt."""
    words = b" ".join(parts).split(b" ") if parts else []
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    codes = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    hashes = _hashes(number)[codes]
    starts = np.concatenate(([0], np.cumsum([p.count(b" ") + 1 for p in parts], dtype=np.int64)))
    many = np.maximum(np.diff(starts) - window + 1, 0)
    owner = np.repeat(np.arange(len(parts)), many)
    place = np.arange(len(owner)) + np.repeat(starts[:-1] - np.concatenate(([0], np.cumsum(many)[:-1])), many)
    return codes, starts, _rolling(hashes, window)[place], place, owner


def _spread(window: int):
    """Every window of an excerpt as a row (excerpt, removed, low, high)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            _, _, found, _, owner = _windows(list(batch["words"]), window)
            out = batch[["excerpt", "low", "high"]].iloc[owner].assign(removed=found.view(np.int64))
            yield out[["excerpt", "removed", "low", "high"]].drop_duplicates()

    return run


def _locate(window: int):
    """Excerpts sorted by anchor: (excerpt, removed, firsts), its recurring windows and the smallest id of each."""

    def found_in(rows: pd.DataFrame) -> pd.DataFrame:
        import ahocorasick

        # An anchor of one text only has nothing to tell.
        anchor = rows["anchor"].to_numpy()
        first = np.flatnonzero(np.diff(anchor, prepend=~anchor[0]))
        size = np.diff(np.append(first, len(anchor)))
        several = np.minimum.reduceat(rows["low"].to_numpy(), first) < np.maximum.reduceat(rows["high"].to_numpy(), first)
        rows = rows[np.repeat(several, size)]
        codes, starts, found, place, owner = _windows(list(rows["words"]), window)
        kinds, at, which = np.unique(found, return_index=True, return_inverse=True)
        low, high = np.full(len(kinds), np.iinfo(np.int64).max), np.full(len(kinds), np.iinfo(np.int64).min)
        np.minimum.at(low, which, rows["low"].to_numpy(np.int64)[owner])
        np.maximum.at(high, which, rows["high"].to_numpy(np.int64)[owner])
        recurs = low < high
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for kind in np.flatnonzero(recurs).tolist():
            begin = int(place[at[kind]])
            automaton.add_word(tuple(codes[begin : begin + window].tolist()), kind)
        out = []
        if len(automaton):
            automaton.make_automaton()
            names, codes = rows["excerpt"].to_numpy(), codes.tolist()
            seen: set[int] = set()
            for row in np.unique(owner[recurs[which]]).tolist():
                if names[row] not in seen:
                    seen.add(names[row])
                    hits = sorted({kind for _, kind in automaton.iter(tuple(codes[starts[row] : starts[row + 1]]))})
                    out.append((names[row], kinds[hits].view(np.int64), low[hits]))
        return pd.DataFrame(out, columns=["excerpt", "removed", "firsts"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            count += len(batch)
            if count < BATCH_ROWS:
                continue
            rows = pd.concat(held, ignore_index=True)
            last = rows["anchor"] == rows["anchor"].iloc[-1]
            if not last.all():
                yield found_in(rows[~last])
            held, count = [rows[last]], int(last.sum())
        if count:
            yield found_in(pd.concat(held, ignore_index=True))

    return run


def _cut(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, number, text, removed in zip(batch["key"], batch["id"], batch["text"], batch["removed"]):
                words = _words(text)
                if len(words) < window:
                    continue
                gone = _among(_rolling(_hashes(words), window).view(np.int64), removed)
                covered = np.zeros(len(words) + 1, dtype=np.int64)
                at = np.flatnonzero(gone)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + window, -1)
                rows.append((key, number, *_kept(words, np.cumsum(covered)[:-1] > 0)))
            yield pd.DataFrame(rows, columns=["key", "id", "n_gone", "cut_sha256"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("key"), text.alias("text"))
    survey = written(rows.mapInPandas(_survey(window), "id bigint, key binary, n_words bigint, whole_sha256 string, anchors array<bigint>"), "survey")
    firsts = written(survey.groupBy("key").agg(F.min("id").alias("first")), "firsts")

    anchors = survey.where("id is not null").select("id", F.explode("anchors").alias("anchor"))
    recurring = written(anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "recurring-anchors")
    of_text = anchors.join(recurring, "anchor").groupBy("id").agg(
        F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("n") > HOT_TEXTS, F.col("anchor"))).alias("hot"))
    wanted = written(of_text.join(firsts.select(F.col("first").alias("id")), "id", "left_semi"), "wanted")
    texts = rows.join(wanted.withColumnRenamed("id", "wanted_id"), F.col("id") == F.col("wanted_id"))
    found = written(texts.select("id", "text", "anchors", "hot").mapInPandas(
        _excerpts(window), "id bigint, excerpt bigint, anchor bigint, words binary, low bigint, high bigint"), "excerpts", compression="zstd")

    excerpts = found.where("words is not null").select("anchor", "excerpt", "words", "low", "high")
    crowded = written(excerpts.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED_ROWS).select("anchor"), "crowded")
    if crowded.isEmpty():
        shards, rest = excerpts, None
    else:
        shards = excerpts.join(crowded, "anchor", "left_anti")
        spread = written(excerpts.join(crowded, "anchor", "left_semi").mapInPandas(
            _spread(window), "excerpt bigint, removed bigint, low bigint, high bigint"), "crowded-windows")
        spans = spread.groupBy("removed").agg(F.min("low").alias("first"), F.max("high").alias("last")).where(F.col("first") < F.col("last"))
        rest = (spread.select("excerpt", "removed").join(spans.select("removed", "first"), "removed")
                .groupBy("excerpt").agg(F.collect_set(F.struct("removed", "first")).alias("hits"))
                .select("excerpt", F.col("hits.removed").alias("removed"), F.col("hits.first").alias("firsts")))
    shards = shards.repartition("anchor").sortWithinPartitions("anchor")
    located = shards.mapInPandas(_locate(window), "excerpt bigint, removed array<bigint>, firsts array<bigint>")
    located = located if rest is None else located.union(rest)
    earlier = F.filter("removed", lambda _, i: F.get("firsts", i) < F.col("id"))
    removed = (found.select("id", "excerpt").join(located, "excerpt")
               .select("id", earlier.alias("removed")).where(F.size("removed") > 0)
               .groupBy(F.col("id").alias("cut_id")).agg(F.flatten(F.collect_list("removed")).alias("removed")))
    cut = written(rows.join(removed, F.col("id") == F.col("cut_id")).select("key", "id", "text", "removed")
                  .mapInPandas(_cut(window), "key binary, id bigint, n_gone bigint, cut_sha256 string"), "cut")
    cut = cut.dropDuplicates(["key", "id"]).select(F.col("key").alias("cut_key"), F.col("id").alias("cut_id"), "n_gone", "cut_sha256")
    labels = firsts.join(cut, (F.col("key") == F.col("cut_key")) & (F.col("first") == F.col("cut_id")), "left").select(
        F.col("key").alias("label_key"), "first", "n_gone", "cut_sha256")
    later = (F.col("id") > F.col("first")) & (F.col("n_words") >= window)
    own = F.col("id").isNotNull() & F.col("n_gone").isNotNull()
    return survey.join(labels, F.col("key") == F.col("label_key"), "left").select(
        F.col("id").alias(id_col), "n_words",
        F.when(later, F.col("n_words")).when(own, F.col("n_gone")).otherwise(0).cast("bigint").alias("n_removed"),
        F.when(later, F.lit(hashlib.sha256().hexdigest())).when(own, F.col("cut_sha256")).otherwise(F.col("whole_sha256")).alias("kept_sha256"),
    )
