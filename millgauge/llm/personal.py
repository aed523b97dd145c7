"""Personal data: fixed rules as seeds, bootstrapped contextual patterns for what the rules miss.

Method: spans found by four rules are seeds. Every identifier-like token and every seed is an
instance, the word before it is a lexical pattern. Spark scores the pattern-instance graph in
rounds: a pattern's score for a kind is the share of its occurrences whose instance is believed to
be of that kind; an instance is believed as far as its patterns say (one minus the product of their
doubts). Patterns that score at least ``MIN_SCORE`` with ``MIN_VALUES`` different believed instances mark the
unseen identifiers that follow them. Everything is DataFrame functions.

Rules are rewritten so that no text makes them slow: a run is entered only at its start or where
the last match ended (``\\G``), and never given back, which finds the same matches.

Defined cases: null text is empty; empty text has no spans; rows with a null id keep a row; repeated rows
give equal rows; an empty table gives an empty result; found spans never overlap rule spans; of
overlapping found spans the one that starts first stays; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

KINDS = ("email", "ip", "card", "phone")
MIN_SCORE = 0.8
MIN_VALUES = 5
ROUNDS = 3
CONTEXT_CHARS = 40  # the word before counts up to this length

RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}  # no match without this character
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
TOKEN = r"(?:\G|(?<![A-Za-z0-9_@.%+-]))[A-Za-z_.%-]*+[0-9@+](?:[A-Za-z0-9_@.%+-]*[A-Za-z0-9_])?"
TOKEN_CHARS = (5, 64)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _spans(found: str, between: str, holds) -> Column:
    """Spans of matches, with value and text before, from the matches and the texts between them; positions in code points."""

    def step(state: Column, i: Column) -> Column:
        value, start = F.get(found, i), state["pos"] + F.length(F.get(between, i))
        end = start + F.length(value)
        fields = [start.alias("start"), end.alias("end"), F.lower(value).alias("value"),
                  F.right(F.get(between, i), F.lit(CONTEXT_CHARS + 8)).alias("before")]
        return F.struct(end.alias("pos"), F.when(holds(value), F.array_append(state["out"], F.struct(*fields))).otherwise(state["out"]).alias("out"))

    empty = F.array().cast("array<struct<start: int, end: int, value: string, before: string>>")
    steps = F.sequence(F.lit(0), F.size(found) - 1)
    folded = F.aggregate(steps, F.struct(F.lit(0).alias("pos"), empty.alias("out")), step, lambda s: s["out"])
    return F.when(F.size(found) > 0, folded).otherwise(empty)


def rule_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, uid, one array of spans per kind, tokens): all rule matches and identifier-like tokens of each text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    for name, rule in (*RULES.items(), ("token", TOKEN)):
        need = F.contains("text", F.lit(NEEDS[name])) if name in NEEDS else F.lit(True)
        none = F.array().cast("array<string>")
        rows = rows.withColumns({
            f"{name}_found": F.when(need, F.regexp_extract_all("text", F.lit(rule), F.lit(0))).otherwise(none),
            f"{name}_between": F.when(need, F.split("text", rule, -1)).otherwise(none),
        })
    long_enough = lambda v: F.length(v).between(*TOKEN_CHARS)
    return rows.select(
        "id", F.monotonically_increasing_id().alias("uid"),
        *[_spans(f"{k}_found", f"{k}_between", lambda v, k=k: _holds(k, v)).alias(k) for k in KINDS],
        _spans("token_found", "token_between", long_enough).alias("tokens"),
    )


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.named_struct(F.lit("kind"), F.lit(kind), F.lit("start"), s["start"], F.lit("end"), s["end"]))


def _of_kind(found: str, kind: str) -> Column:
    none = F.array().cast("array<struct<start: int, end: int, found_kind: string>>")
    return F.coalesce(F.filter(found, lambda s: s["found_kind"] == kind), none)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _occurrences(rows: DataFrame) -> DataFrame:
    """(uid, before, value, start, end, kind): rule spans with their kind, tokens apart from them without.

    A span of several words ("4111 1111 1111 1111") is one instance. Where spans of two kinds overlap, the first of ``KINDS`` counts.
    """
    apart = lambda spans, others: F.filter(spans, lambda t: ~F.exists(others, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    taken, instances = None, []
    for k in (*KINDS, None):
        spans = F.col(k or "tokens") if taken is None else apart(F.col(k or "tokens"), taken)
        kind = F.lit(k).cast("string")
        instances.append(F.transform(spans, lambda s: F.named_struct(  # called at once
            *[x for name in ("start", "end", "value", "before") for x in (F.lit(name), s[name])], F.lit("kind"), kind)))  # noqa: B023
        if k:
            taken = F.col(k) if taken is None else F.concat(taken, F.col(k))
    tokens = rows.select("uid", F.explode(F.concat(*instances)).alias("t"))
    word = F.lower(F.regexp_extract(F.col("t.before"), r"(\S{1,%d})\s*$" % CONTEXT_CHARS, 1))
    return tokens.select(
        "uid", word.alias("before"), F.col("t.value").alias("value"), F.col("t.start").alias("start"), F.col("t.end").alias("end"),
        F.col("t.kind").alias("kind"),
    )


def patterns(edges: DataFrame, rounds: int = ROUNDS, min_score: float = MIN_SCORE, min_values: int = MIN_VALUES) -> DataFrame:
    """(before, kind, score, support) of trusted patterns; ``edges`` has (before, value, kind or null, n)."""
    totals = edges.groupBy("before").agg(F.sum("n").alias("all"))
    seeds = edges.where("kind is not null").select("value", "kind").distinct().withColumn("belief", F.lit(1.0))
    believed = seeds
    for _ in range(rounds):
        scored = (edges.select("before", "value", "n").join(believed, "value")
                  .groupBy("before", "kind").agg(F.sum(F.col("n") * F.col("belief")).alias("mass"), F.count_distinct("value").alias("support"))
                  .join(totals, "before").select("before", "kind", (F.col("mass") / F.col("all")).alias("score"), "support")
                  .where((F.col("before") != "") & (F.col("score") >= min_score) & (F.col("support") >= min_values)))
        trusted = written(scored, "patterns")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        new = (edges.where("kind is null").select("before", "value").distinct().join(trusted, "before")
               .groupBy("value", "kind").agg((1 - doubt).alias("belief")).where(F.col("belief") >= min_score))
        best = new.groupBy("value").agg(F.max_by("kind", F.struct("belief", "kind")).alias("kind"), F.max("belief").alias("belief"))
        believed = seeds.union(best.join(seeds, "value", "left_anti").select("value", "kind", "belief"))
    return trusted


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_<kind>, base_sha256, spans (text) and span_list (kind, start, end; all spans in order)."""
    rows = written(rule_spans(docs, id_col, text_col), "rule-spans")
    seen = _occurrences(rows)
    edges = written(seen.groupBy("before", "value", "kind").agg(F.count("*").alias("n")), "edges")
    trusted = patterns(edges).groupBy("before").agg(F.max_by("kind", F.struct("score", "kind")).alias("found_kind"))
    found = (seen.where("kind is null").join(trusted, "before")
             .groupBy("uid").agg(F.collect_list(F.struct("start", "end", "found_kind")).alias("found")))
    rule = {k: _tagged(F.col(k), k) for k in KINDS}
    both = F.concat(*[F.array_sort(F.concat(rule[k], _tagged(_of_kind("found", k), k))) for k in KINDS])
    return rows.join(found, "uid", "left").select(
        F.col("id").alias(id_col),
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.concat(*rule.values())), 256).alias("base_sha256"),
        _joined(both).alias("spans"),
        both.alias("span_list"),
        "uid",
    )


def mask(docs: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; ``id_col`` must tell all rows apart.

    Overlapping spans are replaced together, under the name of the one that starts first.
    """
    found = extract(docs, id_col, text_col).where(F.size("span_list") > 0).select(
        F.col(id_col).alias("masked id"),
        F.array_sort(F.transform("span_list", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).alias("masked spans"))
    text = F.col(f"`{text_col}`")

    def step(state: Column, s: Column) -> Column:
        kept = F.substring(text, state["pos"] + 1, s["start"] - state["pos"])
        return F.when(s["start"] < state["pos"], F.struct(F.greatest(state["pos"], s["end"]).alias("pos"), state["out"].alias("out"))).otherwise(
            F.struct(s["end"].alias("pos"), F.concat(state["out"], kept, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out")))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    masked = F.aggregate("masked spans", start, step, lambda s: F.concat(s["out"], F.substring(text, s["pos"] + 1, F.length(text))))
    joined = docs.join(found, F.col(f"`{id_col}`") == F.col("masked id"), "left")
    return joined.withColumn(text_col, F.when(F.col("masked id").isNull(), text).otherwise(masked)).select(*[f"`{c}`" for c in docs.columns])
