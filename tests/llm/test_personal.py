import hashlib
import random
import re

from docs_fixture import docs_of  # noqa: F401
from millgauge.llm import personal

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_rules_find_what_the_plain_patterns_find(docs_of):
    rng = random.Random(4)
    fixed = ["", None, "é😀 a.b+c@x-y.org, b@c.d_x@d.e", "1.2.3.4.5.6.7.8 300.1.1.1 000.1.02.255", "4111 1111 1111 1111 and 4111-1111-1111-1112",
             "+1 (234) 555-2485. +12", "a@b a@b. a@b.c.", "9" * 5000, "x" * 50_000 + "@", "1." * 5000, "4111111111111111 " * 300]
    soup = ["".join(rng.choice("ab1234567890.@+- ()%é_") for _ in range(300)) for _ in range(150)]
    rows = list(enumerate(fixed + soup))
    got = {r.doc_id: r for r in personal.extract(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        spans = base(text)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(line.encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in personal.KINDS] == [sum(s[0] == k for s in spans) for k in personal.KINDS]
        assert set(filter(None, line.split(","))) <= set(got[i].spans.split(","))


def test_contexts_reveal_unseen_identifiers(docs_of):
    rows = [(k, f"word {k} mail: user{k}@site{k}.com and more") for k in range(20)] + [(50, "please mail: user99_at_site99 today"), (51, "see user99_at_site99 here")]
    got = {r.doc_id: r.spans for r in personal.extract(docs_of(rows)).collect()}
    assert got[50] == "email:13:29"
    assert got[51] == ""
    assert got[3].count("email") == 1


def valid_card(k):
    head = f"4{k:014d}"
    return next(c for c in (head + str(d) for d in range(10)) if luhn(c))


def test_contexts_of_spaced_cards_and_bracketed_phones(docs_of):
    spaced = lambda c: " ".join(c[k : k + 4] for k in range(0, 16, 4))
    rows = [(k, f"paid by visa: {spaced(valid_card(k * 7919))} today") for k in range(20)]
    rows += [(20 + k, f"ring phone: +1 ({200 + k}) 555-{3000 + k} today") for k in range(20)]
    rows += [(50, "paid by visa: 4111-1111-1111-1112 today"), (51, "ring phone: 555-384-2000 today"), (52, "see 555-384-2000 (here) 555-3824")]
    got = {r.doc_id: r.spans for r in personal.extract(docs_of(rows)).collect()}
    assert got[50] == "card:14:33" and got[51] == "phone:12:24" and got[52] == ""
    assert all(got[k].count("card") == 1 and got[20 + k].count("phone") == 1 and "," not in got[k] + got[20 + k] for k in range(20))


def test_masking_repeats_and_empty(spark, docs_of):
    rows = docs_of([(1, "mail a@b.cd now"), (1, "mail a@b.cd now"), (None, "1.2.3.4"), (2, None), (3, "")]).selectExpr("monotonically_increasing_id() AS n", "*")
    got = [(r.doc_id, r.text) for r in personal.mask(rows, "n").orderBy("n").collect()]
    assert got == [(1, "mail [EMAIL] now"), (1, "mail [EMAIL] now"), (None, "[IP]"), (2, None), (3, "")]
    assert personal.extract(docs_of([])).count() == 0
