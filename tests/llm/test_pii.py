from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlint.llm import pii as P

# The base as stated, in plain Python.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def ok(kind, s):
    d = re.sub("[^0-9]", "", s)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in s.split(".")), "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()


def brute(rows):
    out = Counter()
    for i, t in rows:
        spans = [(k, m.start(), m.end()) for k in P.KINDS for m in re.finditer(STATED[k], t or "") if ok(k, m[0])]
        n = Counter(k for k, _, _ in spans)
        out[(i, *(n[k] for k in P.KINDS), hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest())] += 1
    return out


def card(rng, n=16):
    d = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(d + c for c in "0123456789" if luhn(d + c))


TEXTS = [None, "", "a@b.c", "a@b.c_x@d.e", "a@b.c@d.e", "x a@b. a@b a.b@c-d.e.f.", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.001 1.1.1.00000000000000000000", "é🙂 a@b.cd 1.2.3.4", "4111 1111-1111 1111", "4111111111111111 4111111111111112", "+1 (523) 555-1055", "+12 3", "+1234567 +1-2-3-4-5-6-7-8-", "++1 5555555 5",
         "9" * 60_000, "a" * 150_000 + "@b.c", "a." * 30_000 + "@", "1." * 30_000, "1 " * 30_000, "x@" + "y." * 30_000 + "z", "+1" + " (" * 30_000, "4111 1111 1111 1111 4111 1111 1111 1111", "1.2.3.4@x.y", "a@b.c%d@e.f+g@h.i", "1.2.3.4 " * 5000]


def test_base_against_the_stated_patterns(spark, docs_of):
    rng = random.Random(8)
    fuzz = ["".join(rng.choice("a1b2@..+-- ()é%_9") for _ in range(rng.randrange(60))) for _ in range(1500)]
    rows = list(enumerate(TEXTS + fuzz)) + [(None, "a@b.c"), (2, "a@b.c")]
    docs = docs_of(rows).withColumns({c: F.lit(1) for c in ("body", "items", "kind", "base", "spans", "n")})
    got = P.detected(docs.repartition(4)).collect()
    assert Counter(tuple(r)[:6] for r in got) == brute(rows)
    for r in got:
        kinds = [s.split(":")[0] for s in r.spans.split(",") if s]
        assert len(kinds) == sum(tuple(r)[1:5]) + r.n_added


def test_looser_forms_join_the_base_and_plain_numbers_do_not(spark, docs_of):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        rows.append((i, f"word words call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} or mail x{i}@mail.example.com now"))
        rows.append((1000 + i, f"in {rng.randrange(1000, 9999)} there were {rng.randrange(10**6)} of them, {rng.randrange(10**15, 10**16 - 1)} id {rng.randrange(100)}.{rng.randrange(10)}"))
    rows += [(5000, "please call (523) 555-1055 today"), (5001, "write to y5 [at] mail.example.com now")]
    got = {r.doc_id: r for r in P.detected(docs_of(rows)).collect()}
    assert got[5000].spans == "phone:12:26" and got[5001].spans == "email:9:33"
    assert not any(got[1000 + i].n_added for i in range(400))
    text = {r.doc_id: r.text for r in P.redacted(docs_of(rows[:2] + rows[-2:])).collect()}
    assert text[0] == "word words call <phone> or mail <email> now"


def test_loose_forms_as_frequent_as_base_ones_are_added(spark, docs_of):
    rng = random.Random(10)
    rows, want = [], {}
    for i in range(300):
        rows.append((i, f"call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} or mail x{i}@mail.example.com now"))
        mail = f"y{i} [at] mail.example.com"
        a, b = f"please call ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", f" or write to {mail}"
        head = f"37{rng.randrange(10**12):012d}"
        amex = next(head + c for c in "0123456789" if luhn(head + c))
        c = f" from 10[.]{i % 256}[.]3[.]4"
        rows.append((1000 + i, f"{a}{b}{c} paid {amex} then"))
        at = rows[-1][1].index(" from ") + 6
        want[1000 + i] = {f"phone:12:{len(a)}", f"email:{len(a + b) - len(mail)}:{len(a + b)}", f"ip:{at}:{at + len(c) - 6}", f"card:{rows[-1][1].index(amex)}:{rows[-1][1].index(amex) + 15}"}
        rows.append((2000 + i, f"sums 12 {rng.randrange(100, 999)} {rng.randrange(100, 999)} and {rng.randrange(10**12, 2 * 10**12)} ms"))
    got = {r.doc_id: r for r in P.detected(docs_of(rows)).collect()}
    assert all(want[i] <= set(got[i].spans.split(",")) for i in want)
    assert not any(got[2000 + i].spans for i in range(300))


def test_telling_words_are_whole_words_and_base_spans_stand_alone(spark, docs_of):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        phone = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        rows += [(i, f"call +1 {phone} now"), (1000 + i, f"please call {phone} today"), (2000 + i, f"years {rng.randrange(1000, 2000)}-{rng.randrange(1000, 2000)} {rng.randrange(1000, 2000)} in all")]
    odd = ["basically 1990-1995 2000", "the hotel 1999/2003/1200 rooms", "excellent 12 345 6789 points", "plain 1990-1995 2000"]
    rows += [(5000 + i, x) for i, x in enumerate(odd)] + [(6000, "please call 193.195.198.107 now"), (6001, "a very long wordthathotel 1999/2003/1200")]
    got = {r.doc_id: r for r in P.detected(docs_of(rows)).collect()}
    assert all(got[1000 + i].spans for i in range(400)) and not any(got[2000 + i].spans for i in range(400))
    assert [got[5000 + i].spans for i in range(len(odd))] == [""] * len(odd)
    assert got[6000].spans == "ip:12:27" and got[6001].spans == ""


def test_evidence_alone_selects_nothing(spark, docs_of, monkeypatch):
    rows = [(i, f"please call (523) 555-{1000 + i} today") for i in range(200)]
    assert all(r.n_added for r in P.detected(docs_of(rows)).collect())
    monkeypatch.setattr(P, "thresholds", lambda *_: [2.0] * 4)
    assert not any(r.n_added for r in P.detected(docs_of(rows)).collect())


def test_many_base_spans_do_not_let_any_looser_one_pass(spark, docs_of):
    rng = random.Random(12)
    rows = [(i, f"call +1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}") for i in range(2000)]
    rows += [(5000 + i, f"years {rng.randrange(1000, 2000)}-{rng.randrange(1000, 2000)} {rng.randrange(1000, 2000)}") for i in range(100)]
    assert not any(r.n_added for r in P.detected(docs_of(rows)).collect())


def test_trees_learn():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, (300, 3))
    label = ((x[:, 0] > 1) & (x[:, 1] < 2)).astype(float)
    first, trees = P.fit(x, label, np.ones(300))
    margin = sum((P._value(t, x) for t in trees), np.full(300, first))
    assert ((margin > 0) == (label > 0)).all()


def test_thresholds_take_ties_together():
    kind, score = np.zeros(4, int), np.array([0.9, 0.9, 0.5, 0.1])
    assert P.thresholds(kind, score, np.array([1.0, 0, 1, 0]), np.array([99.0, 1, 50, 500]))[0] == 0.5
    assert P.thresholds(kind, score, np.array([1.0, 0, 1, 0]), np.ones(4))[0] == 2.0


def test_native_plan_and_empty_table(spark, docs_of):
    plan = P.detected(docs_of([(1, "a@b.c")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", P.proposals(docs_of([(1, "a@b.c")]))._jdf.queryExecution().toString())
    assert P.detected(docs_of([])).count() == 0 and P.detected(docs_of([(1, "x")])).first().spans == ""
