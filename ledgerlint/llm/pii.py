"""Personal data by candidate gradient boosting.

High-recall generators propose spans that may overlap: the *base* patterns of
four kinds with their checks, and looser forms of each kind.  Boosted trees
score every proposal from its format (digits, separators, check sum, brackets)
and context (a telling word before it, what stands at its ends).  They learn
from the proposals of one half of the given corpus (dealt by a hash of the
text).  Positives are the base spans and the looser ones with evidence that does
not rest on the base form (:func:`_evident`: check sums with an issuer's first
digits, bracketed addresses, a telling word before a phone or an obfuscated
mail).  Phones and mails of one format without a telling word are positives too
if the format has one about as often as base spans have (see :func:`labels`),
however frequent it is.  All else is unlabelled (counted as negative).  These
labels are noisy, and select nothing by themselves; the mark that defines the
base form (``+``, ``@``) is not a feature.  A proposal's score then says how far
spans of its looks are personal data of that kind.

Scores are calibrated for each kind on the other half: the threshold is the
least score at and above which at least ``PRECISION`` of the proposals are
positives, where base spans weigh no more in all than looser ones, and at least
``PRECISION`` of the looser ones alone (else many base spans would let others pass).  A looser span is added if it overlaps no base span of
any kind and its score reaches the threshold; base spans always stay.  A kind without
positives in the second half gets no additions.

Features are binned, so the corpus comes down to counts of at most
``GRID`` different feature rows, on which the driver fits the trees; their answer
for each of these rows is joined back.  All work on texts is done by DataFrame
functions.

Patterns use possessive quantifiers where they match the same: they neither
recurse nor go back in very long runs.

Defined cases: a null text is empty; a text without proposals has counts 0 and
an empty ``spans``; repeated rows have equal results; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlint.llm.common import written

KINDS = ("email", "ip", "card", "phone")
# The base patterns, each in a form that matches the same without recursion (cards: only runs of the right length).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that every text with a match passes.
HINT = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": lambda t: t.rlike(r"\+[0-9][\x20().0-9-]"),
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\x20?[.\[\]()]{1,3}+\x20?[0-9]{1,3}+){3}+(?![0-9.])",
    "card": r"(?<![0-9])[0-9]{4,6}+(?:[\x20._-]?[0-9]{3,6}+){1,4}+(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}+\)?[\x20./-]{1,2}+[0-9]{3,4}+[\x20./-][0-9]{3,4}+(?![0-9])",
}
LOOSE_HINT = {
    "email": lambda t: t.contains("@") | t.contains("(at)") | t.contains("[at]"),
    "ip": lambda t: t.rlike(r"[0-9]\x20?[.\[\]()]{1,3}+\x20?[0-9]{1,3}+\x20?[.\[\]()]{1,3}+\x20?[0-9]"),
    "card": lambda t: t.rlike(r"[0-9]{4}[\x20._-]?[0-9]{3}"),
    "phone": lambda t: t.rlike(r"[0-9]{2}\)?[\x20./-]{1,2}+[0-9]{3,4}+[\x20./-][0-9]{3}"),
}
#: Telling words, as whole words.
CONTEXT = {
    kind: rf"(?i)(?<!\p{{L}})(?:{words})(?!\p{{L}})"
    for kind, words in {
        "email": "e-?mails?|mails?|mailto|contact|write|reach",
        "ip": "ip|hosts?|servers?|address|gateway",
        "card": "cards?|visa|credit|payment|account",
        "phone": "phones?|telephone|tel|calls?|mobile|fax|cell",
    }.items()
}
#: (feature, number of bins)
FEATURES = (("digits", 6), ("separators", 4), ("checksum", 2), ("brackets", 2), ("context", 2), ("before", 3), ("after", 3))
GRID = len(KINDS) * int(np.prod([n for _, n in FEATURES])) * 3
ROUNDS = 20
DEPTH = 3
RATE = 0.3
PRECISION = 0.9
_CONTEXT_CHARS = 24


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    each = F.split(F.reverse(digits), "")
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _of_kind(value) -> Column:
    """A column whose value depends on the row's kind."""
    return reduce(lambda other, k: F.when(F.col("kind") == k, value(KINDS[k])).otherwise(other), range(len(KINDS) - 1), value(KINDS[-1]))


def _checks() -> dict[str, Column]:
    """What makes a span a base span, by kind; digits are in ``digits_only``."""
    n = F.length("digits_only")
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return {
        "email": F.lit(True),
        "ip": F.col("span").rlike(rf"\A{part}(?:\.{part}){{3}}\z"),
        "card": F.when(n.between(16, 19), _luhn(F.col("digits_only"))).otherwise(False),
        "phone": n.between(8, 15),
    }


def _evident() -> dict[str, Column]:
    """What makes a looser span a positive, by kind, whatever the base form is."""
    n = F.length("digits_only")
    told = lambda k: F.col("ahead").rlike(CONTEXT[k])
    part = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    # Lengths and first digits that issuers use; with odd separators, all groups but the last are alike.
    issued = F.col("digits_only").rlike(r"\A(?:4[0-9]{12}|3(?:0|6|8|9)[0-9]{12}|3[47][0-9]{13}|[2-6][0-9]{15,18})\z")
    issued = issued & F.col("span").rlike(r"\A(?:[0-9]++|(?:[0-9]{4}[\x20._-]){3,4}[0-9]{1,4}|[0-9]{4}[\x20._-][0-9]{6}[\x20._-][0-9]{4,5})\z")
    return {
        "email": told("email") & F.col("span").rlike(r"(?:\(at\)|\[at\]).*[A-Za-z]{2}\z"),
        "ip": F.col("span").rlike(rf"\A{part}(?:\x20?(?:\[\.\]|\(\.\))\x20?{part}){{3}}\z"),
        "card": F.when(issued, _luhn(F.col("digits_only"))).otherwise(False),
        "phone": told("phone") & n.between(8, 15),
    }


def _end_class(char: Column) -> Column:
    """0: nothing or white space, 1: a letter or digit, 2: anything else."""
    return F.when(char.rlike(r"\A\s*+\z"), 0).when(char.rlike(r"\A[\p{L}\p{N}]\z"), 1).otherwise(2)


def _features() -> dict[str, Column]:
    bins = {"email": (1, 2, 3, 5, 8), "ip": (5, 7, 9, 11, 13), "card": (13, 15, 16, 17, 20), "phone": (7, 8, 10, 12, 16)}
    n = F.length("digits_only")
    bare = F.regexp_replace("span", r"\A\+", "")  # the mark that makes the base form is left out
    checks = {
        "email": bare.rlike(r"[A-Za-z]{2}\z"),
        "ip": ~F.col("span").rlike("[0-9]{4}"),
        "card": F.when(n.between(13, 19), _luhn(F.col("digits_only"))).otherwise(False),
        "phone": n.between(8, 15),
    }
    return {
        "digits": _of_kind(lambda k: sum((F.when(n >= b, 1).otherwise(0) for b in bins[k][1:]), F.when(n >= bins[k][0], 1).otherwise(0))),
        "separators": F.least(F.regexp_count(bare, F.lit(r"[\x20._/-]++")), F.lit(3)),
        "checksum": _of_kind(lambda k: checks[k]).cast("int"),
        "brackets": bare.rlike(r"[()\[\]]").cast("int"),
        "context": _of_kind(lambda k: F.col("ahead").rlike(CONTEXT[k])).cast("int"),
        "before": F.when((F.col("prev") == "") & (F.col("i") > 0), 1).otherwise(_end_class(F.col("prev"))),
        "after": _end_class(F.col("next")),
    }


def proposals(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base spans, and looser ones that overlap no base span of any kind, a row each.

    rid (a number of the document's row), doc_id, half (0 or 1, by the text), kind, start, end (code points),
    base, sure (base, or with evidence) and features; each document also has one row without a kind.
    """
    body = F.col("body")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), docs[id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("body"))
    rows = rows.withColumn("half", F.pmod(F.xxhash64("body"), F.lit(2)).cast("int"))
    patterns = [(k, base, table[kind], hints[kind]) for base, table, hints in ((True, BASE, HINT), (False, LOOSE, LOOSE_HINT)) for k, kind in enumerate(KINDS)]
    found = rows.select(
        "rid",
        "doc_id",
        "half",
        *[F.when(hint(body), F.regexp_extract_all(body, F.lit(p), F.lit(0))).alias(f"found{j}") for j, (_, _, p, hint) in enumerate(patterns)],
        *[F.when(hint(body), F.split(body, p, -1)).alias(f"gaps{j}") for j, (_, _, p, hint) in enumerate(patterns)],
    )

    shape = "struct<kind:int,strict:boolean,i:int,gap:int,span:string,ahead:string,prev:string,next:string>"
    # The last characters before a span, without the rest of a word that they cut.
    ahead = lambda gap: F.when(F.length(gap) <= _CONTEXT_CHARS, gap).otherwise(F.regexp_replace(F.right(gap, F.lit(_CONTEXT_CHARS)), r"\A\p{L}++", ""))

    def pieces(j: int, kind: int, base: bool) -> Column:
        gaps = F.col(f"gaps{j}")
        zipped = F.arrays_zip(F.col(f"found{j}").alias("span"), gaps.alias("gap"), F.slice(gaps, F.lit(2), F.greatest(F.size(gaps), F.lit(1))).alias("next"))
        piece = lambda z, i: F.struct(
            F.lit(kind).alias("kind"), F.lit(base).alias("strict"), i.alias("i"), F.length(z["gap"]).alias("gap"), z["span"].alias("span"),
            ahead(z["gap"]).alias("ahead"), F.right(z["gap"], F.lit(1)).alias("prev"), F.left(z["next"], F.lit(1)).alias("next"),
        )
        none = F.array().cast(f"array<{shape}>")
        return F.coalesce(F.filter(F.transform(zipped, piece), lambda x: x["span"].isNotNull()), none)

    document = F.array(F.lit(None).cast(shape))
    every = F.concat(document, *[pieces(j, kind, base) for j, (kind, base, _, _) in enumerate(patterns)])
    # Ends are running sums of the lengths of gaps and spans; this and what follows are windows within one document, dealt once.
    apart = found.select("rid", "doc_id", "half", F.explode(every).alias("s")).select("rid", "doc_id", "half", "s.*").repartition("rid")
    run = Window.partitionBy("rid", "kind", "strict").orderBy("i")
    placed = apart.withColumn("end", F.sum(F.col("gap").cast("long") + F.length("span")).over(run))
    placed = placed.withColumn("start", F.col("end") - F.length("span")).withColumn("digits_only", _digits(F.col("span")))
    placed = placed.withColumn("base", F.col("strict") & _of_kind(_checks().get)).filter("kind is null or base or not strict")
    by_start = Window.partitionBy("rid").orderBy("start", "end")
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    base_start = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    placed = placed.withColumn("base_end", base_end).withColumn("base_start", base_start)
    overlaps = (F.coalesce("base_end", F.lit(-1)) > F.col("start")) | (F.coalesce(F.col("base_start") < F.col("end"), F.lit(False)))
    kept = placed.filter(F.col("kind").isNull() | F.col("base") | ~overlaps)
    return kept.select("rid", "doc_id", "half", "kind", "start", "end", "base", (F.col("base") | F.coalesce(_of_kind(_evident().get), F.lit(False))).alias("sure"), *[f.alias(n) for n, f in _features().items()])


def _best_split(x: np.ndarray, g: np.ndarray, h: np.ndarray):
    """(gain, feature, bin) of the split ``x[feature] <= bin`` that helps most."""
    value = lambda a, b: a * a / (b + 1.0)
    best = (1e-6, None, None)
    for f in range(x.shape[1]):
        top = int(x[:, f].max()) + 1
        gs, hs = np.bincount(x[:, f], g, top).cumsum(), np.bincount(x[:, f], h, top).cumsum()
        for b in range(top - 1):
            gain = value(gs[b], hs[b]) + value(gs[-1] - gs[b], hs[-1] - hs[b]) - value(gs[-1], hs[-1])
            if gain > best[0]:
                best = (gain, f, b)
    return best


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int):
    """A tree: a leaf's value, or (feature, bin, low, high)."""
    gain, f, b = _best_split(x, g, h) if depth and len(x) > 1 else (0, None, None)
    if f is None:
        return float(-RATE * g.sum() / (h.sum() + 1.0))
    low = x[:, f] <= b
    return (f, b, _grow(x[low], g[low], h[low], depth - 1), _grow(x[~low], g[~low], h[~low], depth - 1))


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, b, low, high = tree
    return np.where(x[:, f] <= b, _value(low, x), _value(high, x))


def fit(x: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """Boosted trees under logistic loss on weighted feature rows: (first value, trees)."""
    share = (weight * label).sum() / weight.sum()
    first = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    score = np.full(len(x), first)
    trees = []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        trees.append(_grow(x, weight * (p - label), weight * np.maximum(p * (1 - p), 1e-6), DEPTH))
        score += _value(trees[-1], x)
    return first, trees


def labels(x: np.ndarray, base: np.ndarray, sure: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """1 for positives: sure spans, and phones and mails of a format that has a telling word as often as base spans have.

    Base spans are personal data with or without such a word, so their share with it says how often it stands
    before personal data; a format's share by that one estimates how far its spans are personal data.
    """
    out = sure.astype(float)
    names = ["kind", *[f for f, _ in FEATURES]]
    context, where = x[:, names.index("context")], [i for i, f in enumerate(names) if f not in ("context", "before", "after")]
    for k in (KINDS.index("email"), KINDS.index("phone")):
        strict, loose = (x[:, 0] == k) & (base > 0), (x[:, 0] == k) & (base == 0)
        known = (weight * strict * context).sum() / weight[strict].sum() if strict.any() else 1.0
        for form in np.unique(x[loose][:, where], axis=0):
            own = loose & (x[:, where] == form).all(axis=1)
            if known and (weight * own * sure).sum() >= PRECISION * known * weight[own].sum():
                out[own] = 1.0
    return out


def thresholds(kind: np.ndarray, score: np.ndarray, label: np.ndarray, weight: np.ndarray, loose: np.ndarray | None = None) -> list[float]:
    """For each kind the least score at and above which PRECISION of the proposals, and of the ``loose`` ones alone, are positives; above 1 if none is."""
    out = []
    loose = np.zeros(len(kind), bool) if loose is None else loose
    for k in range(len(KINDS)):
        own = np.flatnonzero(kind == k)
        own = own[np.argsort(-score[own], kind="stable")]
        right, all_ = np.cumsum((label * weight)[own]), np.cumsum(weight[own])
        right_loose, all_loose = np.cumsum((label * weight * loose)[own]), np.cumsum((weight * loose)[own])
        last = np.append(score[own][1:] < score[own][:-1], True) if len(own) else np.empty(0, bool)  # ties are taken together
        good = np.flatnonzero((right >= PRECISION * all_) & (right_loose >= PRECISION * all_loose) & last) if len(own) else []
        out.append(float(score[own][good[-1]]) if len(good) else 2.0)
    return out


def _accepted(x: np.ndarray, base: np.ndarray, sure: np.ndarray, half: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Whether spans of each feature row reach their kind's threshold: trees from one half, thresholds from the other."""
    label, learn = labels(x, base, sure, weight), half == 0
    if not learn.any():
        return np.zeros(len(x), bool)
    first, trees = fit(x[learn], label[learn], weight[learn])
    score = 1 / (1 + np.exp(-sum((_value(t, x) for t in trees), np.full(len(x), first))))
    even = weight.copy()
    for k in range(len(KINDS)):
        strict, loose = (x[:, 0] == k) & (base > 0) & ~learn, (x[:, 0] == k) & (base == 0) & ~learn
        if strict.any():
            even[strict] *= min(1.0, weight[loose].sum() / weight[strict].sum())
    limits = np.array(thresholds(x[~learn, 0], score[~learn], label[~learn], even[~learn], base[~learn] == 0))
    return score >= limits[x[:, 0]] - 1e-9


def detected(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    found = written(proposals(docs, id, text), "proposals")
    names = ["kind", *[f for f, _ in FEATURES]]
    grid = found.filter("kind is not null").groupBy(*names, "base", "sure", "half").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 * GRID rows
    grid.sort()
    x = np.array([[r[n] for n in names] for r in grid], np.int64).reshape(-1, len(names))
    base, sure, half, weight = (np.array([float(r[c]) for r in grid]) for c in ("base", "sure", "half", "n"))
    added = sorted({tuple(map(int, row)) for row in x[_accepted(x, base, sure, half, weight)]})
    # The trees' answer for every feature row there is: a table of at most GRID rows.
    answers = docs.sparkSession.createDataFrame([(*row, True) for row in added], ", ".join(f"{n} int" for n in names) + ", added boolean")
    scored = found.join(F.broadcast(answers), names, "left")
    chosen = F.col("kind").isNotNull() & (F.col("base") | F.coalesce("added", F.lit(False)))
    spans = scored.select("rid", "doc_id", "base", F.when(chosen, F.struct("kind", "start", "end")).alias("span"))
    joined = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda s: F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.when(F.col("base"), F.col("span"))
    counts = [F.count(F.when(F.col("base") & (F.col("span.kind") == k), 1)).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return (
        spans.groupBy("rid", "doc_id")
        .agg(*counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("span")).alias("spans"), (F.count("span") - F.count(base)).alias("n_added"))
        .drop("rid")
    )


def redacted(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the text with every detected span replaced by its kind in angle brackets."""
    spans = detected(docs, id, text).select(F.col("doc_id").alias("_id"), "spans").dropDuplicates(["_id", "spans"])
    rows = docs.select(docs[id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("body")).join(spans, F.col("doc_id").eqNullSafe(F.col("_id")))
    parts = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.struct(F.split(s, ":")[1].cast("int").alias("start"), F.split(s, ":")[2].cast("int").alias("end"), F.split(s, ":")[0].alias("kind")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(F.col("body"), state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        mark = F.when(s["start"] >= state["at"], F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise("")
        return F.struct(F.greatest(s["end"], state["at"]).alias("at"), F.concat(state["out"], gap, mark).alias("out"))

    text_out = F.aggregate(F.array_sort(parts), start, step, lambda s: F.concat(s["out"], F.substring(F.col("body"), s["at"] + 1, F.length("body"))))
    return rows.select("doc_id", text_out.alias("text"))
