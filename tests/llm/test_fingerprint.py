from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import fingerprint as P


def expected(rows):
    """doc_id, n_chars and the edit's hash, in plain Python."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, t), (_, nxt) in zip(ordered, ordered[1:] + ordered[:1]):
        t, nxt = t or "", nxt or ""
        k = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest()))
    return Counter(out)


ROWS = [(5, "ab cd ef gh ij kl"), (900, None), (3, "é" * 10), (7, "漢字 🙂 x y z"), (8, "same text of seven words in all"), (9, "same text of seven words in all"), (1, "w " * 90_000), (2, ""), (None, "last one by its null id")]


@pytest.mark.parametrize("range_rows", [1, 2, 2000])
def test_edits_against_plain_python(spark, docs_of, monkeypatch, range_rows):
    monkeypatch.setattr(P, "RANGE_ROWS", range_rows)
    rows = ROWS + [(10_000 + i * 7, f"text number {i} of many") for i in range(60)]
    docs = docs_of(rows).withColumns({c: F.lit(1) for c in ("tie", "body", "range", "place", "follows")})
    got = P.with_edits(docs.repartition(4)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == expected(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[8].fingerprint == by_id[9].fingerprint and by_id[9].near_next == 1.0
    assert by_id[2].fingerprint == "0:" and all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next, r.jaccard_edited))


def test_single_document_repeated_ids_and_empty_table(spark, docs_of):
    assert [r.near_next for r in P.with_edits(docs_of([(1, "a b c")])).collect()] == [1.0]
    assert P.with_edits(docs_of([(1, "a"), (1, "a"), (1, "b")])).count() == 3
    assert P.with_edits(docs_of([])).count() == 0


def test_estimates_near_the_truth():
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    a = " ".join(base).encode()
    for share in (0.1, 0.5, 0.9):
        b = " ".join(base[: int(4000 * share)]).encode()
        sa, sb = P.sketches([a, b])
        containment, jaccard = P.likeness(sa, sb)
        assert containment == 1.0 and jaccard == pytest.approx(share, abs=0.06)
    small = " ".join(base[:8]).encode()
    (sa, ss) = P.sketches([a, small])
    assert len(ss[1]) == 4 and P.parsed(P.written_form(sa))[1].tolist() == sa[1].tolist()
    assert set(P.merged(sa, ss)) <= set(sa[1]) | set(ss[1])


def test_plain_fingerprints_agree(spark, docs_of):
    docs = docs_of(ROWS[:-1])
    plain = {r.doc_id: r.fingerprint for r in P.fingerprints(docs).collect()}
    assert plain == {r.doc_id: r.fingerprint for r in P.with_edits(docs).collect()}
