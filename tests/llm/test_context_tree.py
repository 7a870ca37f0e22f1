"""Context-tree weighting against a plain recursive tree, and the base score against plain counting."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlint.llm import context_tree as C

ROWS = [
    (1, "The cat sat on the mat.  The cat sat."),
    (2, "A dog\tand a cat"),
    (3, None),
    (4, ""),
    (5, "Größe, ÄÖ und naïve Zeichen \x1f the"),
    (6, "the cat sat on the dog"),
    (6, "the cat sat on the dog"),
    (None, "no id, but a text"),
    (29, "zzz qqq unseen words ünknown the cat"),
    (22, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"),
]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def out_of(id):
    return id is not None and zlib.crc32(str(id).encode()) % 10 == 0


def words(text):
    return re.findall("[^ \t\n\x0b\x0c\r]+", (text or "").translate(LOWER))


def stream(text):
    return " ".join(words(text)).encode() + b"\n"


class PlainTree:
    """Counts by (context, decided bits); weights and predictions by recursion over all children."""

    def __init__(self, texts, depth):
        self.depth, self.n, self.children = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for t in texts:
            padded = b"\n" * depth + t
            for i in range(depth, len(padded)):
                for b in range(8):
                    node, bit = (1 << b) + (padded[i] >> (8 - b)), padded[i] >> (7 - b) & 1
                    for d in range(depth + 1):
                        context = padded[i - d : i]
                        self.n[context, node][bit] += 1
                        if d:
                            self.children[context[1:], node].add(context)
        self.known = {}

    def own(self, key):
        zeros, ones = self.n.get(key, (0, 0))
        return math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.lgamma(zeros + ones + 1) - math.log(math.pi)

    def below(self, key):
        return sum(self.weight((c, key[1])) for c in self.children.get(key, ()))

    def weight(self, key):
        if key not in self.known:
            own = self.own(key)
            self.known[key] = own if len(key[0]) == self.depth else np.logaddexp(own, self.below(key)) - math.log(2)
        return self.known[key]

    def predict(self, context, node, bit):
        zeros, ones = self.n.get((context, node), (0, 0))
        return ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)

    def log10(self, text):
        total, padded = 0.0, b"\n" * self.depth + text
        for i in range(self.depth, len(padded)):
            for b in range(8):
                node, bit = (1 << b) + (padded[i] >> (8 - b)), padded[i] >> (7 - b) & 1
                p = self.predict(padded[i - self.depth : i], node, bit)
                for d in range(self.depth - 1, -1, -1):
                    key = (padded[i - d : i], node)
                    share = 1 / (1 + math.exp(min(700, self.below(key) - self.own(key))))
                    p = share * self.predict(*key, bit) + (1 - share) * p
                total += math.log10(p)
        return total


def expected(rows, depth):
    train = [t for i, t in rows if not out_of(i)]
    tree = PlainTree([stream(t) for t in train], depth)
    counts = Counter(w for t in train for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        out.append((i, out_of(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, base, tree.log10(stream(t))))
    return out


def compare(df, want):
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted([tuple(r[c] for c in columns) for r in df.collect()], key=key)
    want = sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-5)


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("depth", [2, 3, 4])
def test_equals_a_plain_tree(spark, depth):
    docs = table(spark)
    assert any(out_of(i) for i, _ in ROWS)
    compare(C.scored(docs, C.held_out(F.col("doc_id")), depth=depth), expected(ROWS, depth))


@pytest.mark.parametrize("head", [0, 5, 40])
def test_what_is_not_broadcast_is_joined(spark, head):
    compare(C.scored(table(spark), C.held_out(F.col("doc_id")), depth=3, head_words=head, head_runs=head), expected(ROWS, 3))


def test_probabilities_of_all_next_bytes_sum_to_one(spark):
    train = ["abracadabra", "abc abd"]
    rows = [(1, t) for t in train]
    probe = [bytes([b]) for b in range(0x21, 0x7F) if not 0x41 <= b <= 0x5A]
    # "abr" followed by each printable byte: scores differ by that byte's probability and what follows it.
    docs = table(spark, [*rows, *[(29, "abr" + p.decode()) for p in probe]])
    assert out_of(29)
    model = C.train(docs, ~C.held_out(F.col("doc_id")), depth=3).filter("kind = 1").collect()
    tree = PlainTree([stream(t) for t in train], 3)
    after = {r["key"] & 255: r["value"] for r in model if r["key"] >> 8 == int.from_bytes(b"rba", "big")}
    assert len(after) == len(probe)
    total = sum(10 ** after[p[0]] for p in probe)
    rest = sum(10 ** (tree.log10(b"abr" + bytes([b])) - tree.log10(b"abr")) for b in range(256) if bytes([b]) not in probe)
    assert total + rest == pytest.approx(1.0, rel=1e-6)


def test_held_out_is_a_remainder_of_crc32(spark):
    got = spark.range(300).select("id", C.held_out(F.col("id")).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 10 == 0) for r in got)


def test_large_counts_follow_the_gamma_function():
    n = np.array([0, 1, 70_000, 65_535, 65_536, 10**9])
    want = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) for a, b in zip(n, n[::-1])]
    assert C.log_kt(n, n[::-1]) == pytest.approx(want, abs=1e-5)  # of terms up to 2e10


def test_lookup_finds_all_keys_and_no_others():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**40, 5000).astype(np.uint64))
    table = C.Lookup(keys[::2], np.arange(len(keys[::2]), dtype=float))
    assert (table(keys[::2]) == np.arange(len(keys[::2]))).all() and np.isnan(table(keys[1::2])).all()
    assert np.isnan(C.Lookup(keys[:0], np.zeros(0))(keys)).all()


def test_held_out_text_of_the_corpus_is_cheaper_than_noise(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    noise = spark.createDataFrame([(29, "xq zjv kkwq vvzx qqj " * 20)], "doc_id long, text string")
    got = C.scored(docs.unionByName(noise), C.held_out(F.col("doc_id"))).filter("held_out").collect()
    bits = sorted((r["bits_per_byte"], r["score"]) for r in got)
    mean = sum(b for b, _ in bits[:-1]) / (len(bits) - 1)
    assert mean < 3.5 < bits[-1][0]


def test_empty_table_untrained_model_and_clashing_columns(spark):
    assert C.scored(table(spark, []), F.lit(False)).count() == 0
    one = C.scored(spark.createDataFrame([(1, "ab c", 5, 6)], "doc_id long, text string, kind int, score int"), F.lit(True)).first()
    assert (one["n_tokens"], one["n_known"], one["train_tokens"], one["base_score"]) == (3, 0, 0, 0.0)
    assert one["score"] == pytest.approx(-8 * 5 * math.log10(2))
