"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces of
the product of their probabilities (forward algorithm); a text's score for a
language is the product over its words.  The piece probabilities are learnt by
expectation-maximisation on word counts of labelled texts: expected piece
counts come from forward and backward sums over the same segmentations.

Words are runs of letters, lower-cased and marked at the start as the
vocabulary marks them.  A character that no piece covers is a segment of its
own with a small fixed probability.  A word of more than 32 characters is
scored in runs of 32, so very long runs of letters stay cheap.

The classifier is fitted on a bounded sample of the labelled rows: about
``max_train_rows`` in all, shared evenly by at most ``max_langs`` languages
(the most frequent) and chosen by a hash of the text.  The prediction covers
every row and whole texts.

Defined cases: a null text or one without a letter gives ``und`` with score 0,
as does every text if nothing was learnt; ties go to the language that sorts
first; an empty table gives an empty result; repeated rows are predicted
alike; extra columns are ignored by :func:`predict` and kept by
:func:`keep_identified`.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import PerWorker, mix64, written

UNKNOWN = "und"
MAX_TRAIN_ROWS = 8_000
MAX_LANGS = 500
ROUNDS = 3
MIN_SCORE = 0.5
MAX_WORD = 32
UNCOVERED = 1e-7  # probability of a character outside the vocabulary
SMOOTHING = 0.1  # added to every piece's expected count
CACHED_WORDS = 300_000  # words whose scores a task keeps; only speed depends on it
SCALE = 1024.0  # by which sums grow with each character, to stay in range
MARK = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")


def public_pieces(path: str | None = None) -> list[str]:
    """The pieces of a public sentencepiece vocabulary, without control and byte pieces."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


def _parts(word: str) -> list[str]:
    marked = MARK + word
    return [marked[i : i + MAX_WORD] for i in range(0, len(marked), MAX_WORD)]


@dataclass
class Model:
    """Piece probabilities: row ``index[piece]`` of ``probs`` has a column for each language.

    One more row stands for an uncovered character.
    """

    langs: list[str]
    index: dict[str, int]
    probs: np.ndarray

    def __post_init__(self):
        # The pieces by a hash of their characters, sorted, and a bitmap that tells most strings that are no piece.
        pieces = sorted(self.index.items(), key=lambda x: len(x[0]))
        keys = [np.zeros(0, np.uint64)]
        for size in sorted({len(p) for p, _ in pieces}):
            keys.append(_string_hashes(_codes([p for p, _ in pieces if len(p) == size]), size)[:, 0])
        every = np.concatenate(keys)
        order = np.argsort(every)
        self.keys, self.ids = every[order], np.array([i for _, i in pieces], np.int64)[order]
        self.longest = max((len(p) for p, _ in pieces), default=1)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(every >> np.uint64(44)).astype(np.int64)] = True

    def segments(self, parts: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """For parts of one length: (end, length, numbers of the parts that have a piece there, its row), by end."""
        size = len(parts[0])
        codes = _codes(parts)
        found = {}
        for k in range(1, min(size, self.longest) + 1):
            hashes = _string_hashes(codes, k, found.get("last"))
            found["last"] = hashes
            at = np.flatnonzero(self.maybe[(hashes.ravel() >> np.uint64(44)).astype(np.int64)])
            key = hashes.ravel()[at]
            where = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[where] == key
            part, start = np.divmod(at[hit], size - k + 1)
            row = self.ids[where[hit]]
            order = np.argsort(start, kind="stable")
            cuts = np.searchsorted(start[order], np.arange(size - k + 2))
            for s in range(size - k + 1):
                own = order[cuts[s] : cuts[s + 1]]
                if len(own):
                    found[(s + k, k)] = (part[own], row[own])
        out = []
        for end in range(1, size + 1):
            alone = np.ones(len(parts), bool)
            if (end, 1) in found:
                alone[found[(end, 1)][0]] = False
            alone = np.flatnonzero(alone)
            if len(alone):
                out.append((end, 1, alone, np.full(len(alone), len(self.index))))
            out += [(end, k, *found[(end, k)]) for k in range(1, min(end, self.longest) + 1) if (end, k) in found]
        return out

    def forward(self, segments: list, n: int, size: int, probs: list[np.ndarray]) -> np.ndarray:
        """[part, position, ...]: scaled sums over all segmentations of the characters before each position."""
        tail = probs[0].shape[1:]
        sums = np.zeros((size + 1, n, *tail))
        sums[0] = 1.0
        for (end, k, part, _), p in zip(segments, probs):
            sums[end][part] += sums[end - k][part] * p
        return sums

    def log_probs(self, words: list[str]) -> np.ndarray:
        """[word, language]: log of the summed probability of all segmentations."""
        out = np.zeros((len(words), len(self.langs)))
        for ids, parts in _by_length(words):
            size = len(parts[0])
            found = self.segments(parts)
            total = self.forward(found, len(parts), size, [self.probs[row] * SCALE**k for _, k, _, row in found])[size]
            np.add.at(out, ids, np.log(total) - size * np.log(SCALE))
        return out


def _codes(strings: list[str]) -> np.ndarray:
    """Code points of strings of one length, a row each."""
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(strings), -1).astype(np.uint64)


def _string_hashes(codes: np.ndarray, size: int, shorter: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of all substrings of ``size`` characters; ``shorter`` are those of one character less."""
    if shorter is None:
        shorter = np.zeros_like(codes[:, : codes.shape[1] + 1 - size + 1])
        for k in range(1, size):
            shorter = _string_hashes(codes[:, : codes.shape[1] - size + k], k, shorter if k > 1 else None)
    n = codes.shape[1] - size + 1
    with np.errstate(over="ignore"):
        return mix64(shorter[:, :n] * np.uint64(0x5851F42D4C957F2D) + codes[:, size - 1 :] + np.uint64(size))


def _by_length(words: list[str], most: int = 8_000) -> Iterator[tuple[list[int], list[str]]]:
    """Parts of words in groups of one length, with their words' numbers."""
    groups: dict[int, tuple[list[int], list[str]]] = defaultdict(lambda: ([], []))
    for i, word in enumerate(words):
        for part in _parts(word):
            ids, parts = groups[len(part)]
            ids.append(i)
            parts.append(part)
    for ids, parts in groups.values():
        for lo in range(0, len(parts), most):
            yield ids[lo : lo + most], parts[lo : lo + most]


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter = Counter()
    for b in batches:
        for lang, text in zip(b["lang"], b["text"]):
            held.update((lang, w) for w in words_of(text))
            if len(held) > CACHED_WORDS:
                yield pd.DataFrame([(*k, n) for k, n in held.items()], columns=["lang", "word", "n"])
                held = Counter()
    if held:
        yield pd.DataFrame([(*k, n) for k, n in held.items()], columns=["lang", "word", "n"])


def _expected_counts(shared, lang_at: dict[str, int]):
    """Sums of each task's expected piece counts under the model."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model: Model = shared.value
        sums = np.zeros(model.probs.shape)
        for b in batches:
            lang = b["lang"].map(lang_at).to_numpy()
            n = b["n"].to_numpy(float)
            for ids, parts in _by_length(b["word"].tolist()):
                own, size = lang[ids], len(parts[0])
                found = model.segments(parts)
                probs = [model.probs[row, own[part]] * SCALE**k for _, k, part, row in found]
                before = model.forward(found, len(parts), size, probs)
                after = np.zeros_like(before)
                after[size] = 1.0
                for (end, k, part, _), p in zip(reversed(found), reversed(probs)):
                    after[end - k][part] += after[end][part] * p
                share = n[ids] / before[size]
                for (end, k, part, row), p in zip(found, probs):
                    np.add.at(sums, (row, own[part]), before[end - k][part] * p * after[end][part] * share[part])
        sums = sums[: len(model.index)]
        piece, k = np.nonzero(sums)
        if len(piece):
            yield pd.DataFrame({"piece": piece.astype("int64"), "lang": k.astype("int64"), "n": sums[piece, k]})

    return run


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    pieces: list[str] | None = None,
    max_train_rows: int = MAX_TRAIN_ROWS,
    max_langs: int = MAX_LANGS,
    rounds: int = ROUNDS,
) -> Model:
    """Learn piece probabilities of every language from the rows with a text and a language."""
    spark = docs.sparkSession
    index = {p: i for i, p in enumerate(pieces if pieces is not None else public_pieces())}
    rows = docs.select(docs[text].alias("text"), docs[lang].alias("lang")).filter("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], index, np.zeros((len(index) + 1, 0)))
    share = spark.createDataFrame([(k, min(1.0, max_train_rows / len(langs) / n)) for k, n in counts.items()], "lang string, share double")
    chosen = rows.join(F.broadcast(share), "lang").filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    words = written(chosen.select("lang", "text").mapInPandas(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    lang_at = {k: i for i, k in enumerate(langs)}
    probs = np.full((len(index) + 1, len(langs)), 1.0 / max(1, len(index)))
    probs[-1] = UNCOVERED
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Model(langs, index, probs))
        # At most one row for each piece of the vocabulary and language.
        learnt = words.mapInPandas(_expected_counts(shared, lang_at), "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        shared.unpersist()
        sums = np.zeros(probs.shape)
        sums[learnt["piece"], learnt["lang"]] = learnt["n"]
        sums[: len(index)] += SMOOTHING
        probs = sums / sums.sum(axis=0)
        probs[-1] = UNCOVERED
    return Model(langs, index, probs)


class _Scores:
    """Words' scores under one model, as far as they are kept; one table serves all tasks of a Python worker."""

    def __init__(self, model: Model):
        self.model, self.known, self.table = model, {}, np.zeros((1024, len(model.langs)))

    def totals(self, bags: list[list[str]]) -> list[np.ndarray]:
        """Each bag's summed log probabilities."""
        known = self.known
        new = list(set().union(*bags).difference(known))
        base = len(known)
        while base + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[base : base + len(new)] = self.model.log_probs(new)
        known.update(zip(new, range(base, base + len(new))))
        out = [self.table[[known[w] for w in words]].sum(axis=0) for words in bags]
        for w in new[max(0, CACHED_WORDS - base) :]:  # the words that came first stay: frequent ones are among them
            del known[w]
        return out


def scorer(spark, model: Model):
    """A ``Column -> Column`` of struct(lang, score) for texts."""
    shared = spark.sparkContext.broadcast(model)
    name = uuid4().hex

    @F.pandas_udf("lang string, score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = PerWorker.get(name, lambda: _Scores(shared.value))
        learnt = scores.model.langs
        for texts in batches:
            out = []
            for lo in range(0, len(texts), 512):
                bags = [words_of(t) for t in texts.iloc[lo : lo + 512]]
                bags = [b if learnt and any(c.isalpha() for w in b for c in w) else [] for b in bags]
                for words, total in zip(bags, scores.totals(bags)):
                    if words:
                        best = int(total.argmax())
                        out.append((learnt[best], float(1.0 / np.exp(total - total[best]).sum())))
                    else:
                        out.append((UNKNOWN, 0.0))
            yield pd.DataFrame(out, columns=["lang", "score"]).astype({"lang": object, "score": float})

    return score


def predict(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score."""
    score = scorer(docs.sparkSession, model)
    found = docs.select(docs[id].alias("doc_id"), score(docs[text]).alias("found"))
    return found.select("doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def keep_identified(docs: DataFrame, model: Model, text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose text has a language of at least ``min_score``, with all their columns."""
    score = scorer(docs.sparkSession, model)
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), score(docs[text]).alias("found"))
    return packed.filter((F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= min_score)).select("row.*")


def held_out(id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id is not held out."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
