"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

All but the last return the columns of ``documents``:

1. texts without an identified language go;
2. of equal texts the one with the largest id stays;
3. of each class of near duplicates (Jaccard similarity of five-word shingles of at least 0.8) the least id stays;
4. sources are mixed to their target weights: a document has a row for each pass that takes words of it, with those words;
5. the mix is tokenised and packed into sequences.

Defined cases: a null or empty text, or one without a letter, has no language
and goes in the first stage; a null id is smaller than all others, so of equal
texts it goes, but a single document with it stays; a null language does not train
and a null source is a source of its own; rows that are repeated as a whole are equal texts, of which one stays;
an empty table passes all stages as an empty one; additional columns, also ones
with names that the stages use themselves, are kept up to the last stage;
whole texts are read, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlint.llm import exact_dedup, langid, mixing, ngram_jaccard, packing
from ledgerlint.llm.common import read, written


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("language ID", keep_identified),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Learnt models, sketches and tokenizers are not SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
