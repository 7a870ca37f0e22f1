"""The registered queries of the text operators: thin digests over the operators, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.llm import collocations, context_tree, cover_lloyd, exact_dedup, fingerprint, langid, licenses, mixing, ngram_jaccard, packing, pii, substring, url_filter
from ledgerlint.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(read(spark, sf_dir, "documents"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.classes(read(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detected(read(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(read(spark, sf_dir, "pages"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(read(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(read(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_edits(read(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicated(read(spark, sf_dir, "documents")).drop("kept_text")


OP9_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
WINDOW w AS (PARTITION BY body)
"""

OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT r, ws, unnest(generate_series(1, len(ws) - 34)) AS s FROM d WHERE len(ws) >= 35),
k AS (SELECT r, s, md5(array_to_string(ws[s:s + 34], ' ')) AS k FROM p),
c AS (SELECT r, s, count(*) OVER (PARTITION BY k) AS n FROM k),
gone AS (SELECT DISTINCT r, unnest(generate_series(s, s + 34)) AS w FROM c WHERE n > 1),
words AS (SELECT r, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS w FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY w) AS body, count(*) AS n FROM words ANTI JOIN gone USING (r, w) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    found = langid.predict(docs, langid.fit(docs.filter(~out)))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return context_tree.scored(docs, context_tree.held_out(F.col("doc_id")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.ranked(read(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_lloyd.compressed(read(spark, sf_dir, "embeddings"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
grams AS (SELECT lang, len(ws[i:i + k - 1]) AS k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
          FROM starts, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f, split(phrase, ' ') AS ws FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, cut, array_to_string(c.ws[1:cut], ' ') AS head, array_to_string(c.ws[cut + 1:], ' ') AS tail
         FROM c, (SELECT unnest([1, 2]) AS cut) WHERE cut < c.k),
scored AS (SELECT cuts.lang, cuts.phrase, a, cut, l.f AS l, r.f AS r, (a * a * 1000000) // (l.f * r.f) AS score
           FROM cuts JOIN f AS l ON l.lang = cuts.lang AND l.phrase = head JOIN f AS r ON r.lang = cuts.lang AND r.phrase = tail),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (SELECT lang, part, max(f) AS f FROM (SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT worst.* FROM worst LEFT JOIN longer ON longer.lang = worst.lang AND longer.part = worst.phrase WHERE longer.f IS NULL OR 100 * longer.f < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def _op13_sql(rounds: int = cover_lloyd.ROUNDS) -> str:
    """One pair of assignment and update for each round; integers of any size, floors down."""
    nearest = "SELECT vec_id, p, v, {d}min(e) FILTER (d = least) AS e FROM (SELECT *, min(d) OVER (PARTITION BY vec_id, p) AS least FROM (SELECT x.vec_id, x.p, x.v, b.e, list_sum(list_transform(generate_series(1, len(b.v)), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))) AS d FROM cut AS x JOIN b{i} AS b USING (p))) GROUP BY vec_id, p, v"
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS ({nearest.format(i=i, d='min(d) AS d, ')})")
        if i < rounds:
            steps.append(f"s{i} AS (SELECT p, e, pos, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT p, e, unnest(generate_series(1, len(v))) AS pos, unnest(v) AS x FROM a{i}) GROUP BY p, e, pos)")
            steps.append(f"m{i} AS (SELECT p, e, list((s - ((s % n + n) % n)) // n ORDER BY pos) AS v FROM s{i} GROUP BY p, e)")
            steps.append(f"b{i + 1} AS (SELECT p, e, coalesce(m.v, b.v) AS v FROM b{i} AS b LEFT JOIN m{i} AS m USING (p, e))")
    return f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT vec_id, p, v[p * (len(v) // 8) + 1:(p + 1) * (len(v) // 8)] AS v FROM kept, (SELECT unnest(generate_series(0, 7)) AS p)),
b0 AS (SELECT p, e - 1 AS e, v FROM cut JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS e FROM kept) USING (vec_id) WHERE e <= 16),
{', '.join(steps)},
sha AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
code AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM code JOIN kept USING (vec_id), sha
"""


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_pii": op2_pii,
        "op3_url_filter": op3_url_filter,
        "op4_license_scan": op4_license_scan,
        "op5_mix_sources": op5_mix_sources,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_fingerprints": op7_fingerprints,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_language_id": op10_language_id,
        "op11_lm_score": op11_lm_score,
        "op12_collocations": op12_collocations,
        "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_substring_dedup": OP8_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op12_collocations": OP12_SQL,
        "op13_vector_codes": _op13_sql(),
    }
