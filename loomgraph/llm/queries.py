"""The registered queries of the training-data operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_fst, fingerprint, hamming, html_text, licences, packing, pii, repair, simhash, toxicity
from .common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op2_repair_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.write_and_read(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_likeness(table(spark, sf_dir, "documents"))


def op4_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_fst.encode_decode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = hamming.sign_codes(table(spark, sf_dir, "embeddings"))
    queries = codes.filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), "code")
    return hamming.top_k(codes, queries)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sum_of_squares_packing, op2_repair_token_ids, op3_multiset_fingerprint, op4_anchor_simhash, op5_toxicity, op6_personal_data,
        op7_main_text, op8_licence_digests, op9_bpe_transducer, op10_hamming_top_k, pipeline,
    )
}


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_spelled(x: str, several: bool = False) -> str:
    for a, b in licences.SPELLINGS:
        if not several or " " in a:
            x = f"replace(replace({x}, ' {a} ', ' {b} '), ' {a} ', ' {b} ')"
    return x


def _sql_plain(x: str) -> str:
    words = f"regexp_replace(regexp_replace(lower({x}), {_sql_text(licences.COPYRIGHT)}, ' ', 'g'), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    return _sql_spelled(f"' ' || replace({words}, chr(10), ' ' || chr(10) || ' ') || ' '")


def _sql_units(x: str, mark: str) -> str:
    return f"list_filter(list_transform(string_split({x}, {mark}), lambda x: trim(x)), lambda x: x <> '')"


def _sql_paragraphs(x: str) -> str:
    joined = f"regexp_replace(replace(regexp_replace({x}, '\\n[ \\n]*\\n', ' ' || chr(1) || ' ', 'g'), chr(10), ' '), ' +', ' ', 'g')"
    return _sql_units(_sql_spelled(joined, True), "chr(1)")


OP8_SQL = f"""
WITH given AS (
  SELECT license, titled, {_sql_plain('t')} AS p FROM (VALUES
    {', '.join(f'({_sql_text(k)}, {_sql_text(t)}, {n})' for n, known in ((0, licences.KNOWN), (1, licences.TITLED)) for k, ts in known.items() for t in ts)}
  ) v(license, t, titled)
), parted AS (SELECT license, titled, {_sql_paragraphs('p')} AS ps FROM given),
texts AS (SELECT license, titled, len(ps) AS k, sha256(ps[1]) AS first, sha256(array_to_string(ps, ' ')) AS whole FROM parted),
long_texts AS (SELECT * FROM (VALUES ('', 0, '', ''), {', '.join(f"('{a}', {k}, '{f}', '{w}')" for a, k, _, f, w in licences.DIGESTS)}) v(license, k, first, whole)),
runs AS (
  SELECT license, k, first, whole FROM texts WHERE titled = 0 UNION SELECT license, 1, whole, whole FROM texts WHERE titled = 0
  UNION SELECT license, k, first, whole FROM long_texts
), single AS (SELECT whole AS digest, min(license) AS license FROM texts WHERE titled = 0 GROUP BY whole),
wholes AS (SELECT whole AS digest, min(license) AS license FROM (SELECT license, whole FROM texts UNION SELECT license, whole FROM long_texts) GROUP BY whole),
docs AS (SELECT row_number() OVER () AS row, doc_id, {_sql_plain("coalesce(text, '')")} AS p FROM documents),
cut AS (SELECT row, doc_id, {_sql_units('p', 'chr(10)')} AS ls, {_sql_paragraphs('p')} AS ps FROM docs),
units AS (
  SELECT row, 'line' AS kind, unnest(ls) AS unit, generate_subscripts(ls, 1) AS i FROM cut
  UNION ALL SELECT row, 'paragraph', unnest(ps), generate_subscripts(ps, 1) FROM cut
), lone AS (
  SELECT row, string_agg(DISTINCT license, ',' ORDER BY license) AS found, count(*) AS n FROM units JOIN single ON sha256(unit) = digest WHERE kind = 'line' GROUP BY row
), whole_runs AS (
  SELECT row, string_agg(DISTINCT license, ',' ORDER BY license) AS found
  FROM (SELECT u.*, r.license, r.k, r.whole FROM units u JOIN runs r ON sha256(u.unit) = r.first) h JOIN cut USING (row)
  WHERE h.k = 1 OR sha256(array_to_string((CASE kind WHEN 'line' THEN ls ELSE ps END)[i:i + k - 1], ' ')) = whole
  GROUP BY row
)
SELECT c.doc_id, sha256(array_to_string(c.ps, ' ')) AS digest, w.license, coalesce(l.found, '') AS line_licenses, coalesce(l.n, 0) AS n_license_lines, coalesce(r.found, '') AS text_licenses
FROM cut c LEFT JOIN wholes w ON w.digest = sha256(array_to_string(c.ps, ' ')) LEFT JOIN lone l ON l.row = c.row LEFT JOIN whole_runs r ON r.row = c.row
"""

_CODE_SQL = "SELECT vec_id, list_reduce(list_prepend(0::UBIGINT, list_transform(range(1, 65), lambda i: CASE WHEN embedding[i] > 0 THEN (1::UBIGINT << (i - 1)::UBIGINT) ELSE 0::UBIGINT END)), lambda a, b: a | b) AS code FROM embeddings"

OP10_SQL = f"""
WITH codes AS ({_CODE_SQL}),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, bit_count(xor(q.code, r.code))::BIGINT AS distance
  FROM codes q CROSS JOIN codes r WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""

ORACLE = {"op8_licence_digests": OP8_SQL, "op10_hamming_top_k": OP10_SQL}
