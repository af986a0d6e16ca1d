"""Registered queries of this subpackage: name -> ``(spark, sf_dir) -> DataFrame``.

Each query applies one operator, with its production parameters, to its whole
table and derives the digest columns of its contract.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    fill_middle,
    hnsw_dedup,
    language_id,
    lattice_lm,
    mixing,
    ngram_join,
    permutation_ann,
    secret_scan,
    sentencepiece_codec,
    substring_dedup,
    suffix_dedup,
    toxicity,
    whitening,
)
from .common import crc_mod, table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path() -> str:
    """The merge-type vocabulary of the public tokenizers; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors, once per application (as --py-files would)."""
    context = spark.sparkContext
    if any(os.path.basename(f) == "shopfloor_package.zip" for f in context.listFiles):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    name = os.path.join(tempfile.mkdtemp(prefix="shopfloor-ship-"), "shopfloor_package")
    context.addPyFile(shutil.make_archive(name, "zip", root, "shopfloor"))


def q_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def q_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def q_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def q_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def q_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_codec.read_model(vocabulary_path())
    return lattice_lm.score_documents(table(spark, sf_dir, "documents"), lattice_lm.learning_rule(), model)


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    learn = ~held_out
    model = toxicity.fit(docs.where(learn), table(spark, sf_dir, "labels").where(learn))
    marked = docs.withColumn("held_out", held_out)
    return toxicity.predict(marked, model, ["doc_id", "held_out"])


def q_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"])


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_counts(table(spark, sf_dir, "documents"))


def q_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def q_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents")))
    digests = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def q_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    plain = {
        "op1_sentencepiece": q_encode,
        "op2_ngram_join": q_ngram_join,
        "op3_permutation_ann": q_ann,
        "op4_secret_scan": q_secrets,
        "op5_hnsw_dedup": q_embedding_dedup,
        "op6_lattice_lm": q_lattice,
        "op7_toxicity": q_toxicity,
        "op8_suffix_dedup": q_repeats,
        "op9_language_id": q_language,
        "op10_mixing": q_mixing,
        "op11_substring_dedup": q_substrings,
        "op12_fill_middle": q_fill_middle,
        "op13_whitening": q_whitening,
    }

    def shipped(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    return {name: shipped(query) for name, query in plain.items()}


#: Windows as texts, counted by their words; a word goes if any repeated window covers it.
_SUBSTRINGS = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), e AS (
  SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, unnest([CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END FOR i IN range(1, len(w) + 1)]) AS passage FROM t
), c AS (
  SELECT r, i, word, passage IS NOT NULL AND count(*) OVER (PARTITION BY passage) > 1 AS again FROM e
), g AS (
  SELECT r, i, word, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM c
), k AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept,
    string_agg(CASE WHEN gone AND NOT before THEN CAST(i - 1 AS VARCHAR) || ':' || CAST(last AS VARCHAR) END, ',' ORDER BY i) AS spans
  FROM (
    SELECT r, i, word, gone, coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS before,
      coalesce(min(CASE WHEN NOT gone THEN i - 1 END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), max(i) OVER (PARTITION BY r)) AS last
    FROM g
  ) GROUP BY r
)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(spans, '') AS spans, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (r)
"""

_FILL_MIDDLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, x, regexp_extract_all(x, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tok,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT *, CAST(len(tok) AS BIGINT) AS n, least(h1 % (len(tok) + 1), h2 % (len(tok) + 1)) AS a, greatest(h1 % (len(tok) + 1), h2 % (len(tok) + 1)) AS b,
    CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 50 THEN 'plain'
         WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), s AS (
  SELECT doc_id, n, form, x, array_to_string(tok[1:a], '') AS p, array_to_string(tok[a + 1:b], '') AS m, array_to_string(tok[b + 1:], '') AS f FROM c
)
SELECT doc_id, n, form,
  CASE WHEN form = 'plain' THEN NULL ELSE CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form = 'plain' THEN NULL ELSE CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || f || '<M>' || m ELSE '<S>' || f || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(x) AS restored_sha256
FROM s
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the operators that SQL can express; tests hold the others against brute force."""
    return {"op11_substring_dedup": _SUBSTRINGS, "op12_fill_middle": _FILL_MIDDLE}
