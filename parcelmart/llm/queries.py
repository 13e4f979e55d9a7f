"""The operators on the supplied tables: query name to plan, and the same question in SQL where SQL can ask it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm.best_fit import pack_best_fit
from parcelmart.llm.collocations import collocations
from parcelmart.llm.decontaminate import leaks
from parcelmart.llm.graph_search import neighbours
from parcelmart.llm.html_text import extract
from parcelmart.llm.line_dedup import dedup_lines
from parcelmart.llm.near_dup import near_duplicates
from parcelmart.llm.packing import pack
from parcelmart.llm.personal_data import find
from parcelmart.llm.quality import classify
from parcelmart.llm.role_repair import repair_damaged
from parcelmart.llm.suffix_dedup import remove_repeats
from parcelmart.llm.toxicity import score


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(_table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1")
    rows = classify(_table(spark, sf_dir, "documents"), trusted)
    return rows.select("doc_id", "lang", "n_symbols", "perplexity", "threshold", "accepted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("n_lines").cast("long"), F.col("n_removed").cast("long"), "text")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(_table(spark, sf_dir, "documents")).drop("_t1", "_t2")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_html_text": op5_html_text,
    "op6_quality": op6_quality,
    "op7_line_dedup": op7_line_dedup,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_personal_data": op9_personal_data,
    "op10_toxicity": op10_toxicity,
    "op11_role_repair": op11_role_repair,
    "op12_best_fit": op12_best_fit,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op7_line_dedup": r"""
        WITH parts AS (
            SELECT doc_id, text, string_split(text, chr(10)) AS held FROM documents
        ), lines AS (
            SELECT doc_id, unnest(range(len(held))) AS i, trim(unnest(held)) AS line FROM parts
        ), counted AS (
            SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS n FROM lines WHERE line <> ''
        ), running AS (
            SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) - n AS before FROM counted
        ), spans AS (
            SELECT doc_id, i, max(i) OVER w AS last, list(line) OVER w AS content, sum(n) OVER w AS words
            FROM running
            WINDOW w AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 4 FOLLOWING)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS nth FROM spans WHERE words >= 5
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, last + 1)) AS i FROM ranked WHERE nth > 1
        ), whole AS (
            SELECT doc_id, unnest(range(len(held))) AS i, unnest(held) AS line FROM parts
        ), kept AS (
            SELECT w.doc_id, string_agg(line, chr(10) ORDER BY w.i) AS text
            FROM whole w LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i WHERE g.i IS NULL GROUP BY ALL
        ), sums AS (
            SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id
        )
        SELECT p.doc_id, CAST(len(held) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            CASE WHEN p.text IS NOT NULL THEN coalesce(k.text, '') END AS text
        FROM parts p LEFT JOIN kept k ON k.doc_id = p.doc_id LEFT JOIN sums s ON s.doc_id = p.doc_id
    """,
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), split AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), total AS (
            SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang
        ), placed AS (
            SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split
        ), runs AS (
            SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
            FROM placed, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)
        ), often AS (
            SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 30
        ), candidates AS (
            SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM often WHERE k > 1
        ), cuts AS (
            SELECT c.lang, c.phrase, c.f AS a, c.cut, l.f AS l, r.f AS r,
                CAST(CAST(2000000 AS HUGEINT) * c.f // (l.f + r.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
            JOIN often l ON l.lang = c.lang AND l.k = c.cut AND l.phrase = array_to_string(c.w[1 : c.cut], ' ')
            JOIN often r ON r.lang = c.lang AND r.k = c.k - c.cut AND r.phrase = array_to_string(c.w[c.cut + 1 :], ' ')
        ), lowest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), inner_phrases AS (
            SELECT lang, f, array_to_string(w[i : i + n - 1], ' ') AS phrase
            FROM (SELECT *, unnest(range(1, k)) AS i FROM candidates), (SELECT unnest([2, 3]) AS n) WHERE n < k AND i + n - 1 <= k
        ), covered AS (
            SELECT lang, phrase, max(f) AS most FROM inner_phrases GROUP BY ALL
        ), ranked AS (
            SELECT lo.*, row_number() OVER (PARTITION BY lo.lang ORDER BY score DESC, a DESC, lo.phrase) AS rank
            FROM lowest lo LEFT JOIN covered c ON c.lang = lo.lang AND c.phrase = lo.phrase
            WHERE c.most IS NULL OR 100 * c.most < 80 * lo.a
        )
        SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN total t ON t.lang = r.lang WHERE rank <= 2000
    """,
}
