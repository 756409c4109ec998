"""The registered query of every operator of this folder, with SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import byte_bpe
from .common import table
from .conversation_repair import ORACLE as REPAIR_ORACLE
from .conversation_repair import conversation_repair
from .decontaminate import leaks
from .exact_dedup import exact_dedup
from .html_text import html_text
from .jaccard_join import jaccard_join
from .language_id import language_id
from .packing import pack
from .pseudo_likelihood import pseudo_likelihood
from .quality import quality_scores
from .substring_dedup import substring_dedup
from .url_filter import oracle as url_oracle
from .url_filter import url_filter

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


#: Rules of the registered query, longest match wins.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES).drop("margin")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair(table(spark, sf_dir, "conversations"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_pseudo_likelihood": op5_pseudo_likelihood,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_decontaminate": op8_decontaminate,
    "op9_packing": op9_packing,
    "op10_html_text": op10_html_text,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_byte_bpe": op12_byte_bpe,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256({_LOWER}) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY {_LOWER})""",
    "op4_jaccard_join": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [w] ELSE
                   list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s
            FROM w WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
                  UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(b) FROM reach r WHERE r.a = d.doc_id) AS component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op6_substring_dedup": """
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d),
        windows AS (SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS s FROM starts),
        firsts AS (SELECT s, min(doc_id) AS first_id FROM windows GROUP BY s),
        gone AS (SELECT DISTINCT doc_id, k + i AS place FROM windows JOIN firsts USING (s), range(13) r(i) WHERE first_id < doc_id),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS t FROM words WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = words.doc_id AND gone.place = words.place) GROUP BY doc_id),
        sums AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN sums ON sums.doc_id = d.doc_id""",
    "op7_url_filter": url_oracle(URL_RULES),
    "op11_conversation_repair": REPAIR_ORACLE,
}
