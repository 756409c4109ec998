"""The jobs as registered queries: each runs twice into one new folder and gives the output as it then stands."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalroot.scratch import shared_dir

from . import arrivals, leak_safe_split

FOLDS, SEED = "train=80,validation=10,test=10", "20260908"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def job1_leak_safe_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "leak_safe_split")
    leak_safe_split.run(spark, sf_dir, out, FOLDS, SEED)
    return leak_safe_split.run(spark, sf_dir, out, FOLDS, SEED)


def job2_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _folder(spark, "arrivals")
    arrivals.run(spark, sf_dir, f"{out}/ledger", f"{out}/checkpoint")
    return arrivals.run(spark, sf_dir, f"{out}/ledger", f"{out}/checkpoint").drop("arrival")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"job1_leak_safe_split": job1_leak_safe_split, "job2_arrivals": job2_arrivals}

_CASES = " ".join(f"WHEN substr(sha256('{SEED}:' || signal_group_id), 1, 8) < '{behind}' THEN '{name}'" for name, behind in leak_safe_split.bounds(FOLDS))

ORACLES: dict[str, str] = {
    "job1_leak_safe_split": f"""
        WITH RECURSIVE r0 AS (SELECT coalesce(source, '') || ':' || coalesce(CAST(doc_id AS VARCHAR), '') AS record_id, source, doc_id,
                 sha256(trim(regexp_replace(lower(text), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ')) AS words, sha256(array_to_string(list_sort(string_split(text, chr(10))), chr(10))) AS lines FROM documents),
        d AS (SELECT record_id, min(source) AS source_id, min(doc_id) AS doc_id, min(words) AS words, min(lines) AS lines FROM r0 GROUP BY record_id),
        e AS (SELECT a.record_id AS a, b.record_id AS b FROM d a JOIN d b ON a.words = b.words UNION SELECT a.record_id, b.record_id FROM d a JOIN d b ON a.lines = b.lines),
        reach AS (SELECT record_id AS a, record_id AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
        g AS (SELECT a AS record_id, min(b) AS signal_group_id FROM reach GROUP BY a),
        own AS (SELECT DISTINCT coalesce(source, '') || ':' || coalesce(CAST(doc_id AS VARCHAR), '') AS record_id,
                       unnest(list_filter([CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL)) AS code FROM documents JOIN labels USING (doc_id)),
        via AS (SELECT t.record_id, min(o.record_id) AS via_record_id FROM d t JOIN d o ON o.words = t.words WHERE t.record_id NOT IN (SELECT record_id FROM own) AND o.record_id IN (SELECT record_id FROM own) GROUP BY 1),
        c AS (SELECT record_id, code, CAST(NULL AS VARCHAR) AS via_record_id FROM own UNION ALL SELECT via.record_id, code, via_record_id FROM via JOIN own ON own.record_id = via_record_id),
        codes AS (SELECT record_id, string_agg(DISTINCT code, '|' ORDER BY code) AS codes, min(via_record_id) AS via_record_id FROM c GROUP BY record_id)
        SELECT d.record_id, source_id, doc_id, signal_group_id, count(*) OVER (PARTITION BY signal_group_id) AS group_size, codes, via_record_id, CASE {_CASES} END AS fold
        FROM d JOIN g ON g.record_id = d.record_id LEFT JOIN codes ON codes.record_id = d.record_id""",
    "job2_arrivals": """
        WITH d AS (SELECT coalesce(source, '') || ':' || coalesce(CAST(doc_id AS VARCHAR), '') AS record_id, source AS source_id, doc_id, CASE WHEN length(text) > 0 THEN sha256(text) END AS digest,
                          coalesce(length(text), 0) AS n_chars, n_chars AS n_chars_declared FROM documents),
        f AS (SELECT digest, min(record_id) AS first_id, arg_min(source_id, record_id) AS first_source FROM d WHERE digest IS NOT NULL GROUP BY digest)
        SELECT record_id, source_id, doc_id, d.digest, n_chars, n_chars_declared, n_chars IS NOT DISTINCT FROM n_chars_declared AS declared_holds, first_id AS first_record_id,
               CASE WHEN record_id <> first_id THEN CASE WHEN source_id IS NOT DISTINCT FROM first_source THEN 'within-distribution' ELSE 'across-distributions' END END AS scope,
               CASE WHEN d.digest IS NULL THEN 'blank' WHEN record_id <> first_id THEN 'repeat' ELSE 'first' END AS outcome
        FROM d LEFT JOIN f ON f.digest = d.digest""",
}
