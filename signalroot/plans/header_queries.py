"""Registered queries that go through the builders of the delivery, from header texts on, with their SQL.

A conversation stands for a record: its header text is written from its turns, a
signal line each, and everything after that is what a build does with headers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import groups, labels, tables
from ..schemas import empty
from ..sources import formats, headers, mappings
from . import build, copies, queries, reports
from .queries import _digests, _query, _t

_NAMES = (*S.CANONICAL_LEADS, "vx")


def _headers(spark, sf_dir) -> DataFrame:
    """schemas.HEADER, parsed from the text of one header per conversation."""
    c = _t(spark, sf_dir, "conversations")
    text = lambda x: F.col(x).cast("string")
    file = F.when(F.col("role") == "system", "common.dat").otherwise(F.concat(text("conv_id"), F.lit("_"), "role", F.lit(".dat")))
    unit = F.when(F.col("role") == "user", "/mV").when(F.col("role") == "assistant", "/uV").otherwise("")
    name = F.lower(F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("turn") % len(_NAMES) + 1).cast("int")))
    line = F.concat_ws(" ", file, F.lit("16"), F.concat((F.col("turn") + 100).cast("string"), F.lit("("), F.length("text").cast("string"), F.lit(")"), unit), F.lit("16"), text("turn"), F.lit("0 0 0"), name)
    code = F.when(F.col("turn") % 2 == 0, F.concat(F.substring("role", 1, 1), (F.col("turn") % 3).cast("string")))
    per = c.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", line.alias("line"), code.alias("code")))).alias("rows"), F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("samples")
    )
    codes = F.array_join(F.filter(F.transform("rows", lambda r: r["code"]), lambda x: x.isNotNull()), ", ")
    written = F.concat_ws(
        "\n", F.concat_ws(" ", text("conv_id"), text("n"), F.lit("500"), text("samples")), F.array_join(F.transform("rows", lambda r: r["line"]), "\n"),
        F.when(F.col("conv_id") % 4 != 0, F.concat(F.lit("# Age: "), (F.col("conv_id") % 90).cast("string"))).otherwise("# Age:"), F.when(F.col("conv_id") % 2 == 1, "#Sex: Male").otherwise("# sex: Female"),
        F.when(F.col("conv_id") % 7 != 3, F.concat(F.lit("# Dx: "), codes)),
    )
    source = F.concat(F.lit("c/"), (F.col("conv_id") % 5).cast("string"))
    path = F.concat(F.lit("g"), (F.col("conv_id") % 3).cast("string"), F.lit("/"), text("conv_id"), F.lit(".hea"))
    return headers.parse(per.select(source.alias("source_id"), path.alias("header_path"), written.alias("text")))


def _listed(spark, sf_dir) -> DataFrame:
    """(source_id, relative_path, digest): a manifest of the users' files of even conversations, and of common files."""
    files = tables.source_files(_headers(spark, sf_dir), spark.createDataFrame([], "source_id string, relative_path string, digest string"))
    number = F.regexp_extract("relative_path", r"/(\d+)_user\.dat$", 1).try_cast("long")
    return files.filter((number % 2 == 0) | F.endswith("relative_path", F.lit("/common.dat"))).select("source_id", "relative_path", F.sha2("relative_path", 256).alias("digest"))


_LEADS_SQL = "[" + ", ".join(f"'{x}'" for x in _NAMES) + "]"
_BASE = f"""c AS (SELECT conv_id, turn, role, text, 'c/' || conv_id % 5 AS source_id, 'g' || conv_id % 3 || '/' AS folder, 'c/' || conv_id % 5 || ':' || conv_id AS record_id,
        CASE role WHEN 'system' THEN 'common.dat' ELSE conv_id || '_' || role || '.dat' END AS file, CASE role WHEN 'user' THEN 'mV' WHEN 'assistant' THEN 'uV' ELSE '' END AS unit,
        {_LEADS_SQL}[CAST(turn % {len(_NAMES)} AS INT) + 1] AS lead, CASE WHEN turn % 2 = 0 AND conv_id % 7 <> 3 THEN substr(role, 1, 1) || turn % 3 END AS code FROM conversations),
    m AS (SELECT DISTINCT source_id, folder || file AS relative_path, sha256(folder || file) AS digest FROM c WHERE role = 'system' OR role = 'user' AND conv_id % 2 = 0)"""


# Records out of header texts
@_query(f"""WITH {_BASE} SELECT record_id, source_id, CAST(conv_id AS VARCHAR) AS native_record_id, source_id || ':' || folder || conv_id || '.hea' AS header_file_id, source_id || ':' || folder || min(file) AS signal_file_id,
    count(*) AS n_leads, 500.0::DOUBLE AS sampling_rate_hz, sum(length(text))::BIGINT AS n_samples, sum(length(text)) / 500.0::DOUBLE AS duration_s,
    coalesce(string_agg(DISTINCT unit, '|' ORDER BY unit) FILTER (unit <> ''), '') AS units_declared, bool_and(unit <> '') AS units_are_declared,
    CASE WHEN conv_id % 4 <> 0 THEN CAST(conv_id % 90 AS VARCHAR) END AS age, CASE conv_id % 2 WHEN 1 THEN 'Male' ELSE 'Female' END AS sex FROM c GROUP BY conv_id, source_id, folder, record_id""")
def record_table(spark, sf_dir):
    return tables.records(_headers(spark, sf_dir))


# Leads out of header texts
@_query(f"""WITH {_BASE} SELECT record_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position, lower(lead) AS name_native, CASE WHEN lead <> 'vx' THEN lead END AS name_canonical,
    unit AS units_declared, (100 + turn)::DOUBLE AS gain, length(text) AS baseline, turn AS adc_zero FROM c""")
def lead_table(spark, sf_dir):
    return tables.leads(_headers(spark, sf_dir))


# Statements out of header comments, repeats kept
@_query(f"WITH {_BASE} SELECT record_id, 'SNOMED CT' AS vocabulary, code, 'header comment Dx' AS source_field, 'corpus' AS asserted_by FROM c WHERE code IS NOT NULL")
def label_table(spark, sf_dir):
    return tables.labels(_headers(spark, sf_dir))


# Files that several records name are rows once, with the declared digest
@_query(f"""WITH {_BASE}, f AS (SELECT DISTINCT source_id, folder || conv_id || '.hea' AS relative_path, 'header' AS role FROM c UNION SELECT source_id, folder || file, 'signal' FROM c)
    SELECT source_id || ':' || relative_path AS file_id, source_id, relative_path, role, digest AS sha256_declared FROM f LEFT JOIN m USING (source_id, relative_path)""")
def source_file_table(spark, sf_dir):
    return tables.source_files(_headers(spark, sf_dir), _listed(spark, sf_dir))


# The first signal file of a record that a manifest lists
@_query(f"WITH {_BASE} SELECT record_id, c.source_id, arg_min(digest, file) AS digest FROM c JOIN m ON m.source_id = c.source_id AND m.relative_path = folder || file WHERE c.source_id = 'c/1' GROUP BY ALL")
def first_declared_digest(spark, sf_dir):
    own = F.col("source_id") == "c/1"  # a manifest is that of one distribution
    return build.first_declared(_headers(spark, sf_dir).filter(own), _listed(spark, sf_dir).filter(own).drop("source_id"))


# Records by each spelling of a unit
@_query(f"WITH {_BASE} SELECT unit, count(DISTINCT record_id) AS n FROM c WHERE unit <> '' GROUP BY unit")
def unit_spellings(spark, sf_dir):
    return reports.unit_spellings(_headers(spark, sf_dir))


# What the headers of each source say
@_query(f"""WITH {_BASE}, r AS (SELECT source_id, conv_id, count(*) AS n, sum(length(text))::BIGINT AS samples, bool_and(unit <> '') AS declared, bool_and(unit = 'mV') AS mv, bool_or(code IS NOT NULL) AS dx,
        count(*) FILTER (lead = 'vx') AS odd FROM c GROUP BY source_id, conv_id)
    SELECT source_id, count(*) AS n_records, sum(n)::BIGINT AS n_leads_rows, array_to_string(list_sort(list(DISTINCT n)), '|') AS leads_per_record, '500.0' AS sampling_rates_hz,
           array_to_string(list_sort(list(DISTINCT samples))[1:8], '|') AS sample_lengths, count(*) FILTER (declared) AS n_units_declared, count(*) FILTER (mv) AS n_all_millivolts,
           count(*) FILTER (dx) AS n_with_dx, sum(odd)::BIGINT AS n_non_canonical_leads FROM r GROUP BY source_id""")
def header_summary(spark, sf_dir):
    found = reports.header_summary(_headers(spark, sf_dir), ["source_id"])
    return found.withColumns({c: F.array_join(F.col(c).cast("array<string>"), "|") for c in ("leads_per_record", "sampling_rates_hz", "sample_lengths")})


# Patients named by folders
@_query(f"""WITH {_BASE} SELECT DISTINCT source_id || ':g' || conv_id % 3 AS patient_id, source_id, 'g' || conv_id % 3 AS native_patient_id, record_id, NULL::DOUBLE AS age, NULL::VARCHAR AS sex FROM c""")
def patients_from_folders(spark, sf_dir):
    return mappings.patients_from_folders(_headers(spark, sf_dir))


# The report of the label pass
@_query(f"""WITH {_BASE}, l AS (SELECT record_id, code FROM c WHERE code IS NOT NULL), p AS (SELECT DISTINCT source_id, source_id || ':g' || conv_id % 3 AS patient_id FROM c)
    SELECT 'label rows' AS section, 'all' AS key, count(*) AS n FROM l UNION ALL SELECT 'patients', 'all', count(DISTINCT patient_id) FROM p UNION ALL SELECT 'patients by source', source_id, count(DISTINCT patient_id) FROM p GROUP BY source_id
    UNION ALL SELECT section, 'all', 0 FROM (VALUES ('propagated rows'), ('records given a label'), ('map rows')) v(section)""")
def label_report(spark, sf_dir):
    h = _headers(spark, sf_dir)
    return reports.label_report(tables.labels(h), empty(spark, "label_propagated"), empty(spark, "label_map"), mappings.patients_from_folders(h))


# Cells that agree with what was published
@_query(f"WITH v AS ({queries.ORACLES['published_vs_counted']}) SELECT count(*) AS n_cells, count(*) FILTER (agrees) AS n_agreeing, count(*) FILTER (NOT agrees) AS n_disagreements FROM v")
def label_agreement(spark, sf_dir):
    return labels.agreement(queries.published_vs_counted(spark, sf_dir))


# The first twenty that don't (a report, limited by design)
@_query(f"SELECT * FROM ({queries.ORACLES['published_vs_counted']}) WHERE NOT agrees ORDER BY source_id, code LIMIT 20")
def label_disagreements(spark, sf_dir):
    return labels.disagreements(queries.published_vs_counted(spark, sf_dir))


#: Hundredths as integers, in storage of 16 or of 12 bits.
_STEPS = "transform(embedding, x -> CAST(rint(CAST(x AS FLOAT) * CAST(100 AS FLOAT)) AS INT))"
_BYTE = "lpad(hex({}), 2, '0')"
_STORED = {
    "16": f"transform({_STEPS}, v -> concat({_BYTE.format('v & 255')}, {_BYTE.format('shiftright(v, 8) & 255')}))",
    "212": f"transform(sequence(1, size(embedding), 2), k -> transform(array(struct(element_at({_STEPS}, k) AS a, element_at({_STEPS}, k + 1) AS b)), p -> concat({_BYTE.format('p.a & 255')}, "
    f"{_BYTE.format('(shiftright(p.a, 8) & 15) | shiftleft(shiftright(p.b, 8) & 15, 4)')}, {_BYTE.format('p.b & 255')}))[0])",
}


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of four leads, in physical units."""
    for batch in batches:
        rows = []
        for vec, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
            leads = [{"format": kind, "gain": 100.0 * (k + 1), "baseline": k, "initial_value": 0} for k in range(4)]
            n = formats.frames_in(len(data), leads)
            for k, row in enumerate(formats.decode(data, leads, n, n).tolist()):
                rows += [(vec, 4 * k + lead, value) for lead, value in enumerate(row)]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else ([], [], []), (pa.int64(), pa.int64(), pa.float64()))], ["vec_id", "place", "value"])


# Samples out of packed bytes, two storage formats
@_query("""WITH v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS place FROM embeddings)
    SELECT vec_id, place, (CAST(round_even(CAST(x * 100::FLOAT AS DOUBLE), 0) AS INT) - place % 4) / (100.0::DOUBLE * (place % 4 + 1)) AS value FROM v""")
def signal_decode(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    packed = F.when(F.col("vec_id") % 2 == 0, F.array_join(F.expr(_STORED["16"]), "")).otherwise(F.array_join(F.expr(_STORED["212"]), ""))
    rows = e.select("vec_id", F.when(F.col("vec_id") % 2 == 0, "16").otherwise("212").alias("format"), F.unhex(packed).alias("data"))
    return rows.mapInArrow(_decoded, "vec_id long, place long, value double")


@F.pandas_udf(T.BinaryType())
def _samples(waves: pd.Series) -> pd.Series:
    return waves.map(lambda w: np.asarray(w, np.float64).tobytes())


def _copies(spark, sf_dir) -> DataFrame:
    """A vector as a record of 16 samples and four leads, beside itself, the next one, or a part of itself."""
    e = _t(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y"))
    both = e.join(other, "vec_id").withColumn("y", F.when(F.col("vec_id") % 3 == 0, F.col("x")).when(F.col("vec_id") % 5 == 0, F.slice("x", 1, 60)).otherwise(F.col("y")))
    return copies.compared(both.select(
        F.col("vec_id").cast("string").alias("record_a"), (F.col("vec_id") + 1).cast("string").alias("record_b"), F.lit(4).alias("n_leads_a"), F.lit(4).alias("n_leads_b"), _samples("x").alias("samples_a"),
        _samples("y").alias("samples_b"), F.array(F.lit("a")).alias("comments_a"), F.array(F.when(F.col("vec_id") % 2 == 0, "a").otherwise("b")).alias("comments_b"),
    ))


_COPIES = """e AS (SELECT a.vec_id, list_transform(a.embedding, lambda v: v::DOUBLE) AS x, list_transform(b.embedding, lambda v: v::DOUBLE) AS z FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
    p AS (SELECT vec_id, x, CASE WHEN vec_id % 3 = 0 THEN x WHEN vec_id % 5 = 0 THEN x[1:60] ELSE z END AS y FROM e),
    u AS (SELECT vec_id, unnest(x[1:len(y)]) AS a, unnest(y) AS b, unnest(range(len(y))) AS k FROM p),
    t AS (SELECT vec_id, max(abs(a - b)) AS apart, corr(a, b) FILTER (k % 4 = 0) AS r, count(*) AS n FROM u GROUP BY vec_id)"""


# Copies compared sample by sample, by the operator that opens records
@_query(f"""WITH {_COPIES} SELECT CAST(vec_id AS VARCHAR) AS record_a, CAST(vec_id + 1 AS VARCHAR) AS record_b, n = 64 AS same_shape, n = 64 AND apart = 0 AS identical_samples,
    round(apart, 6) AS max_absolute_difference, round(r, 6) AS lead_one_correlation, vec_id % 2 = 0 AS same_comments FROM t""")
def copy_check(spark, sf_dir):
    c = _copies(spark, sf_dir)
    return c.select("record_a", "record_b", "same_shape", "identical_samples", *(F.round(n, 6).alias(n) for n in ("max_absolute_difference", "lead_one_correlation")), "same_comments")


# Its totals
@_query(f"""WITH {_COPIES} SELECT count(*) AS n_checked, count(*) FILTER (n = 64 AND apart = 0) AS n_identical_samples, count(*) FILTER (vec_id % 2 = 0) AS n_same_comments, round(min(r), 6) AS lowest_correlation FROM t""")
def copy_summary(spark, sf_dir):
    return copies.summary(_copies(spark, sf_dir)).withColumn("lowest_correlation", F.round("lowest_correlation", 6))


# Groups of two thirds of the records, to which the others are added
@_query(f"""WITH {queries._DIGESTS} SELECT record_id, min(record_id) OVER (PARTITION BY loose) AS signal_group_id, count(*) OVER (PARTITION BY loose) AS group_size, loose AS fingerprint FROM d WHERE loose IS NOT NULL""")
def groups_extended(spark, sf_dir):
    d = _digests(spark, sf_dir).select("record_id", F.col("loose").alias("digest"))
    late = F.pmod(F.xxhash64("record_id"), F.lit(3)) == 0
    return groups.extended_groups(groups.signal_groups(d.filter(~late)), d.filter(late))
