"""Registered queries of the library's own operators over the driver's tables, with their SQL.

documents stand for records (source is the distribution, lang the corpus, text
the signal bytes), labels for statements, embeddings for first leads, events for
channels in long form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import scalars as S
from ..operators import duplicates, groups, labels
from ..schemas import shaped
from ..scratch import Scratch
from ..sources import catalog, delivery, manifest
from . import reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _record_id(df: DataFrame) -> DataFrame:
    return df.withColumn("record_id", F.concat("source", F.lit(":"), F.col("doc_id").cast("string")))


def _digests(spark, sf_dir) -> DataFrame:
    """(record_id, source_id, digest, loose): exact and normalised digests of documents."""
    d = _record_id(_t(spark, sf_dir, "documents"))
    return d.select("record_id", F.col("source").alias("source_id"), F.sha2("text", 256).alias("digest"), F.sha2(F.lower(F.regexp_replace("text", r"\s+", " ")), 256).alias("loose"))


def _labels(spark, sf_dir) -> DataFrame:
    """Flags of documents as statements: a code for each flag that is set."""
    flags = F.filter(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic")), lambda x: x.isNotNull())
    both = _record_id(_t(spark, sf_dir, "documents")).join(_t(spark, sf_dir, "labels"), "doc_id")
    rows = both.select("record_id", F.explode(flags).alias("code"))
    return shaped(rows.withColumns({"vocabulary": F.lit("flags"), "source_field": F.lit("labels"), "asserted_by": F.lit("table")}), "label")


_DIGESTS = """
    d AS (SELECT source || ':' || doc_id AS record_id, source AS source_id, sha256(text) AS digest,
                 sha256(lower(regexp_replace(text, '\\s+', ' ', 'g'))) AS loose FROM documents)"""
_LABELS = """
    label AS (SELECT source || ':' || doc_id AS record_id, unnest(list_filter([CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL)) AS code
              FROM documents JOIN labels USING (doc_id))"""
_LINKS = """
    links AS (SELECT a.record_id AS record_a, b.record_id AS record_b, CASE WHEN a.source_id = b.source_id THEN 'within-distribution' ELSE 'across-distributions' END AS scope
              FROM d a JOIN d b ON a.digest = b.digest AND a.record_id < b.record_id)"""


# Provenance of every record in one join
@_query("""SELECT l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey AS record_id, CAST(o_custkey AS VARCHAR) AS source_id,
           o_orderpriority AS relative_path, o_orderstatus AS sha256_declared FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def trace_one_join(spark, sf_dir):
    record = _t(spark, sf_dir, "lineitem").select(F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("record_id"), F.col("l_orderkey").alias("signal_file_id"))
    file = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file_id"), F.col("o_custkey").cast("string").alias("source_id"), F.col("o_orderpriority").alias("relative_path"), F.col("o_orderstatus").alias("sha256_declared"))
    return delivery.traced(record, file)


# Files, each once, the first wins
@_query("""SELECT file_id, min(page_id) AS page_id, arg_min(role, page_id) AS role FROM (
             SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || ':' || regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS file_id,
                    CASE WHEN regexp_extract(url, '^([^?#]*)', 1) LIKE '%.html' THEN 'header' ELSE 'signal' END AS role FROM pages) GROUP BY file_id""")
def file_registry_first_wins(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    rows = p.select(
        "page_id", S.file_id(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), F.regexp_extract("url", "^[a-z]+://[^/?#]*([^?#]*)", 1)).alias("file_id"),
        F.when(F.endswith(F.regexp_extract("url", "^([^?#]*)", 1), F.lit(".html")), "header").otherwise("signal").alias("role"),
    )
    return rows.groupBy("file_id").agg(F.min_by("role", "page_id").alias("role"), F.min("page_id").alias("page_id"))


# Records with derived columns
@_query("""SELECT 'events:' || user_id AS record_id, count(DISTINCT event_type) AS n_leads, count(*) AS n_samples, round(count(*) / 500.0::DOUBLE, 6) AS duration_s,
                  min(event_id) AS header_file_id FROM events GROUP BY user_id""")
def record_projection(spark, sf_dir):
    e = _t(spark, sf_dir, "events").groupBy("user_id").agg(F.count_distinct("event_type").alias("n_leads"), F.count(F.lit(1)).alias("n_samples"), F.min("event_id").alias("header_file_id"))
    return e.select(F.concat(F.lit("events:"), F.col("user_id").cast("string")).alias("record_id"), "n_leads", "n_samples", F.round(S.duration_s("n_samples", F.lit(500.0)), 6).alias("duration_s"), "header_file_id")


_LEADS_SQL = "[" + ", ".join(f"'{x}'" for x in (*S.CANONICAL_LEADS, "vx")) + "]"


# Leads by position, canonical names
@_query(f"""SELECT conv_id, turn AS position, name_native, CASE WHEN list_contains({_LEADS_SQL}[1:12], name) THEN name END AS name_canonical FROM (
             SELECT conv_id, turn, {_LEADS_SQL}[CAST(turn % 13 AS INT) + 1] AS name, ' ' || lower({_LEADS_SQL}[CAST(turn % 13 AS INT) + 1]) || ' ' AS name_native FROM conversations)""")
def lead_positions(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in (*S.CANONICAL_LEADS, "vx")])
    native = F.concat(F.lit(" "), F.lower(F.element_at(names, (F.col("turn") % 13 + 1).cast("int"))), F.lit(" "))
    c = _t(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("position"), native.alias("name_native"))
    return c.withColumn("name_canonical", S.canonical_lead("name_native"))


# Codes, one row each
@_query(f"WITH {_LABELS} SELECT record_id, code FROM label")
def label_explode(spark, sf_dir):
    return _labels(spark, sf_dir).select("record_id", "code")


# Digest groups with sorted members
@_query(f"WITH {_DIGESTS} SELECT digest, string_agg(record_id, '|' ORDER BY record_id) AS members, count(*) AS n FROM d GROUP BY digest")
def digest_groups(spark, sf_dir):
    return duplicates.groups(_digests(spark, sf_dir)).select("digest", S.joined("members").alias("members"), F.size("members").cast("long").alias("n"))


# Pairs of equal digest, scoped
@_query(f"WITH {_DIGESTS}, {_LINKS} SELECT record_a, record_b, scope, 'signal' AS sieve, 1.0::DOUBLE AS score FROM links")
def digest_pairs_scoped(spark, sf_dir):
    return duplicates.pairs_by_digest(_digests(spark, sf_dir), "signal")


# Repeats inside each source
@_query(f"""WITH {_DIGESTS}, g AS (SELECT source_id, digest, count(*) AS n FROM d GROUP BY ALL)
    SELECT source_id, sum(n)::BIGINT AS n_records, coalesce(sum(n * (n - 1) // 2) FILTER (n > 1), 0)::BIGINT AS n_pairs, count(*) FILTER (n > 1) AS n_groups,
           coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS n_in_groups, coalesce(max(n) FILTER (n > 1), 0) AS largest, count(*) AS n_distinct_tracings FROM g GROUP BY source_id""")
def within_repeat_summary(spark, sf_dir):
    return reports.within_summary(_digests(spark, sf_dir), ["source_id"])


# The first three repeated groups of each source, in digest order (a report, limited by design)
@_query(f"""WITH {_DIGESTS}, g AS (SELECT source_id, digest, count(*) AS n FROM d GROUP BY ALL HAVING count(*) > 1)
    SELECT source_id, digest, n FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY digest) AS k FROM g) WHERE k <= 3""")
def repeat_examples(spark, sf_dir):
    g = _digests(spark, sf_dir).groupBy("source_id", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return g.withColumn("k", F.row_number().over(Window.partitionBy("source_id").orderBy("digest"))).filter("k <= 3").drop("k")


# The first file of each host that has a declared digest
@_query("""SELECT host, arg_min(digest, page_id) AS digest, min(page_id) AS page_id FROM (
             SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, sha256(html) AS digest FROM pages WHERE url LIKE '%.html%') GROUP BY host""")
def sieve_file_digest(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").filter(F.col("url").contains(".html"))
    return p.groupBy(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("host")).agg(F.min_by(F.sha2("html", 256), "page_id").alias("digest"), F.min("page_id").alias("page_id"))


# The earlier sieve keeps a pair
@_query(f"""WITH {_DIGESTS}, p AS (
      SELECT a.record_id AS record_a, b.record_id AS record_b, a.source_id = b.source_id AS same, bool_or(a.digest = b.digest) AS exact
      FROM d a JOIN d b ON a.loose = b.loose AND a.record_id < b.record_id GROUP BY ALL)
    SELECT record_a, record_b, CASE WHEN exact THEN 'source-file' ELSE 'signal' END AS sieve, 1.0::DOUBLE AS score, CASE WHEN same THEN 'within-distribution' ELSE 'across-distributions' END AS scope FROM p""")
def merge_sieves(spark, sf_dir):
    d = _digests(spark, sf_dir)
    loose = d.select("record_id", "source_id", F.col("loose").alias("digest"))
    return duplicates.merge(duplicates.pairs_by_digest(d, S.BY_FILE), duplicates.pairs_by_digest(loose, "signal"))


# Links by sieve and scope
@_query(f"""WITH {_DIGESTS}, p AS (SELECT a.source_id = b.source_id AS same, a.digest = b.digest AS exact FROM d a JOIN d b ON a.loose = b.loose AND a.record_id < b.record_id)
    SELECT count(*) AS n_links, count(*) FILTER (exact) AS n_source_file, count(*) FILTER (NOT exact) AS n_signal, 0::BIGINT AS n_correlation,
           count(*) FILTER (same) AS n_within, count(*) FILTER (NOT same) AS n_across FROM p""")
def screen_summary(spark, sf_dir):
    return reports.screen_summary(merge_sieves(spark, sf_dir))


# Records that no link mentions
@_query(f"WITH {_DIGESTS}, {_LINKS} SELECT record_id FROM d WHERE record_id NOT IN (SELECT record_a FROM links UNION SELECT record_b FROM links)")
def unmatched_records(spark, sf_dir):
    d = _digests(spark, sf_dir)
    return duplicates.unmatched(d, duplicates.pairs_by_digest(d, "signal"))


_GROUPS = f"""WITH RECURSIVE {_DIGESTS}, e AS (SELECT a.record_id AS a, b.record_id AS b FROM d a JOIN d b ON a.loose = b.loose),
    r AS (SELECT record_id AS a, record_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
    g AS (SELECT a AS record_id, min(b) AS signal_group_id FROM r GROUP BY a)"""


def _groups(spark, sf_dir):
    d = _digests(spark, sf_dir)
    loose = d.select("record_id", "source_id", F.col("loose").alias("digest"))
    links = duplicates.pairs_by_digest(loose, "signal")
    return groups.signal_groups(d.select("record_id", "digest"), links), links


# Components over digests and links
@_query(f"{_GROUPS} SELECT record_id, signal_group_id, count(*) OVER (PARTITION BY signal_group_id) AS group_size, digest AS fingerprint FROM g JOIN d USING (record_id)")
def signal_groups(spark, sf_dir):
    return _groups(spark, sf_dir)[0]


# invariant: no link crosses two groups
@_query(f"""{_GROUPS} SELECT count(*) FILTER (x.signal_group_id <> y.signal_group_id) AS n_crossing
    FROM e JOIN g x ON x.record_id = e.a JOIN g y ON y.record_id = e.b WHERE e.a < e.b""")
def split_key_safe(spark, sf_dir):
    found, links = _groups(spark, sf_dir)
    return reports.crossing_links(links, found).agg(F.count(F.lit(1)).alias("n_crossing"))


# Summary of groups
@_query(f"""{_GROUPS}, s AS (SELECT signal_group_id, count(*) AS n FROM g GROUP BY 1)
    SELECT count(*) AS n_groups, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS n_records_in_groups, max(n) AS largest FROM s""")
def group_summary(spark, sf_dir):
    return reports.group_summary(_groups(spark, sf_dir)[0])


# Labels over links, one hop, smallest origin
@_query(f"""WITH {_DIGESTS}, {_LABELS}, {_LINKS}, both_ways AS (SELECT record_a AS t, record_b AS o FROM links UNION ALL SELECT record_b, record_a FROM links),
    c AS (SELECT t, min(o) AS o FROM both_ways WHERE t NOT IN (SELECT record_id FROM label) AND o IN (SELECT record_id FROM label) GROUP BY t)
    SELECT c.t AS record_id, d.source_id, 'flags' AS vocabulary, code, 'propagated from ' || c.o AS source_field, 'linked record' AS asserted_by, c.o AS via_record_id
    FROM c JOIN label ON label.record_id = c.o JOIN d ON d.record_id = c.t""")
def propagate_labels(spark, sf_dir):
    d = _digests(spark, sf_dir)
    return labels.propagate(_labels(spark, sf_dir), duplicates.pairs_by_digest(d, "signal"), d)


# Label rows by source and code
@_query(f"WITH {_LABELS} SELECT split_part(record_id, ':', 1) AS source_id, code, count(*) AS n FROM label GROUP BY ALL")
def label_counts_per_source(spark, sf_dir):
    return labels.counts_per_source(_labels(spark, sf_dir), _digests(spark, sf_dir))


_CELLS = [(f"src{k}", code, 10 * k) for k in range(22) for code in ("good", "toxic")]


# Published cells against counted ones
@_query(f"""WITH {_LABELS}, c AS (SELECT split_part(record_id, ':', 1) AS source_id, code, count(*) AS n FROM label GROUP BY ALL),
    p AS (SELECT * FROM (VALUES {', '.join(f"('{s}', '{c}', {n}::BIGINT)" for s, c, n in _CELLS)}) t(source_id, code, published))
    SELECT source_id, code, published, coalesce(n, 0) AS counted, published = coalesce(n, 0) AS agrees FROM p LEFT JOIN c USING (source_id, code)""")
def published_vs_counted(spark, sf_dir):
    cells = spark.createDataFrame(_CELLS, "source_id string, code string, published long")
    return labels.compare_with_published(cells, label_counts_per_source(spark, sf_dir))


# Codes through a map, with its source
@_query("""WITH m AS (SELECT * FROM (VALUES ('en', '1.0', 'a'), ('fr', 'nan', 'a'), ('de', '4065390.0', 'b'), ('es', ' ', 'c')) t(lang, raw, map_source)),
    s AS (SELECT * FROM (VALUES ('a', 'd1'), ('b', 'd2')) t(map_source, map_sha256))
    SELECT doc_id, documents.lang, CASE WHEN trim(raw) IN ('', 'nan') THEN NULL ELSE CAST(CAST(CAST(raw AS DOUBLE) AS BIGINT) AS VARCHAR) END AS to_code, map_sha256
    FROM documents LEFT JOIN m ON m.lang = documents.lang LEFT JOIN s ON s.map_source = m.map_source""")
def code_map(spark, sf_dir):
    m = spark.createDataFrame([("en", "1.0", "a"), ("fr", "nan", "a"), ("de", "4065390.0", "b"), ("es", " ", "c")], "lang string, raw string, map_source string")
    s = spark.createDataFrame([("a", "d1"), ("b", "d2")], "map_source string, map_sha256 string")
    mapped = m.join(F.broadcast(s), "map_source", "left").withColumn("to_code", S.concept_id("raw"))  # four rows by two
    return _t(spark, sf_dir, "documents").join(F.broadcast(mapped), "lang", "left").select("doc_id", "lang", "to_code", "map_sha256")


# Ids that name a bundled record
@_query("""WITH k AS (SELECT 'HR' || lpad(CAST(o_custkey AS VARCHAR), CAST(greatest(5, length(CAST(o_custkey AS VARCHAR))) AS INTEGER), '0') AS id FROM orders),
    b AS (SELECT 'HR' || substr(c_name, length(c_name) - 4) AS id FROM customer)
    SELECT (SELECT count(*) FROM k) AS n_keys, (SELECT count(*) FROM k WHERE id IN (SELECT id FROM b)) AS n_named, (SELECT count(*) FROM b WHERE id NOT IN (SELECT id FROM k)) AS n_unnamed_bundled""")
def named_join_audit(spark, sf_dir):
    native = _t(spark, sf_dir, "orders").select(F.format_string("%05d_hr", "o_custkey").alias("native_record_id"))
    bundled = _t(spark, sf_dir, "customer").select(F.concat(F.lit("HR"), F.right("c_name", F.lit(5))).alias("native_record_id"))
    return labels.named_join(native, bundled)


# Patients by source
@_query("""SELECT n_name AS source_id, count(DISTINCT c_custkey) AS n_patients, count(o_orderkey) AS n_records FROM customer JOIN nation ON n_nationkey = c_nationkey
           LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name""")
def patients_by_source(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").join(_t(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    rows = c.join(_t(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.groupBy(F.col("n_name").alias("source_id")).agg(F.count_distinct("c_custkey").alias("n_patients"), F.count("o_orderkey").alias("n_records"))


# Sources without a toxic label
@_query(f"WITH {_LABELS} SELECT DISTINCT source AS source_id FROM documents WHERE source NOT IN (SELECT split_part(record_id, ':', 1) FROM label WHERE code = 'toxic')")
def silent_sources(spark, sf_dir):
    toxic = _labels(spark, sf_dir).filter("code = 'toxic'").select(S.left_of("record_id", ":").alias("source_id"))
    return labels.silent_sources(_t(spark, sf_dir, "documents").select(F.col("source").alias("source_id")), toxic)


def _manifest(spark, sf_dir):
    """Digests of documents, and a manifest that leaves out, changes and adds some."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("relative_path"), F.sha2("text", 256).alias("digest"))
    k = F.col("doc_id") % 17
    declared = d.filter(k != 3).select("source", "relative_path", F.when(k == 5, F.sha2("digest", 256)).otherwise(F.col("digest")).alias("digest"))
    extra = d.filter(k == 7).select("source", F.concat("relative_path", F.lit(".gone")).alias("relative_path"), "digest")
    return declared.unionByName(extra), d


_MANIFEST = """d AS (SELECT doc_id, source, source || '/' || doc_id AS relative_path, sha256(text) AS digest FROM documents),
    m AS (SELECT relative_path, CASE WHEN doc_id % 17 = 5 THEN sha256(digest) ELSE digest END AS digest FROM d WHERE doc_id % 17 <> 3
          UNION ALL SELECT relative_path || '.gone', digest FROM d WHERE doc_id % 17 = 7),
    v AS (SELECT coalesce(m.relative_path, d.relative_path) AS relative_path, m.digest AS declared, d.digest AS observed,
          CASE WHEN d.digest IS NULL THEN 'missing' WHEN m.digest IS NULL THEN 'unlisted' WHEN m.digest = d.digest THEN 'matched' ELSE 'mismatched' END AS outcome
          FROM m FULL JOIN d ON m.relative_path = d.relative_path)"""


# Four outcomes of a manifest
@_query(f"WITH {_MANIFEST} SELECT * FROM v")
def manifest_four_outcomes(spark, sf_dir):
    declared, d = _manifest(spark, sf_dir)
    return manifest.verify(declared, d)


# Report of a manifest by source
@_query(f"""WITH {_MANIFEST} SELECT split_part(relative_path, '/', 1) AS source_id, count(*) FILTER (outcome = 'matched') AS n_matched, count(*) FILTER (outcome = 'mismatched') AS n_mismatched,
    count(*) FILTER (outcome = 'missing') AS n_missing, count(*) FILTER (outcome = 'unlisted') AS n_unlisted, count(declared) AS n_declared,
    count(*) FILTER (outcome IN ('matched', 'mismatched')) AS n_checked, count(*) FILTER (outcome IN ('mismatched', 'missing')) = 0 AS holds FROM v GROUP BY 1""")
def manifest_report(spark, sf_dir):
    v = manifest_four_outcomes(spark, sf_dir).withColumn("source_id", S.left_of("relative_path", "/"))
    return manifest.report(v, ["source_id"])


# Manifest lines parsed, prefix taken off
@_query("SELECT CAST(doc_id AS VARCHAR) AS relative_path, sha256(text) AS digest FROM documents WHERE source LIKE 'src1%'")
def manifest_parse(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    mark = F.when(F.col("doc_id") % 2 == 0, " *").otherwise("  ")
    lines = d.select(F.col("doc_id").alias("line_no"), F.concat(F.sha2("text", 256), mark, F.lit("all/"), F.when(F.startswith("source", F.lit("src1")), "one/").otherwise("two/"), F.col("doc_id").cast("string")).alias("line"))
    return manifest.parse_lines(lines, "all/one/")


#: Event types stand for leads.
_TYPES = ["click", "error", "purchase", "signup", "view"]
_N = 20


def _judged(spark, sf_dir) -> DataFrame:
    """Per user and event type the first values in time, judged like leads; types a user lacks are missing."""
    e = _t(spark, sf_dir, "events")
    first = e.withColumn("k", F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id"))).filter(F.col("k") <= _N)
    wave = F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda x: x["value"])
    lead = first.groupBy("user_id", "event_type").agg(wave.alias("samples"))
    flag = lambda test: F.array_join(F.array_sort(F.collect_list(F.when(test, F.col("event_type")))), "|")
    found = F.array_sort(F.collect_set("event_type"))
    every = _t(spark, sf_dir, "events").select("event_type").distinct().agg(F.array_sort(F.collect_set("event_type")).alias("every"))
    per = lead.groupBy("user_id").agg(
        flag(A.is_flat("samples")).alias("flat_leads"), flag(A.is_saturated("samples")).alias("saturated_leads"), F.sum(A.n_nonfinite("samples")).alias("n_nonfinite"),
        F.sum(F.size("samples")).cast("long").alias("n_samples_read"), found.alias("found"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_type", "samples"))), lambda x: A.steps_text(x["samples"])), ";"), 256).alias("signal_digest"),
    )
    per = per.crossJoin(every).withColumn("missing_leads", S.joined(F.array_except("every", "found")))  # one row
    holds = (F.length("missing_leads") + F.length("flat_leads") + F.length("saturated_leads") == 0) & (F.col("n_nonfinite") == 0)
    return per.select("user_id", "missing_leads", "flat_leads", "saturated_leads", "n_nonfinite", "n_samples_read", "signal_digest", holds.alias("holds"))


_JUDGED = f"""f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k FROM events) WHERE k <= {_N}),
    l AS (SELECT user_id, event_type, count(*) AS n, min(value) AS lo, max(value) AS hi, string_agg(CAST(CAST(round_even(CAST(CAST(value AS FLOAT) * 100::FLOAT AS DOUBLE), 0) AS INT) AS VARCHAR), ',' ORDER BY k) AS steps FROM f GROUP BY ALL),
    x AS (SELECT f.user_id, f.event_type, count(*) AS at_end FROM f JOIN l USING (user_id, event_type) WHERE value = lo OR value = hi GROUP BY ALL),
    j AS (SELECT l.*, lo = hi AS flat, lo <> hi AND at_end >= 0.01 * n AS saturated FROM l JOIN x USING (user_id, event_type)),
    q AS (SELECT user_id, coalesce(string_agg(event_type, '|' ORDER BY event_type) FILTER (flat), '') AS flat_leads,
          coalesce(string_agg(event_type, '|' ORDER BY event_type) FILTER (saturated), '') AS saturated_leads, 0::BIGINT AS n_nonfinite, sum(n)::BIGINT AS n_samples_read,
          list_sort(list(event_type)) AS found, sha256(string_agg(steps, ';' ORDER BY event_type)) AS signal_digest FROM j GROUP BY user_id),
    qq AS (SELECT user_id, array_to_string(list_filter((SELECT list_sort(list(DISTINCT event_type)) FROM events), lambda t: NOT list_contains(found, t)), '|') AS missing_leads,
          flat_leads, saturated_leads, n_nonfinite, n_samples_read, signal_digest FROM q),
    z AS (SELECT *, missing_leads = '' AND flat_leads = '' AND saturated_leads = '' AND n_nonfinite = 0 AS holds FROM qq)"""


# Quality flags and fingerprints
@_query(f"WITH {_JUDGED} SELECT * FROM z")
def quality_flags(spark, sf_dir):
    return _judged(spark, sf_dir)


# Their summary
@_query(f"""WITH {_JUDGED} SELECT count(*) AS n_records, count(*) FILTER (holds) AS n_clean, count(*) FILTER (missing_leads <> '') AS n_missing_lead, count(*) FILTER (flat_leads <> '') AS n_flat_lead,
    count(*) FILTER (saturated_leads <> '') AS n_saturated_lead, count(*) FILTER (n_nonfinite > 0) AS n_nonfinite, count(DISTINCT signal_digest) AS n_distinct_signal_digests,
    count(*) - count(DISTINCT signal_digest) AS n_repeats_within, array_to_string(list_sort(list(DISTINCT n_samples_read)), '|') AS window_samples FROM z""")
def quality_summary(spark, sf_dir):
    return reports.quality_summary(_judged(spark, sf_dir)).withColumn("window_samples", F.array_join("window_samples", "|"))


# A5: faults by lead
@_query(f"WITH {_JUDGED} SELECT lead, count(*) AS n FROM (SELECT unnest(string_split(saturated_leads, '|')) AS lead FROM z WHERE saturated_leads <> '') GROUP BY lead")
def faults_by_lead(spark, sf_dir):
    return reports.faults_by_lead(_judged(spark, sf_dir), "saturated_leads")


# quantised fingerprints
@_query("SELECT vec_id, sha256(array_to_string(list_transform(embedding, lambda x: CAST(round_even(CAST(x * 100::FLOAT AS DOUBLE), 0) AS INT)), ',')) AS fingerprint FROM embeddings")
def quantised_fingerprint(spark, sf_dir):
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.sha2(A.steps_text("embedding"), 256).alias("fingerprint"))


# Best match by correlation of every even vector among the odd ones
@_query("""WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS k FROM embeddings),
    r AS (SELECT t.vec_id AS t, c.vec_id AS c, corr(t.x, c.x) AS r FROM v t JOIN v c ON t.k = c.k AND t.vec_id % 2 = 0 AND c.vec_id % 2 = 1 GROUP BY ALL),
    b AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY r DESC, c) AS k FROM r WHERE r >= 0.35)
    SELECT CAST(least(lpad(CAST(t AS VARCHAR), 9, '0'), lpad(CAST(c AS VARCHAR), 9, '0')) AS VARCHAR) AS record_a, greatest(lpad(CAST(t AS VARCHAR), 9, '0'), lpad(CAST(c AS VARCHAR), 9, '0')) AS record_b,
           'correlation' AS sieve, round(r, 6) AS score, 'across-distributions' AS scope FROM b WHERE k = 1""")
def correlation_best_match(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings").select(F.format_string("%09d", "vec_id").alias("record_id"), F.col("embedding").alias("wave"), F.col("vec_id").alias("ordinal"))
    found = duplicates.correlate(e.filter("ordinal % 2 = 0"), e.filter("ordinal % 2 = 1"), threshold=0.35)
    return found.withColumn("score", F.round("score", 6))


# Copies compared sample by sample
@_query("""WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS k FROM embeddings)
    SELECT a.vec_id, bool_and(a.x = b.x) AS same_samples, round(max(abs(a.x - b.x)), 6) AS largest_difference, round(corr(a.x, b.x), 6) AS correlation
    FROM v a JOIN v b ON b.vec_id = a.vec_id + 1 AND a.k = b.k GROUP BY a.vec_id""")
def exact_copy_check(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    a, b = e.select("vec_id", doubles.alias("x")), e.select((F.col("vec_id") - 1).alias("vec_id"), doubles.alias("y"))
    return a.join(b, "vec_id").select("vec_id", A.same_samples("x", "y").alias("same_samples"), F.round(A.largest_difference("x", "y"), 6).alias("largest_difference"), F.round(A.correlation("x", "y"), 6).alias("correlation"))


# Units as declared
@_query("""WITH u AS (SELECT conv_id, CASE role WHEN 'user' THEN 'mV' WHEN 'assistant' THEN 'uV' ELSE '' END AS unit FROM conversations)
    SELECT conv_id, coalesce(array_to_string(list_sort(list(DISTINCT unit) FILTER (unit <> '')), '|'), '') AS units_declared, bool_and(unit <> '') AS units_are_declared, bool_and(lower(unit) = 'mv') AS all_millivolts FROM u GROUP BY conv_id""")
def units_summary(spark, sf_dir):
    unit = F.when(F.col("role") == "user", "mV").when(F.col("role") == "assistant", "uV").otherwise("")
    c = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(unit).alias("units"))
    return c.select("conv_id", S.joined(S.distinct_units("units")).alias("units_declared"), S.units_are_declared("units").alias("units_are_declared"), S.all_millivolts("units").alias("all_millivolts"))


# Corpora with exactly two distributions: texts that two sources have
@_query("""SELECT corpus, string_agg(source_id, '|' ORDER BY source_id) AS source_ids FROM (SELECT DISTINCT sha256(text) AS corpus, source AS source_id FROM documents WHERE source IS NOT NULL)
           GROUP BY corpus HAVING count(*) = 2""")
def paired_corpora(spark, sf_dir):
    listed = _t(spark, sf_dir, "documents").filter("source IS NOT NULL").select(F.sha2("text", 256).alias("corpus"), F.col("source").alias("source_id")).distinct()
    return catalog.paired_corpora(listed).withColumn("source_ids", S.joined("source_ids"))


# Rows of several distributions, chosen in one scan
@_query("SELECT lang AS source_id, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM documents WHERE lang IN ('en', 'fr', 'de', 'es') GROUP BY lang")
def scan_union_all(spark, sf_dir):
    d = catalog.only(_t(spark, sf_dir, "documents").withColumnRenamed("lang", "source_id"), ["en", "fr", "de", "es"])
    return d.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))


# U4: names that records of two sides share
@_query("SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS native_record_id FROM customer JOIN supplier ON s_suppkey = c_custkey")
def shared_native_ids(spark, sf_dir):
    left = _t(spark, sf_dir, "customer").select(F.concat(F.lit("a:"), F.col("c_custkey").cast("string")).alias("record_id"))
    right = _t(spark, sf_dir, "supplier").select(F.concat(F.lit("b:"), F.col("s_suppkey").cast("string")).alias("record_id"))
    return reports.shared_native_ids(left, right)


# A seeded sample (the sample is the operator)
@_query("SELECT doc_id, source FROM documents ORDER BY sha256('20260908:' || doc_id), doc_id LIMIT 25")
def seeded_sample(spark, sf_dir):
    return reports.hash_sample(_t(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 25, 20260908)


# Written, found and read again
@_query(f"WITH {_LABELS} SELECT 'record' AS \"table\", count(*) AS n FROM documents UNION ALL SELECT 'label', count(*) FROM label")
def delivery_roundtrip(spark, sf_dir):
    out = f"{Scratch(spark).root}/delivery"
    d = _record_id(_t(spark, sf_dir, "documents")).select("record_id", F.col("source").alias("source_id"), F.col("n_chars").alias("n_samples"))
    blank = {f.name: F.lit(None) for f in delivery.TABLES["record"] if f.name not in d.columns}
    delivery.write({"record": shaped(d.withColumns(blank), "record"), "label": _labels(spark, sf_dir)}, out)
    return reports.database_report({name: delivery.read(spark, out, name) for name in delivery.present(spark, out)})
