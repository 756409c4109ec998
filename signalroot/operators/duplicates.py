"""Three sieves for the same recording under two names: digests, then correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import shaped
from .correlation import best_matches

THRESHOLD = 0.99


class PairCapExceeded(ValueError):
    """A comparison of every target with every candidate that costs too much."""


def groups(digests: DataFrame, id_col: str = "record_id", digest_col: str = "digest") -> DataFrame:
    """digest -> sorted members; null digests are in no group."""
    return digests.filter(F.col(digest_col).isNotNull()).groupBy(F.col(digest_col).alias("digest")).agg(F.array_sort(F.collect_list(id_col)).alias("members"))


#: Members of a digest group in a block; the pairs of two blocks are one piece of a join.
BLOCK = 1024


def pairs_by_digest(digests: DataFrame, sieve: str) -> DataFrame:
    """All pairs of records that share a digest, as links of score 1.

    `digests` is (record_id, source_id, digest). The pairs of a group are the
    operator's result; `chain_by_digest` has what components need, in linear size.
    A group of more than `BLOCK` members is cut into blocks by a hash of the id,
    and every two blocks meet under a key of their own: the first with itself and
    all later ones, so each pair is made once and no task has a group's square.
    """
    rows = digests.filter("digest IS NOT NULL").select("digest", F.col("record_id").alias("id"), F.col("source_id").alias("source"))
    large = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK).select("digest", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    cut = rows.join(large, "digest", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    first = cut.select("digest", F.col("mine").alias("x"), F.explode(F.sequence(F.col("mine"), F.col("blocks") - 1)).alias("y"), F.col("id").alias("id_a"), F.col("source").alias("source_a"))
    second = cut.select("digest", F.explode(F.sequence(F.lit(0), F.col("mine"))).alias("x"), F.col("mine").alias("y"), F.col("id").alias("id_b"), F.col("source").alias("source_b"))
    met = first.join(second, ["digest", "x", "y"]).filter("x < y AND id_a != id_b OR id_a < id_b")
    ends = dict(zip(("record_a", "record_b"), pair("id_a", "id_b")))
    return shaped(met.withColumns(ends | {"sieve": F.lit(sieve), "score": F.lit(1.0), "scope": S.scope("source_a", "source_b")}), "duplicate_link")


def chain_by_digest(digests: DataFrame, id_col: str = "record_id", digest_col: str = "digest") -> DataFrame:
    """(a, b) edges from each member to the smallest of its digest group."""
    rows = digests.filter(F.col(digest_col).isNotNull()).select(F.col(digest_col).alias("digest"), F.col(id_col).alias("b"))
    return rows.join(rows.groupBy("digest").agg(F.min("b").alias("a")), "digest").filter("a != b").select("a", "b")


def pair(first: str, second: str) -> tuple:
    """A link's ends in their normal form, the smaller first."""
    return F.least(first, second).alias("record_a"), F.greatest(first, second).alias("record_b")


def merge(*links: DataFrame) -> DataFrame:
    """One link per pair: the earliest group's sieve, of that sieve the highest score; sorted by pair."""
    ranked = None
    for k, frame in enumerate(links):
        one = frame.withColumn("rank", F.lit(k))
        ranked = one if ranked is None else ranked.unionByName(one)
    by_pair = Window.partitionBy("record_a", "record_b")
    first = F.min_by("sieve", F.struct("rank", -F.col("score"), "sieve")).over(by_pair)
    own = ranked.withColumn("first", first).filter("sieve = first")
    best = own.withColumn("nth", F.row_number().over(by_pair.orderBy(F.desc("score"), "rank"))).filter("nth = 1")
    return shaped(best, "duplicate_link").orderBy("record_a", "record_b")


def unmatched(records: DataFrame, links: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Ids that no link mentions, sorted."""
    ends = links.select(F.col("record_a").alias(id_col)).unionByName(links.select(F.col("record_b").alias(id_col)))
    return records.select(id_col).join(ends, id_col, "left_anti").orderBy(id_col)


def correlate(targets: DataFrame, candidates: DataFrame, threshold: float = THRESHOLD, max_pairs: int | None = None, scope: str = S.ACROSS) -> DataFrame:
    """For each target its best candidate by correlation, if that reaches `threshold`, through `correlation.best_matches`.

    `targets` are (record_id, wave), `candidates` (record_id, wave[, ordinal]); of
    equal scores the smallest ordinal wins, then the smallest id. With `max_pairs`
    a comparison of more pairs than that is refused, before any wave is read.
    """
    if max_pairs is not None:
        n = targets.count()
        m = candidates.count() if n else 0
        if n * m > max_pairs:
            raise PairCapExceeded(f"{n} targets by {m} candidates is more than {max_pairs} pairs")
    ordinal = F.col("ordinal") if "ordinal" in candidates.columns else F.lit(0)
    t = targets.select(F.col("record_id").alias("id"), F.lit(0).alias("ordinal"), "wave")
    c = candidates.select(F.col("record_id").alias("id"), ordinal.alias("ordinal"), "wave")
    best = best_matches(t, c, threshold)
    rows = best.select(*pair("target", "candidate"), F.lit("correlation").alias("sieve"), "score", F.lit(scope).alias("scope"))
    return shaped(rows, "duplicate_link")


def correlate_both(left: DataFrame, right: DataFrame, left_rest: DataFrame, right_rest: DataFrame, **options) -> tuple[DataFrame | None, str | None]:
    """Each side's leftovers against the whole other side: (links, note).

    A refused direction becomes the note; links of a direction that was
    affordable stay.
    """
    links = None
    for targets, candidates in ((left_rest, right), (right_rest, left)):
        try:
            found = correlate(targets, candidates, **options)
        except PairCapExceeded as refused:
            return links, str(refused)
        links = found if links is None else links.unionByName(found)
    return links, None
