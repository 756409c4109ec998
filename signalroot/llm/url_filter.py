"""URL filter: host and path rules, then gradient-boosted trees on lexical features.

The trees are trained on the driver from labelled URLs, a parameter, and become
one SQL expression, so the main path is a projection inside whole-stage code
generation: no shuffle, no join, no Python on the executors.
"""

from __future__ import annotations

import math
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, trees

# Neutral words that the composed training URLs are made of.
_WORDS = (
    "garden river museum bridge cloud copper lantern harvest meadow orbit pepper quartz rocket saddle timber valley walnut yellow zephyr anchor "
    "basket candle desert engine forest glacier island jacket kettle ladder magnet needle oyster paddle ribbon silver tunnel velvet window"
).split()
#: Suffixes of composed hosts; the first ones are likelier for pages worth crawling, the last for others.
_SUFFIXES = ("edu", "org", "io", "net", "com", "info", "biz", "top")
SUFFIX_WEIGHT = 4.0
Labelled = tuple[tuple[str, int], ...]


@lru_cache(4)
def composed_urls(n: int = 1200, seed: int = 17, words: tuple[str, ...] = tuple(_WORDS)) -> Labelled:
    """(url, 1 if not worth crawling): URLs by a rule, for want of labelled ones.

    A page not worth crawling tends to have a longer, more random or hyphenated
    host, more digits, deeper paths, more parameters and a cheaper suffix; each
    URL shows only some of these, and good pages show some as well, so that no
    one of them tells the classes apart.
    """
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    noise = lambda k, of=letters: "".join(rng.choice(of) for _ in range(k))
    out = []
    for k in range(n):
        bad = k % 2
        often = lambda good, junk: rng.random() < (junk if bad else good)  # noqa: B023, E731
        label = ("-" if often(0.3, 0.5) else "").join(rng.choices(words, k=rng.choice((1, 1, 2, 3) if bad else (1, 1, 2))))
        if often(0.08, 0.45):
            label = noise(rng.randrange(7, 16)) + (label if rng.random() < 0.4 else "")
        if often(0.1, 0.4):
            label += noise(rng.randrange(1, 5), "0123456789")
        if often(0.05, 0.3):
            label += "-" + "-".join(rng.choices(words, k=rng.randrange(1, 4)))
        at = sorted((min(int(rng.betavariate(*((1.6, 1.2) if bad else (1.2, 1.6))) * len(_SUFFIXES)), len(_SUFFIXES) - 1), 7))[0]
        host = f"{rng.choice(('www.', '', '', 'm.', 'en.'))}{noise(5) + '.' if often(0.03, 0.2) else ''}{label}.{_SUFFIXES[at]}"
        depth = max(0, round(rng.gauss(3.6, 2.0) if bad else rng.gauss(2.2, 1.2)))
        parts = [noise(rng.randrange(3, 9), "0123456789") if often(0.12, 0.4) else noise(8) if often(0.03, 0.15) else rng.choice(words) for _ in range(depth)]
        path = "/" + "/".join(parts) + rng.choice(("", "", "/", ".html", ".php" if bad else ".html"))
        many = max(0, round(rng.gauss(2.0, 1.8) if bad else rng.gauss(0.3, 0.9)))
        query = "&".join(f"{rng.choice(('id', 'q', 'page', 'ref', 's'))}={noise(rng.randrange(1, 10), letters if often(0.3, 0.6) else '0123456789')}" for _ in range(many))
        out.append((f"{rng.choice(('https', 'https', 'http'))}://{host}{path}{'?' + query if query else ''}", bad))
    return tuple(out)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) as the SQL below computes them."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    return raw.translate(str.maketrans(common.UPPER, common.LOWER)), re.match(r"[^?#]*", rest[len(raw):])[0]


def suffix(host: str) -> str:
    return host.rsplit(".", 1)[-1]


@lru_cache(8)
def suffix_rates(labelled: Labelled) -> tuple[tuple[str, float], ...]:
    """Share of blocked URLs by last host label, shrunk to one half."""
    seen: dict[str, list[int]] = {}
    for url, y in labelled:
        seen.setdefault(suffix(split_url(url)[0]), []).append(y)
    return tuple(sorted((s, (sum(v) + SUFFIX_WEIGHT / 2) / (len(v) + SUFFIX_WEIGHT)) for s, v in seen.items()))


def features(url: str | None, rates: dict[str, float]) -> list[float]:
    host, path = split_url(url)
    url = url or ""
    n = max(len(url), 1)
    counts = [host.count(c) / max(len(host), 1) for c in sorted(set(host))]
    return [
        len(url), len(host), path.count("/"), sum(c in "0123456789" for c in url) / n,
        -sum(p * math.log2(p) for p in counts), url.count("&") + url.count("?"), host.count("."), host.count("-"),
        sum(c in "0123456789" for c in host), rates.get(suffix(host), 0.5),
    ]


NAMES = ["url_len", "host_len", "depth", "digit_ratio", "entropy", "params", "dots", "hyphens", "host_digits", "suffix_rate"]


def text_sql(text: str, dialect: str) -> str:
    """A string as a literal of either SQL."""
    if dialect == "duckdb":
        return "'" + text.replace("'", "''") + "'"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _count(column: str, char: str) -> str:
    return f"(length({column}) - length(replace({column}, '{char}', '')))"


def feature_sql(dialect: str, rates: tuple[tuple[str, float], ...]) -> dict[str, str]:
    """SQL of each feature over the columns u (url or ''), host and path."""
    duck = dialect == "duckdb"
    strip = (lambda c: f"length(regexp_replace({c}, '[^0-9]', '', 'g'))") if duck else (lambda c: f"length(regexp_replace({c}, '[^0-9]', ''))")
    share = f"({_count('host', 'C')} / CAST(length(host) AS DOUBLE))".replace("'C'", "c")
    entropy = (
        f"-coalesce(list_sum(list_transform(list_distinct(string_split(host, '')), lambda c: {share} * log2({share}))), 0)"
        if duck
        else f"-aggregate(transform(array_distinct(split(host, '')), c -> {share} * log2({share})), 0D, (a, b) -> a + b)"
    )
    cases = " ".join(f"WHEN {text_sql(s, dialect)} THEN CAST({r!r} AS DOUBLE)" for s, r in rates)
    last = "regexp_extract(host, '[^.]*$', 0)" if duck else "substring_index(host, '.', -1)"
    return dict(zip(NAMES, [
        "length(u)", "length(host)", _count("path", "/"), f"{strip('u')} / CAST(greatest(length(u), 1) AS DOUBLE)",
        f"CASE WHEN host = '' THEN CAST(0 AS DOUBLE) ELSE {entropy} END",
        f"({_count('u', '&')} + {_count('u', '?')})", _count("host", "."), _count("host", "-"), strip("host"),
        f"CASE {last} {cases} ELSE CAST(0.5 AS DOUBLE) END" if rates else "CAST(0.5 AS DOUBLE)",
    ]))


@lru_cache(4)
def model(labelled: Labelled, n_trees: int = 40, depth: int = 3, rate: float = 0.3) -> tuple[trees.Node, ...]:
    """Boosted trees; none without URLs of both kinds."""
    if len({y for _, y in labelled}) < 2:
        return ()
    rates = dict(suffix_rates(labelled))
    x = np.array([features(u, rates) for u, _ in labelled], float)
    return tuple(trees.boost(x, np.array([y for _, y in labelled], float), n_trees, depth, rate))


def margin_sql(forest: tuple[trees.Node, ...]) -> str:
    return " + ".join(f"({trees.as_sql(t, NAMES)})" for t in forest) or "CAST(0 AS DOUBLE)"


def rule_sql(rules: list[tuple[str, str]], dialect: str) -> tuple[str, str]:
    """SQL for the rule that fits, longest first, and for its verdict."""
    which, verdict = [], []
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        host, slash, rest = rule.partition("/")
        path = slash + rest
        name, under, begin, whole, said = (text_sql(x, dialect) for x in (host, f".{host}", path, rule, action))
        test = f"(host = {name} OR right(host, {len(host) + 1}) = {under}) AND left(path, {len(path)}) = {begin}"
        which.append(f"WHEN {test} THEN {whole}")
        verdict.append(f"WHEN {test} THEN {said}")
    none = "CAST(NULL AS STRING)" if dialect == "spark" else "CAST(NULL AS VARCHAR)"
    return tuple(f"CASE {' '.join(x)} END" if x else none for x in (which, verdict))


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", threshold: float = 0.0, labelled: Labelled | None = None) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, margin.

    `rules` are (allow or block, 'host/path') pairs; the longest that fits wins,
    and where none fits the trees decide: block if their margin is over `threshold`.
    The trees are trained on `labelled`, (url, 1 for block or 0) pairs that fit on
    the driver; by default on `composed_urls()`.

    - a null url, or one without '://', has an empty host and path and fits no rule.
    - repeated rows and ids each give a row; an empty table gives an empty result.
    - without rules the trees decide alone; without labelled URLs of both kinds their margin is 0.
    - very long URLs are read whole; columns beyond id and url are not read.
    """
    rest = "CASE WHEN instr(u, '://') > 0 THEN substring(u, instr(u, '://') + 3) ELSE '' END"
    which, said = rule_sql(rules, "spark")
    labelled = composed_urls() if labelled is None else tuple(labelled)
    parts = (
        pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("u"))
        .withColumn("rest", F.expr(rest))
        .withColumn("raw", F.expr("regexp_extract(rest, '^[^/?#]*', 0)"))
        .withColumn("host", common.ascii_lower(F.col("raw")))
        .withColumn("path", F.expr("regexp_extract(substring(rest, length(raw) + 1), '^[^?#]*', 0)"))
    )
    parts = parts.select("id", "host", "path", *[F.expr(sql).alias(name) for name, sql in feature_sql("spark", suffix_rates(labelled)).items()])
    parts = parts.select("id", "host", "path", F.expr(which).alias("rule"), F.expr(said).alias("said"), F.expr(margin_sql(model(labelled))).alias("margin"))
    return parts.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("said", F.when(F.col("margin") > threshold, "block").otherwise("allow")).alias("verdict"),
        "margin",
    )


def oracle(rules: list[tuple[str, str]]) -> str:
    """The same filter as DuckDB SQL over the view `pages`."""
    which, said = rule_sql(rules, "duckdb")
    names = ", ".join(f"{sql} AS {name}" for name, sql in feature_sql("duckdb", suffix_rates(composed_urls())).items())
    return f"""
        WITH a AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
        b AS (SELECT *, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM a),
        c AS (SELECT *, regexp_extract(rest, '^[^/?#]*', 0) AS raw FROM b),
        d AS (SELECT page_id, u, translate(raw, '{common.UPPER}', '{common.LOWER}') AS host,
              regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*', 0) AS path FROM c),
        e AS (SELECT page_id, host, path, {names} FROM d)
        SELECT page_id, host, path, {which} AS rule,
               coalesce({said}, CASE WHEN {margin_sql(model(composed_urls()))} > 0 THEN 'block' ELSE 'allow' END) AS verdict
        FROM e"""
