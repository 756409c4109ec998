"""Scalar expressions: names, paths, identifiers, normal forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The twelve leads in their canonical order.
CANONICAL_LEADS = ("I", "II", "III", "aVR", "aVL", "aVF", "V1", "V2", "V3", "V4", "V5", "V6")
# Scopes of a link, and the sieves that find links, in their order.
WITHIN, ACROSS = "within-distribution", "across-distributions"
BY_FILE, BY_SIGNAL, BY_CORRELATION = "source-file", "signal", "correlation"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def canonical_lead(name: Column | str) -> Column:
    """The canonical spelling of a lead name, null for any other name."""
    pairs = F.create_map(*[F.lit(x) for lead in CANONICAL_LEADS for x in (lead.upper(), lead)])
    return F.try_element_at(pairs, F.upper(F.trim(_col(name))))


def in_millivolts(unit: Column | str) -> Column:
    return F.lower(F.trim(_col(unit))) == "mv"


def file_id(source_id: Column | str, path: Column | str) -> Column:
    """`source:path`, null if either is null."""
    return F.concat(_col(source_id), F.lit(":"), _col(path))


def left_of(text: Column | str, mark: str) -> Column:
    return F.substring_index(_col(text), mark, 1)


def right_of(text: Column | str, mark: str) -> Column:
    """What follows the first `mark`; null if there is none."""
    parts = F.split(_col(text), mark.replace("|", r"\|"), 2)
    return F.try_element_at(parts, F.lit(2))


def parent(path: Column | str) -> Column:
    """The folder of a path, '' for a bare name."""
    return F.regexp_extract(_col(path), r"^(.*)/[^/]*$", 1)


def stem(path: Column | str) -> Column:
    """The name without its folder and last extension."""
    return F.regexp_extract(_col(path), r"([^/]+?)(?:\.[^./]*)?$", 1)


def bundle_id(number: Column | str) -> Column:
    """HR and at least five digits; longer numbers keep all of theirs."""
    return F.format_string("HR%05d", _col(number).cast("long"))


def concept_id(value: Column | str) -> Column:
    """An integer as text; null for blank, nan and none."""
    text = F.lower(F.trim(_col(value).cast("string")))
    number = F.when(text.isin("", "nan", "none"), None).otherwise(text).try_cast("double")
    return number.cast("bigint").cast("string")


def integer_text(value: Column | str) -> Column:
    return _col(value).cast("bigint").cast("string")


def duration_s(n_samples: Column | str, rate: Column | str) -> Column:
    return _col(n_samples) / _col(rate)


def scope(source_a: Column | str, source_b: Column | str) -> Column:
    """Within one source or across two; two unknown sources count as one."""
    return F.when(_col(source_a).eqNullSafe(_col(source_b)), WITHIN).otherwise(ACROSS)


def joined(values: Column | str) -> Column:
    return F.array_join(_col(values), "|")


def items(text: Column | str) -> Column:
    """Comma-separated items, each trimmed; empty ones stay."""
    return F.transform(F.split(_col(text), ","), lambda x: F.trim(x))


def comment_value(comments: Column | str, key: str) -> Column:
    """The value of the first comment `key: value`, whatever its case; empty is null."""
    mark = f"{key.lower()}:"
    found = F.try_element_at(F.filter(_col(comments), lambda c: F.startswith(F.lower(F.trim(c)), F.lit(mark))), F.lit(1))
    return F.nullif(F.trim(F.substr(F.trim(found), F.lit(len(mark) + 1))), F.lit(""))


def distinct_units(units: Column | str) -> Column:
    return F.array_sort(F.array_distinct(F.filter(_col(units), lambda u: u != "")))


def units_are_declared(units: Column | str) -> Column:
    return (F.size(_col(units)) > 0) & F.forall(_col(units), lambda u: u != "")


def all_millivolts(units: Column | str) -> Column:
    return (F.size(_col(units)) > 0) & F.forall(_col(units), in_millivolts)
