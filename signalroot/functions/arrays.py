"""Expressions over arrays of samples; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import _col

# Hundredths of a millivolt, the mark of a missing sample, the share
# of samples at the extremes that makes a lead saturated, seconds of a window.
STEPS_PER_MV, NO_SAMPLE, SATURATED_SHARE, WINDOW_S = 100, -2147483648, 0.01, 10


def finite(x: Column) -> Column:
    return ~(F.isnan(x) | F.isnull(x)) & (F.abs(x) != float("inf"))


def window_length(rate: Column | str, n_samples: Column | str) -> Column:
    """Samples of the first ten seconds; halves round to even."""
    return F.least(F.rint(F.lit(float(WINDOW_S)) * _col(rate)).cast("int"), _col(n_samples).cast("int"))


def first_samples(samples: Column | str, n: Column) -> Column:
    return F.slice(_col(samples), 1, F.greatest(n, F.lit(0)))


def steps(samples: Column | str) -> Column:
    """Samples as integer steps in single precision; what isn't finite has a mark of its own."""
    return F.transform(_col(samples), lambda x: F.when(finite(x), F.rint(x.cast("float") * F.lit(float(STEPS_PER_MV)).cast("float")).cast("int")).otherwise(F.lit(NO_SAMPLE)))


def steps_text(samples: Column | str) -> Column:
    return F.array_join(F.transform(steps(samples), lambda s: s.cast("string")), ",")


def _little_endian(step: Column) -> Column:
    wide = F.lpad(F.hex(step.cast("long")), 16, "0")
    return F.concat(*[F.substring(wide, k, 2) for k in (15, 13, 11, 9)])


def signal_digest(leads: Column | str) -> Column:
    """SHA-256 of the steps of all leads as little-endian 32-bit integers, lead after lead."""
    parts = F.transform(F.flatten(F.transform(_col(leads), steps)), _little_endian)
    return F.sha2(F.unhex(F.array_join(parts, "")), 256)


def n_nonfinite(samples: Column | str) -> Column:
    return F.size(F.filter(_col(samples), lambda x: ~finite(x))).cast("long")


def is_flat(samples: Column | str) -> Column:
    """No finite sample, or all finite samples equal."""
    good = F.filter(_col(samples), finite)
    return (F.size(good) == 0) | (F.array_min(good) == F.array_max(good))


def is_saturated(samples: Column | str) -> Column:
    """Not flat, and one percent of the finite samples or more at either extreme."""
    good = F.filter(_col(samples), finite)
    low, high = F.array_min(good), F.array_max(good)
    at = F.size(F.filter(good, lambda x: (x == low) | (x == high)))
    return ~is_flat(samples) & (at >= F.lit(SATURATED_SHARE) * F.size(good))


def common_prefix(x: Column | str, y: Column | str) -> tuple[Column, Column]:
    n = F.least(F.size(_col(x)), F.size(_col(y)))
    return F.slice(_col(x), 1, n), F.slice(_col(y), 1, n)


def _mean(x: Column) -> Column:
    return F.try_divide(F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double")), F.size(x).cast("double"))


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson's r of the common prefix, centred first; null for fewer than two samples or a constant side."""
    a, b = common_prefix(x, y)
    with_means = lambda w: F.struct(w["a"].alias("a"), w["b"].alias("b"), _mean(w["a"]).alias("ma"), _mean(w["b"]).alias("mb"))
    # a lambda over a one-element array evaluates what it binds once, not once per sample
    bound = F.transform(F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))), with_means), _pearson)
    return F.when(F.size(a) >= 2, bound[0])


def _pearson(w: Column) -> Column:
    both = F.zip_with(w["a"], w["b"], lambda p, q: F.struct((p.cast("double") - w["ma"]).alias("p"), (q.cast("double") - w["mb"]).alias("q")))
    zero = F.struct(F.lit(0.0).alias("pq"), F.lit(0.0).alias("pp"), F.lit(0.0).alias("qq"))
    add = lambda s, v: F.struct((s["pq"] + v["p"] * v["q"]).alias("pq"), (s["pp"] + v["p"] * v["p"]).alias("pp"), (s["qq"] + v["q"] * v["q"]).alias("qq"))
    return F.aggregate(both, zero, add, lambda s: F.nullif(F.try_divide(s["pq"], F.sqrt(s["pp"]) * F.sqrt(s["qq"])), F.lit(float("nan"))))


def largest_difference(x: Column | str, y: Column | str) -> Column:
    """Largest |x - y| over samples that are finite on both sides; null if there is none."""
    d = F.zip_with(_col(x), _col(y), lambda p, q: F.when(finite(p) & finite(q), F.abs(p - q)))
    return F.array_max(F.filter(d, lambda v: v.isNotNull()))


def same_samples(x: Column | str, y: Column | str) -> Column:
    """Same shape, and equal wherever both sides are finite."""
    return (F.size(_col(x)) == F.size(_col(y))) & (F.coalesce(largest_difference(x, y), F.lit(0.0)) == 0)
