"""Small column helpers used across operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(mapping: Mapping[str, object], key: str | Column) -> Column:
    """Value of a small constant mapping, NULL when the key is absent."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items())
    return F.try_element_at(F.create_map(*pairs), col(key))


def to_double(c: str | Column) -> Column:
    """Tolerant cast: text that is not a number becomes NULL, and so does NaN."""
    v = col(c).try_cast("double")
    return F.when(~F.isnan(v), v)


def digits_only(c: str | Column) -> Column:
    """Numeric value of text after everything but digits, dot and minus is removed."""
    return to_double(F.regexp_replace(col(c).cast("string"), r"[^0-9.\-]", ""))


def no_commas(c: str | Column) -> Column:
    return to_double(F.regexp_replace(col(c).cast("string"), ",", ""))


def parenthesised(c: str | Column) -> Column:
    """Numbers as statistical tables print them: commas, and (x) for -x."""
    cleaned = F.regexp_replace(F.regexp_replace(col(c).cast("string"), ",", ""), r"^\((.*)\)$", "-$1")
    return to_double(cleaned)


def blank_to_null(c: str | Column) -> Column:
    t = F.trim(col(c))
    return F.when(t != "", t)


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(a, b)


def clip(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def any_true(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def zscore_columns(df: DataFrame, value: str, out: str, sign: float = 1.0) -> DataFrame:
    """Cross-section z-score of ``value`` over all rows of ``df``.

    Mean and deviation come from one partially aggregated row read as a scalar
    subquery, so the rows themselves are not gathered into one partition the way a
    window without partition keys would. A flat cross-section scores 0; a single
    observation has no deviation and scores NULL.
    """
    stats = df.agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    mu, sd = stats.select("_mu").scalar(), stats.select("_sd").scalar()
    z = F.when(sd == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(value) - mu, sd) * F.lit(sign))
    return df.withColumn(out, F.when(F.col(value).isNotNull(), z))


def nth_value(rows: DataFrame, rank: int, low: float, high: float, buckets: int) -> tuple[float, int]:
    """The value of a rank (from 0) among the doubles ``v``, and how many are not larger; the rank must be less than the count.

    Counts per bucket of a range, with the smallest and largest value of each, find the bucket that holds the rank. Its values are the next range,
    until they are all equal. Only the counts, ``buckets`` at most, come to the driver; values are never ranked.
    """
    before, inside = 0, rows
    while True:
        at = F.floor((F.col("v") - low) / (high - low) * buckets) if high > low else F.lit(0)
        counts = inside.groupBy(F.greatest(F.least(at, F.lit(buckets - 1)), F.lit(0)).cast("int").alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("b").collect()
        for r in counts:
            if before + r.n > rank:
                break
            before += r.n
        low, high = r.low, r.high
        if low == high:
            return low, before + r.n
        inside = rows.where(F.col("v").between(low, high))


def exact_quantile(df: DataFrame, value: str, q: float, low: float, high: float, buckets: int = 10_000) -> Column:
    """Interpolated quantile of all values, usable in any other frame; null without values.

    ``low`` and ``high`` are the range that most values are expected in. Found by refining a histogram, so nothing with the size of the table meets
    in one task, however narrow the range is that holds the values.
    """
    rows = df.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    n = rows.count()
    if not n:
        return F.lit(None).cast("double")
    position = (n - 1) * q
    k = int(position)
    a, upto = nth_value(rows, k, low, high, buckets)
    following = a if upto > k + 1 or k + 1 >= n else rows.where(F.col("v") > a).agg(F.min("v")).first()[0]
    return F.lit(a + (following - a) * (position - k))


def require_rows(df: DataFrame, minimum: int, message: str) -> DataFrame:
    """Raise when ``df`` has fewer than ``minimum`` rows; reads no more than that many."""
    found = df.limit(minimum).count()
    if found < minimum:
        raise RuntimeError(f"{message} (found {found}, need {minimum})")
    return df
