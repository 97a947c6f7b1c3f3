"""Reads of a vintage table as it was known on a date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.sources.warehouse import KNOWN, VINTAGE


def known_by(df: DataFrame, as_of: str | date | None, known: str = KNOWN) -> DataFrame:
    """Rows already known on ``as_of``. The bound reaches the scan, as a partition
    filter when the table is partitioned by knowledge date."""
    bound = as_date(as_of)
    return df if bound is None else df.where(F.col(known) <= F.lit(bound))


def collapse(df: DataFrame, key: Sequence[str], as_of: str | date | None = None, *,
             columns: Sequence[str | Column] | None = None, where: str | Column | None = None,
             order_by: Sequence[str | Column] | None = None, limit: int | None = None,
             known: str = KNOWN, order: Sequence[str] = (VINTAGE,)) -> DataFrame:
    """One row per natural key: the last one written of those known on ``as_of``.

    ``where`` filters the surviving rows, so a predicate on a value cannot resurrect an
    older vintage. (A predicate on key columns alone is still moved to the scan by the
    optimiser.) Spark keeps only the best row per key in each map task before the
    shuffle, so a key with very many vintages does not travel whole.
    """
    if not key:
        raise ValueError("collapse needs a natural key")
    w = Window.partitionBy(*key).orderBy(F.desc(known), *[F.desc(c) for c in order])
    out = known_by(df, as_of, known).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return _finish(out, columns, where, order_by, limit)


def latest_per(df: DataFrame, key: Sequence[str], per: Sequence[str], as_of: str | date | None = None, *,
               columns: Sequence[str | Column] | None = None, where: str | Column | None = None,
               order_by: Sequence[str | Column] | None = None,
               known: str = KNOWN, order: Sequence[str] = (VINTAGE,)) -> DataFrame:
    """Newest observation per coarser group than the natural key.

    Observations are ranked on the rest of the key, newest first, and only then on
    knowledge date: a backfill of an old observation written today does not displace a
    newer observation written yesterday.
    """
    extra = [p for p in per if p not in key]
    if extra:
        raise ValueError(f"grouping columns {extra} are not part of the natural key {list(key)}")
    rest = [k for k in key if k not in per]
    rows = collapse(df, key, as_of, where=where, known=known, order=order)
    if rest:
        w = Window.partitionBy(*per).orderBy(*[F.desc(c) for c in rest], F.desc(known), *[F.desc(c) for c in order])
        rows = rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return _finish(rows, columns, None, order_by, None)


def latest_vintage(df: DataFrame, per: Sequence[str], as_of: str | date | None = None, *,
                   columns: Sequence[str | Column] | None = None, where: str | Column | None = None,
                   known: str = KNOWN, order: Sequence[str] = (VINTAGE,)) -> DataFrame:
    """Every row of the newest vintage of each document, for facts without a key.

    The newest vintage per document is a small partial aggregate that is joined back, so
    one very large document is split by the join instead of filling one window task.
    """
    seen = known_by(df, as_of, known)
    rank = F.struct(F.col(known), *[F.col(c) for c in order])
    newest = seen.groupBy(*per).agg(F.max(rank).alias("_newest"))
    newest = newest.select(*per, F.col(f"_newest.{known}").alias("_k"),
                           *[F.col(f"_newest.{c}").alias(f"_o{i}") for i, c in enumerate(order)])
    left = seen.alias("s")
    cond = [F.col(f"s.{p}").eqNullSafe(F.col(f"n.{p}")) for p in per]
    cond += [F.col(f"s.{known}") == F.col("n._k")]
    cond += [F.col(f"s.{c}") == F.col(f"n._o{i}") for i, c in enumerate(order)]
    rows = left.join(newest.alias("n"), cond, "left_semi")
    return _finish(rows, columns, where, None, None)


def tail_by_date(df: DataFrame, date_col: str, n: int) -> DataFrame:
    """Rows on the last ``n`` distinct dates of the whole panel."""
    dates = df.select(date_col).distinct().orderBy(F.desc(date_col)).limit(n)
    first = dates.agg(F.min(date_col).alias("d")).scalar()
    return df.where(F.col(date_col) >= first)


def tail_per(df: DataFrame, group: Sequence[str], order_by: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows of each group."""
    w = Window.partitionBy(*group).orderBy(*[F.desc(c) for c in order_by])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def _finish(df, columns, where, order_by, limit):
    if where is not None:
        df = df.where(where)
    if order_by:
        df = df.orderBy(*order_by)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*columns) if columns else df
