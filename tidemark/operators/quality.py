"""Freshness, volume and silent revisions of the vintage tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.registry import METADATA_COLUMNS

STATUS_ORDER = ("STALE", "COLLAPSED", "REVISED", "OK")     # most urgent first
STALE_AFTER_HOURS = 48.0


def _now(now: datetime | Column | None) -> Column:
    if isinstance(now, Column):
        return now
    return F.lit((now or datetime.now(timezone.utc)).replace(tzinfo=None)).cast("timestamp_ntz")


def fetch_freshness(manifest: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Newest fetch, age in hours, files and megabytes per (source, dataset).

    ``manifest``: source, dataset, fetched_at_utc (timestamp), bytes.
    """
    g = manifest.groupBy("source", "dataset").agg(F.max("fetched_at_utc").alias("last_fetch_utc"), F.count(F.lit(1)).alias("raw_files"),
                                                  F.sum(F.coalesce("bytes", F.lit(0))).alias("_bytes"))
    age = F.timestamp_diff("SECOND", F.col("last_fetch_utc"), _now(now)) / 3600.0
    return g.select("source", "dataset", "last_fetch_utc", F.bround(age, 1).alias("age_hours"), "raw_files", F.bround(F.col("_bytes") / 1e6, 1).alias("raw_mb"))


def volume_trend(vintages: DataFrame, vintage: str = "_vintage_id", per: Sequence[str] = ()) -> DataFrame:
    """Rows per vintage in write order, the change, and whether it fell by more than half.

    Only the vintage column is read; the window runs over one row per vintage.
    """
    counts = vintages.groupBy(*per, vintage).agg(F.count(F.lit(1)).alias("rows"))
    prev = F.lag("rows").over(Window.partitionBy(*(per or [F.lit(0)])).orderBy(vintage))
    return counts.select(*per, F.col(vintage).alias("vintage"), "rows", (F.col("rows") - prev).alias("row_change"),
                         F.coalesce(F.col("rows") < prev * 0.5, F.lit(False)).alias("collapsed"))


def detect_revisions(vintages: DataFrame, key: Sequence[str], values: Sequence[str] | None = None, vintage: Sequence[str] = ("_vintage_id",)) -> DataFrame:
    """Keys whose recorded values changed between vintages, also where the last one is the first one again.

    One group by over the key with the per-column range and the first and last values by vintage, so there is
    no row cap. A field that went back shows the same value before and after. NULL is a value of its own: going missing is a revision, and NULL is not the
    empty string. Columns describing the fetch are left out.
    """
    values = list(values) if values is not None else [c for c in vintages.columns if c not in {*key, *METADATA_COLUMNS, *vintage}]
    missing = [k for k in key if k not in vintages.columns]
    if missing:
        raise KeyError(f"declared key column(s) {missing} are not in the data")
    text = lambda c: F.when(F.col(c).isNull(), F.lit("\x00NULL")).otherwise(F.concat(F.lit("="), F.col(c).cast("string")))
    at = F.struct(*vintage)
    rows = vintages.select(*key, at.alias("_at"), F.struct(*[text(c).alias(c) for c in values]).alias("_v"))
    g = rows.groupBy(*key).agg(F.min(F.struct("_at", "_v")).alias("lo"), F.max(F.struct("_at", "_v")).alias("hi"),
                             *[(F.min(f"_v.{c}") != F.max(f"_v.{c}")).alias(f"_d{i}") for i, c in enumerate(sorted(values))])
    show = lambda side, c: F.when(F.col(f"{side}._v.{c}") == "\x00NULL", "(missing)").otherwise(F.substring(F.col(f"{side}._v.{c}"), 2, 1 << 30))
    moved = F.array_compact(F.array(*[
        F.when(F.col(f"_d{i}"), F.struct(F.lit(c).alias("field"), show("lo", c).alias("before"), show("hi", c).alias("after")))
        for i, c in enumerate(sorted(values))]))
    g = g.withColumn("_m", moved).where(F.size("_m") > 0)
    stamp = lambda side: F.array_join(F.array(*[F.col(f"{side}._at.{v}").cast("string") for v in vintage]), "/")
    return g.select(*key, F.array_join(F.transform("_m", lambda m: m["field"]), ", ").alias("fields_changed"), F.size("_m").alias("n_fields"),
                    stamp("lo").alias("first_vintage"), stamp("hi").alias("latest_vintage"), F.col("_m")[0]["field"].alias("example_field"),
                    F.col("_m")[0]["before"].alias("example_before"), F.col("_m")[0]["after"].alias("example_after"))


def quality_report(volumes: DataFrame, revisions: DataFrame, freshness: DataFrame, keys: DataFrame | None = None,
                   stale_after_hours: float = STALE_AFTER_HOURS) -> DataFrame:
    """One row per view with the most urgent finding.

    ``volumes``: view and the columns of ``volume_trend``; ``revisions``: view, n_revised;
    ``freshness``: ``fetch_freshness``. Freshness falls back from the dataset to its source.
    """
    v = volumes.groupBy("view").agg(F.max(F.struct("vintage", "rows", "row_change", "collapsed")).alias("l"), F.count(F.lit(1)).alias("vintages"))
    own = freshness.select(F.replace(F.concat_ws("_", "source", "dataset"), F.lit("-"), F.lit("_")).alias("view"), F.struct("last_fetch_utc", "age_hours").alias("_own"))
    src = freshness.groupBy(F.col("source").alias("_source")).agg(F.max(F.struct("last_fetch_utc", "age_hours")).alias("_src"))
    df = v.join(revisions, "view", "left").join(own, "view", "left").withColumn("_source", F.substring_index("view", "_", 1)).join(src, "_source", "left")
    f = F.coalesce("_own", "_src")
    n = F.coalesce("n_revised", F.lit(0))
    status = F.when(f["age_hours"] > stale_after_hours, "STALE").when(F.col("l.collapsed"), "COLLAPSED").when((n > 0) & (F.col("vintages") > 1), "REVISED").otherwise("OK")
    out = df.select("view", status.alias("status"), F.col("l.rows").alias("rows_latest"), "vintages", F.col("l.row_change").alias("row_change"),
                    F.when(F.col("vintages") < 2, "n/a").otherwise(n.cast("string")).alias("revisions"), f["last_fetch_utc"].alias("last_fetch_utc"),
                    f["age_hours"].alias("age_hours"),
                    F.when(F.col("_own").isNotNull(), "dataset").when(F.col("_src").isNotNull(), "source").otherwise("none").alias("freshness_basis"))
    if keys is not None:
        out = out.join(keys.select("view", F.col("natural_key").alias("_nk")), "view", "left").withColumn(
            "revision_key", F.coalesce("_nk", F.lit("(not declared)"))).drop("_nk")
    return out


def status_rank(status: str = "status") -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col(status))


def status_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def flagged_of_total(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.count_if(F.col(flag)).alias("flagged"), F.count(F.lit(1)).alias("total"))


def materialise_report(report: DataFrame, path: str, now: datetime | None = None) -> None:
    """Store the report with the time it was computed; readers take the age from it."""
    report.withColumn("computed_at", _now(now)).withColumn("error", F.lit(None).cast("string")).write.mode("append").parquet(path)


def read_report(stored: DataFrame, ttl_seconds: float = 600.0, now: datetime | Column | None = None) -> DataFrame:
    """The newest stored report, how old it is and whether it has outlived its time."""
    newest = stored.agg(F.max("computed_at").alias("m")).scalar()
    age = F.timestamp_diff("SECOND", F.col("computed_at"), _now(now)).cast("double")
    return stored.where(F.col("computed_at") == newest).withColumn("age_seconds", age).withColumn("stale", age > ttl_seconds)
