"""The raw archive as tables: sidecars, integrity, and what is still missing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIDECAR = "source string, dataset string, fetched_at_utc string, sha256 string, bytes bigint"
SUFFIX = ".meta.json"


def _sidecars(docs: DataFrame, extra: str) -> DataFrame:
    """(path, m, reason): the file each sidecar is of, what it says, and why it can't be used, if so."""
    ddl = SIDECAR + (f", {extra}" if extra else "") + ", _bad string"
    m = docs.select(F.regexp_replace("path", r"\.meta\.json$", "").alias("path"),
                    F.from_json("content", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("m"))
    reason = (F.when(F.col("m").isNull() | F.col("m._bad").isNotNull(), "not JSON").when(F.col("m.source").isNull(), "no source")
              .when(F.col("m.dataset").isNull(), "no dataset").when(F.col("m.sha256").isNull(), "no sha256")
              .when(F.try_to_timestamp("m.fetched_at_utc").isNull(), "no readable time"))
    return m.withColumn("reason", reason)


def manifest(docs: DataFrame, extra: str = "") -> DataFrame:
    """One row per archived file from the sidecar documents (path, content).

    ``extra`` is a schema fragment of further sidecar keys. A sidecar that is not JSON or names no source is left out; ``sidecar_rejects``
    has it, with the reason.
    """
    m = _sidecars(docs, extra).where("reason IS NULL OR reason NOT IN ('not JSON', 'no source')")
    return m.select("path", "m.*").drop("_bad").withColumn("fetched_at_utc", F.try_to_timestamp("fetched_at_utc"))


def sidecar_rejects(docs: DataFrame) -> DataFrame:
    """(path, reason) of every sidecar that can't be read, or lacks what identifies and checks its file."""
    return _sidecars(docs, "").where("reason IS NOT NULL").select("path", "reason")


def read_manifest(spark: SparkSession, root: str, extra: str = "") -> DataFrame:
    """Sidecars of every archived file under ``root``."""
    docs = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{SUFFIX}").text(root)
    return manifest(docs.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")), extra)


def latest_raw(m: DataFrame) -> DataFrame:
    """Newest archived file of each dataset."""
    return m.groupBy("source", "dataset").agg(F.max(F.struct("fetched_at_utc", "path")).alias("l")).select("source", "dataset", "l.path", "l.fetched_at_utc")


def find_raw(m: DataFrame, source: str, dataset: str, **match: object) -> DataFrame:
    """Newest file of a dataset whose sidecar carries the given values, or no row."""
    cond = (F.col("source") == source) & (F.col("dataset") == dataset)
    for k, v in match.items():
        cond = cond & (F.col(k).cast("string") == F.lit(str(v)))
    return m.where(cond).orderBy(F.desc("fetched_at_utc"), F.desc("path")).limit(1)


def integrity(files: DataFrame, m: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """Whether the bytes on disk are the bytes that arrived. ``files``: path, content (binary).

    With the ``sidecar_rejects``, a file whose sidecar is there but can't be used is told from one that has none.
    """
    actual = files.select("path", F.sha2("content", 256).alias("actual_sha256"), F.length("content").cast("bigint").alias("actual_bytes"))
    both = actual.join(m.select("path", "sha256", "bytes"), "path", "left")
    none = F.lit("no_sidecar")
    if rejects is not None:
        both = both.join(rejects.select("path", F.lit(True).alias("_rejected")).distinct(), "path", "left")
        none = F.when(F.col("_rejected"), "unreadable_sidecar").otherwise(none)
    return both.select(
        "path", "sha256", "actual_sha256", "bytes", "actual_bytes",
        F.when(F.col("sha256").isNull(), none).when(F.col("sha256") != F.col("actual_sha256"), "hash_mismatch")
        .when(F.col("bytes") != F.col("actual_bytes"), "length_mismatch").otherwise("ok").alias("state"))


def not_archived(found: DataFrame, archived: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose document has not been fetched yet."""
    return found.join(archived.select(*on).distinct(), list(on), "left_anti")


def missing_periods(available: DataFrame, have: DataFrame, on: str) -> DataFrame:
    return available.select(on).distinct().join(have.select(on).distinct(), on, "left_anti")


def day_range(first: str, last: str, landed: DataFrame, day: str = "date", status: Column | None = None) -> DataFrame:
    """Every calendar day between two dates with its state: ``landed`` if some row covers it, ``failed`` if only rows do that
    ``status`` is not true for, ``missing`` if none does; and how many rows there are."""
    ok = F.lit(True) if status is None else F.coalesce(status, F.lit(False))
    days = landed.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(day))
    seen = landed.groupBy(day).agg(F.count(F.lit(1)).alias("rows"), F.bool_or(ok).alias("_ok"))
    state = F.when(F.col("_ok"), "landed").when(F.col("rows") > 0, "failed").otherwise("missing")
    return days.join(seen, day, "left").select(day, state.alias("state"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def missing_days(first: str, last: str, landed: DataFrame, day: str = "date") -> DataFrame:
    """Calendar days between two dates that no landed row covers."""
    return day_range(first, last, landed, day).where("state = 'missing'").select(day)


def reparse(docs: DataFrame, parse: Callable[[DataFrame], DataFrame], index: DataFrame, accepted: Column | str,
            on: str = "accn") -> tuple[DataFrame, DataFrame]:
    """Parse a whole archive again with dates and forms from the index.

    Returns (parsed rows, rejected paths); a document that fails is reported, not raised.
    """
    parsed = parse(docs)
    ok = parsed.where(accepted).join(index, on, "left")
    rejected = docs.select("path").join(parsed.where(accepted).select("path").distinct(), "path", "left_anti")
    return ok, rejected.withColumn("reason", F.lit("not parseable"))
