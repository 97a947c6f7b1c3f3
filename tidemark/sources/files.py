"""Reading landed files. Parsing functions elsewhere take what these return.

``lines``: (path, line), splittable. ``documents``: (path, content) with one row per file,
for formats whose unit is the file.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return binary_documents(spark, path).select("path", F.decode("content", "UTF-8").alias("content"))


def binary_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("binaryFile").load(paths).select("path", "content", "length")


def check_columns(found: Iterable[str], required: Iterable[str], dataset: str) -> None:
    """Raise when a column this parser depends on is gone; new columns are fine."""
    found = set(found)
    missing = sorted(set(required) - found)
    if missing:
        raise RuntimeError(f"{dataset}: schema drift, expected column(s) {missing} not found; got {sorted(found)}")


def header_of(source: DataFrame, sep: str = ",", skip: int = 0) -> list[str]:
    """Trimmed column names from the first line after ``skip`` banner lines of a text file."""
    rows = source.select("line").take(skip + 1)
    return [c.strip().strip('"') for c in rows[skip]["line"].split(sep)]


def csv_rows(source: DataFrame, header: Sequence[str], sep: str = ",", required: Sequence[str] = (), dataset: str = "csv") -> DataFrame:
    """Delimited lines as text columns under trimmed names.

    The header row repeats at the top of every file, and banners have another number of
    fields, so both are recognised by content and the files stay splittable.
    """
    names = [h.strip() for h in header]
    check_columns(names, required, dataset)
    ddl = ", ".join(f"`c{i}` string" for i in range(len(names)))
    pattern = "\\|" if sep == "|" else sep
    row = F.from_csv("line", ddl, {"sep": sep, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    keep = (F.size(F.split("line", pattern)) >= len(names)) & (F.trim(F.col("_r.c0")) != names[0])
    return source.withColumn("_r", row).where(keep).select("path", *[F.col(f"_r.c{i}").alias(n) for i, n in enumerate(names)])


def bannered_csv(source: DataFrame, header: Sequence[str], trade_date: str, sep: str = ",") -> DataFrame:
    """Delimited lines under a banner row, with the trading date of the file added."""
    return csv_rows(source, header, sep).withColumn("trade_date", F.lit(trade_date).cast("date"))


def tsv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headered tab-separated members of a bulk file, every column as text."""
    return spark.read.csv(path, sep="\t", header=True, inferSchema=False)


def json_records(docs: DataFrame, schema: str, at: str | None = None) -> DataFrame:
    """Rows of JSON documents that are an array, or hold one under the key ``at``."""
    ddl = f"array<struct<{schema}>>"
    if at is None:
        arr = F.from_json("content", ddl)
    else:
        arr = F.from_json("content", f"struct<`{at}`:{ddl}>")[at]
    return docs.select("path", F.explode(arr).alias("_r")).select("path", "_r.*")


def union_sources(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Frames of several categories, matched by name, with the category as a column."""
    out = None
    for name, df in frames.items():
        one = df.withColumn(tag, F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
