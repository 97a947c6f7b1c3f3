"""Append-only vintages on parquet.

A dataset is a directory ``<root>/<source>/<dataset>`` partitioned by knowledge_date.
Each write appends one vintage and stamps every row with the date it became known and
a ``_vintage_id`` that sorts in write order. Part-file names carry no order, so the id
is a column; the partition column lets an as-of read skip the vintages it may not see.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.registry import DATASET_KEYS

KNOWN, VINTAGE = "knowledge_date", "_vintage_id"


def view_name(source: str, dataset: str) -> str:
    return f"{source}_{dataset}".replace("-", "_")


def stamp(df: DataFrame, now: datetime | None = None) -> DataFrame:
    """``df`` with the two vintage columns; the input is not changed."""
    now = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return df.withColumn(KNOWN, F.lit(now.date())).withColumn(VINTAGE, F.lit(now.strftime("%Y%m%dT%H%M%S_%f")))


def write_table(df: DataFrame, root: str, source: str, dataset: str, now: datetime | None = None) -> str:
    """Append ``df`` as one vintage and return the dataset path."""
    path = f"{root.rstrip('/')}/{source}/{dataset}"
    stamp(df, now).write.mode("append").partitionBy(KNOWN).parquet(path)
    return path


def read_table(spark: SparkSession, root: str, source: str, dataset: str,
               schema: T.StructType | None = None) -> DataFrame:
    """All vintages, matched by column name; a column a vintage lacks reads as NULL.

    With a declared schema no file footers are merged, which is what a table with many
    files wants. Without one the footers are merged by Spark.
    """
    path = f"{root.rstrip('/')}/{source}/{dataset}"
    reader = spark.read
    if schema is not None:
        names = set(schema.fieldNames())
        fields = list(schema.fields)
        if VINTAGE not in names:
            fields.append(T.StructField(VINTAGE, T.StringType()))
        if KNOWN not in names:
            fields.append(T.StructField(KNOWN, T.DateType()))
        return reader.schema(T.StructType(fields)).parquet(path)
    return reader.option("mergeSchema", "true").parquet(path)


def union_vintages(*frames: DataFrame) -> DataFrame:
    """Vintages that are separate frames, matched by name."""
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first


def list_datasets(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(source, dataset) of every directory under ``root`` that holds data."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for s in fs.listStatus(path):
        if not s.isDirectory():
            continue
        for d in fs.listStatus(s.getPath()):
            if d.isDirectory() and any(
                not c.getPath().getName().startswith(("_", ".")) for c in fs.listStatus(d.getPath())
            ):
                found.append((s.getPath().getName(), d.getPath().getName()))
    return sorted(found)


def register_views(spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None) -> list[str]:
    """One temporary view per dataset that holds data. Call again after a write."""
    names = []
    for source, dataset in list_datasets(spark, root):
        name = view_name(source, dataset)
        read_table(spark, root, source, dataset, (schemas or {}).get(name)).createOrReplaceTempView(name)
        names.append(name)
    return names


def registered(spark: SparkSession) -> DataFrame:
    """Views that can be queried now, and which of them can be read point in time."""
    keys = spark.createDataFrame(
        [(v, ", ".join(k)) for v, k in sorted(DATASET_KEYS.items())], "view string, natural_key string"
    )
    names = spark.createDataFrame([(t.name,) for t in spark.catalog.listTables()] or [("",)], "view string")
    return (
        names.where("view <> ''")
        .join(keys, "view", "left")
        .select("view", F.col("natural_key").isNotNull().alias("point_in_time"), "natural_key")
    )


#: Parsed nodes that do something else than answer a query, and commands among them that only report.
_ACTIONS = ("org.apache.spark.sql.catalyst.plans.logical.Command", "org.apache.spark.sql.catalyst.plans.logical.ParsedStatement")
_REPORTS = ("Show", "Describe", "Explain")
_SCRIPTS = ("ScriptTransformation", "UnresolvedScriptTransformation")


def actions_of(spark: SparkSession, query: str) -> list[str]:
    """Kinds of the parsed plan's nodes that change something or run a program; nothing is executed."""
    loader = spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()
    kinds = [spark._jvm.java.lang.Class.forName(name, False, loader) for name in _ACTIONS]
    todo, found = [spark._jsparkSession.sessionState().sqlParser().parsePlan(query)], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        action = any(kind.isInstance(node) for kind in kinds) and not name.startswith(_REPORTS)
        if action or name in _SCRIPTS:
            found.append(name)
        below = node.children()
        todo += [below.apply(k) for k in range(below.size())]
        if name == "UnresolvedWith":
            named = node.cteRelations()
            todo += [named.apply(k)._2() for k in range(named.size())]
    return found


def read_only_sql(spark: SparkSession, query: str, limit: int | None = None) -> DataFrame:
    """Ad-hoc query over the registered views; a caller may ask for at most ``limit`` rows. What is refused is decided by the parsed plan."""
    found = actions_of(spark, query)
    if found:
        raise ValueError(f"this is read-only; use SELECT, not {', '.join(found)}")
    out = spark.sql(query)
    return out if limit is None else out.limit(limit)
