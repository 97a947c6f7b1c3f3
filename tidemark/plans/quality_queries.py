"""Data quality and lineage over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import lineage as ln
from tidemark.operators import quality as ql
from tidemark.plans.bindings import VINTAGES, VKEY, events, table, vintages
from tidemark.plans.registry import query
from tidemark.session import shared_folder

def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def manifest(spark, sf):
    e = events(spark, sf)
    return e.select(F.col("event_type").alias("source"), F.concat(F.lit("set-"), (F.col("user_id") % 7).cast("string")).alias("dataset"),
                    F.col("ts").alias("fetched_at_utc"), F.floor(F.col("value") * 1000).cast("bigint").alias("bytes"),
                    F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("path"), F.sha2(F.col("props"), 256).alias("sha256"))


FRESH = """fr AS (SELECT event_type AS source, 'set-' || (user_id % 7) AS dataset, max(ts) AS last_fetch_utc,
  round_even(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01') / 3600.0::DOUBLE, 1) AS age_hours,
  count(*) AS raw_files, round_even(sum(CAST(floor(value * 1000) AS BIGINT)) / 1000000.0::DOUBLE, 1) AS raw_mb FROM events GROUP BY 1, 2)"""


@query("fetch_freshness", f"WITH {FRESH} SELECT source, dataset, last_fetch_utc, age_hours, raw_files, raw_mb FROM fr")
def fetch_freshness(spark, sf):
    return ql.fetch_freshness(manifest(spark, sf), now())


def monthly_vintages(spark, sf):
    v = vintages(spark, sf)
    month = F.date_format("knowledge_date", "yyyyMM")
    # the later months keep a third of their rows, the rest arrived with the run before: every row counts
    return v.withColumn("view", F.concat(F.lit("orders_"), F.lower(F.substring("o_orderpriority", 3, 20)))) \
        .withColumn("run", F.when((month < "200106") | (F.col("_vintage_id") % 3 == 0), month).otherwise("200105"))


MONTHLY = f"""{VINTAGES}, mv AS (SELECT *, 'orders_' || lower(substr(o_orderpriority, 3, 20)) AS "view", CASE WHEN strftime(knowledge_date, '%Y%m') < '200106' OR _vintage_id % 3 = 0 THEN strftime(knowledge_date, '%Y%m') ELSE '200105' END AS run FROM vin),
  vt AS (SELECT "view", run AS vintage, count(*) AS rows FROM mv GROUP BY 1, 2),
  vl AS (SELECT *, rows - lag(rows) OVER w AS row_change, coalesce(rows < lag(rows) OVER w * 0.5, false) AS collapsed FROM vt WINDOW w AS (PARTITION BY "view" ORDER BY vintage))"""


@query("volume_trend", f"WITH {MONTHLY} SELECT * FROM vl")
def volume_trend(spark, sf):
    return ql.volume_trend(monthly_vintages(spark, sf), "run", ["view"])


REVISED = f"""{VINTAGES}, rv AS (SELECT o_custkey, o_orderpriority, arg_min(value, (knowledge_date, _vintage_id)) AS v0, arg_max(value, (knowledge_date, _vintage_id)) AS v1,
    arg_min(o_orderstatus, (knowledge_date, _vintage_id)) AS s0, arg_max(o_orderstatus, (knowledge_date, _vintage_id)) AS s1,
    min(value) <> max(value) AS vm, min(o_orderstatus) <> max(o_orderstatus) AS sm, min((knowledge_date, _vintage_id)) AS a, max((knowledge_date, _vintage_id)) AS b FROM vin GROUP BY 1, 2)"""


@query("detect_revisions", f"""WITH {REVISED} SELECT o_custkey, o_orderpriority, CASE WHEN vm AND sm THEN 'o_orderstatus, value' WHEN vm THEN 'value' ELSE 'o_orderstatus' END AS fields_changed,
  CAST(vm::INTEGER + sm::INTEGER AS INTEGER) AS n_fields, a[1] || '/' || a[2] AS first_vintage, b[1] || '/' || b[2] AS latest_vintage,
  CASE WHEN sm THEN 'o_orderstatus' ELSE 'value' END AS example_field,
  CASE WHEN sm THEN s0 <> s1 ELSE v0 <> v1 END AS stands FROM rv WHERE vm OR sm""")
def detect_revisions(spark, sf):
    return ql.detect_revisions(vintages(spark, sf), VKEY, ["value", "o_orderstatus"], ("knowledge_date", "_vintage_id")) \
        .withColumn("stands", F.col("example_before") != F.col("example_after")).drop("example_before", "example_after")


def report(spark, sf):
    mv = monthly_vintages(spark, sf)
    revs = ql.detect_revisions(mv, ["view", "o_custkey"], ["o_orderstatus"], ("knowledge_date", "_vintage_id")).groupBy("view").agg(F.count(F.lit(1)).alias("n_revised"))
    fresh = ql.fetch_freshness(table(spark, sf, "orders").select(
        F.regexp_replace(F.concat(F.lit("orders"), "o_orderstatus"), "[A-Z]$", "").alias("source"), F.replace(F.lower(F.substring("o_orderpriority", 3, 20)), F.lit("low"), F.lit("unlisted")).alias("dataset"), F.col("o_orderdate").alias("fetched_at_utc"), F.lit(10).alias("bytes")),
        F.lit("2001-08-02 12:00:00").cast("timestamp_ntz"))
    keys = spark.createDataFrame([("orders_urgent", "o_custkey")], "view string, natural_key string")
    return ql.quality_report(ql.volume_trend(mv, "run", ["view"]), revs, fresh, keys)


REPORT = f"""{MONTHLY}, rvk AS (SELECT "view", o_custkey, min(o_orderstatus) AS a, max(o_orderstatus) AS b FROM mv GROUP BY 1, 2),
  rvn AS (SELECT "view", count(*) AS n FROM rvk WHERE a <> b GROUP BY 1),
  fo AS (SELECT 'orders_' || replace(lower(substr(o_orderpriority, 3, 20)), 'low', 'unlisted') AS "view", max(o_orderdate) AS l FROM orders GROUP BY 1),
  la AS (SELECT "view", arg_max(rows, vintage) AS rows_latest, count(*) AS vintages, arg_max(row_change, vintage) AS row_change, arg_max(collapsed, vintage) AS collapsed FROM vl GROUP BY 1),
  q AS (SELECT la.*, coalesce(n, 0) AS n, coalesce(fo.l, (SELECT max(l) FROM fo)) AS last_fetch_utc, CASE WHEN fo.l IS NULL THEN 'source' ELSE 'dataset' END AS freshness_basis
    FROM la LEFT JOIN rvn USING ("view") LEFT JOIN fo USING ("view")),
  rep AS (SELECT "view", CASE WHEN date_diff('second', last_fetch_utc, TIMESTAMP '2001-08-02 12:00:00') / 3600.0 > 48 THEN 'STALE' WHEN collapsed THEN 'COLLAPSED' WHEN n > 0 THEN 'REVISED' ELSE 'OK' END AS status,
    rows_latest, vintages, row_change, CAST(n AS VARCHAR) AS revisions, last_fetch_utc, round_even(date_diff('second', last_fetch_utc, TIMESTAMP '2001-08-02 12:00:00') / 3600.0::DOUBLE, 1) AS age_hours,
    freshness_basis, CASE "view" WHEN 'orders_urgent' THEN 'o_custkey' ELSE '(not declared)' END AS revision_key FROM q)"""


@query("quality_report", f"WITH {REPORT} SELECT * FROM rep")
def quality_report(spark, sf):
    return report(spark, sf)


@query("quality_status_counts", f"WITH {REPORT} SELECT status, count(*) AS n FROM rep GROUP BY 1")
def quality_status_counts(spark, sf):
    return ql.status_counts(report(spark, sf))


@query("quality_report_stored", f"""WITH {REPORT} SELECT "view", status, 900.0::DOUBLE AS age_seconds, true AS stale, CAST(NULL AS VARCHAR) AS error FROM rep""")
def quality_report_stored(spark, sf):
    """The report stored twice in the shared folder and read back: the newest one, and its age."""
    path = f"{shared_folder(spark)}/quality-{uuid.uuid4().hex}"
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    ql.materialise_report(report(spark, sf).where(F.col("view") != "orders_urgent"), path, at("2001-08-01 12:00:00"))
    ql.materialise_report(report(spark, sf), path, at("2001-08-02 12:00:00"))
    return ql.read_report(spark.read.parquet(path), 600.0, at("2001-08-02 12:15:00")).select("view", "status", "age_seconds", "stale", "error")


@query("flagged_of_total", f"WITH {MONTHLY} SELECT count(*) FILTER (collapsed) AS flagged, count(*) AS total FROM vl")
def flagged_of_total(spark, sf):
    return ql.flagged_of_total(ql.volume_trend(monthly_vintages(spark, sf), "run", ["view"]), "collapsed")


def part_name(key):
    return F.concat(F.when(key % 2 == 0, "derived_").otherwise("raw_"), key.cast("string"))


def newest_part(spark, sf):
    """The customer of the largest key, which the others are below."""
    return table(spark, sf, "customer").agg(F.max("c_custkey").alias("k")).select(part_name(F.col("k"))).first()[0]


def part_edges(spark, sf):
    """Each customer is computed from two smaller ones, so the graph has diamonds."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).where("k > 0")
    up = c.select("k", F.posexplode(F.array(F.floor(F.col("k") / 5), F.floor(F.col("k") / 7))).alias("ordinal", "u")).where("u < k")
    return up.select(part_name(F.col("k")).alias("view"), "ordinal", part_name(F.col("u")).alias("upstream"))


EDGES = """nm AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'derived_' ELSE 'raw_' END || c_custkey AS name FROM customer),
  ed AS (SELECT a.name AS "view", o.i AS ordinal, b.name AS upstream FROM nm a, (VALUES (0, 5), (1, 7)) o(i, d) JOIN nm b ON b.k = a.k // o.d WHERE a.k > 0 AND b.k < a.k),
  walk AS (SELECT arg_max(name, k) AS "view", 0 AS depth, '' AS visit FROM nm UNION ALL
    SELECT upstream, depth + 1, visit || lpad(CAST(ordinal AS VARCHAR), 4, '0') || '.' FROM walk JOIN ed ON ed."view" = walk."view"),
  rp AS (SELECT *, visit > min(visit) OVER (PARTITION BY "view") AS repeated FROM walk),
  tr AS (SELECT * FROM rp r WHERE NOT EXISTS (SELECT 1 FROM rp c WHERE c.repeated AND starts_with(r.visit, c.visit) AND length(r.visit) > length(c.visit)))"""


@query("lineage_trace", f"""WITH RECURSIVE {EDGES} SELECT "view", CAST(depth AS INTEGER) AS depth, visit, "view" LIKE 'derived%' AS computed, repeated, false AS truncated FROM tr""")
def lineage_trace(spark, sf):
    return ln.trace(part_edges(spark, sf), newest_part(spark, sf)).drop("path", "approximate")


@query("lineage_raw_files", f"""WITH RECURSIVE {EDGES} SELECT "view", 'orders/' || "view" AS raw_dataset, 'o' || o_orderkey AS path, CAST(o_totalprice AS BIGINT) AS bytes
  FROM tr JOIN orders ON "view" = CASE WHEN o_custkey % 2 = 0 THEN 'derived_' ELSE 'raw_' END || o_custkey WHERE NOT repeated""")
def lineage_raw_files(spark, sf):
    traced = ln.trace(part_edges(spark, sf), newest_part(spark, sf))
    o = table(spark, sf, "orders")
    view = part_name(F.col("o_custkey"))
    m = o.select(F.lit("orders").alias("source"), view.alias("dataset"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("path"),
                 F.round("o_totalprice").cast("bigint").alias("bytes"), F.col("o_orderdate").alias("fetched_at_utc"), F.lit("").alias("sha256"))
    links = o.select(view.alias("view"), F.concat(F.lit("orders/"), view).alias("raw_dataset")).distinct()
    return ln.raw_files_behind(traced, links, m).select("view", "raw_dataset", "path", "bytes")


@query("vintages_behind", f"""WITH {MONTHLY} SELECT run AS vintage, count(*) AS rows, 'orders' AS "view" FROM mv GROUP BY 1""")
def vintages_behind(spark, sf):
    return ln.vintages_of(monthly_vintages(spark, sf).drop("view"), "orders", "run")
