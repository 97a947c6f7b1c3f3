"""As-of reads over vintages of orders."""

from __future__ import annotations

from datetime import datetime, timezone
import uuid

from pyspark.sql import functions as F

from tidemark.operators.asof import collapse, known_by, latest_per, latest_vintage
from tidemark.plans.bindings import VINTAGES, VKEY, table, vintages
from tidemark.plans.registry import query
from tidemark.session import shared_folder
from tidemark.sources.files import tsv
from tidemark.sources.registry import natural_key, register
from tidemark.sources.warehouse import list_datasets, read_only_sql, read_table, register_views, registered, stamp, union_vintages, VINTAGE, write_table

AS_OF = "1998-06-30"
COLLAPSED = f"""WITH {VINTAGES}, pit AS (SELECT * FROM vin WHERE knowledge_date <= DATE '{AS_OF}'
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY knowledge_date DESC, _vintage_id DESC) = 1)"""


@query("asof_collapse", COLLAPSED + " SELECT o_custkey, o_orderpriority, knowledge_date, value FROM pit")
def asof_collapse(spark, sf):
    return collapse(vintages(spark, sf), VKEY, AS_OF, columns=["o_custkey", "o_orderpriority", "knowledge_date", "value"])


@query("asof_collapse_everything", f"""WITH {VINTAGES} SELECT o_custkey, o_orderpriority, knowledge_date, value FROM vin
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY knowledge_date DESC, _vintage_id DESC) = 1""")
def asof_collapse_everything(spark, sf):
    return collapse(vintages(spark, sf), VKEY, columns=["o_custkey", "o_orderpriority", "knowledge_date", "value"])


@query("asof_where_after_collapse", COLLAPSED + """ SELECT o_custkey, o_orderpriority, value FROM pit
  WHERE o_orderstatus = 'F' ORDER BY value DESC, o_custkey LIMIT 200""")
def asof_where_after_collapse(spark, sf):
    return collapse(vintages(spark, sf), VKEY, AS_OF, where="o_orderstatus = 'F'",
                    order_by=[F.desc("value"), "o_custkey"], limit=200, columns=["o_custkey", "o_orderpriority", "value"])


@query("asof_latest_per", COLLAPSED + """ SELECT o_custkey, o_orderpriority, knowledge_date, value FROM pit
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC, knowledge_date DESC, _vintage_id DESC) = 1""")
def asof_latest_per(spark, sf):
    return latest_per(vintages(spark, sf), VKEY, ["o_custkey"], AS_OF,
                      columns=["o_custkey", "o_orderpriority", "knowledge_date", "value"])


@query("asof_latest_vintage", """WITH v AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS knowledge_date, l_linenumber AS _vintage_id,
    l_partkey, l_quantity FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '1998-06-30')
  SELECT l_suppkey, knowledge_date, l_partkey, l_quantity FROM v
  QUALIFY dense_rank() OVER (PARTITION BY l_suppkey ORDER BY knowledge_date DESC, _vintage_id DESC) = 1""")
def asof_latest_vintage(spark, sf):
    v = table(spark, sf, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("knowledge_date"),
                                            F.col("l_linenumber").alias("_vintage_id"), "l_partkey", "l_quantity")
    return latest_vintage(v, ["l_suppkey"], AS_OF, columns=["l_suppkey", "knowledge_date", "l_partkey", "l_quantity"])


@query("asof_known_counts", f"""WITH {VINTAGES} SELECT o_orderpriority, count(*) AS n_known, max(knowledge_date) AS newest
  FROM vin WHERE knowledge_date <= DATE '{AS_OF}' GROUP BY 1""")
def asof_known_counts(spark, sf):
    return known_by(vintages(spark, sf), AS_OF).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_known"), F.max("knowledge_date").alias("newest"))


@query("union_vintages_by_name", """SELECT 'a' AS run, count(*) AS n, count(o_orderstatus) AS n_status, count(o_totalprice) AS n_price FROM orders
  UNION ALL SELECT 'b', count(*), 0, count(o_totalprice) FROM orders""")
def union_vintages_by_name(spark, sf):
    o = table(spark, sf, "orders")
    a = stamp(o.select("o_orderkey", "o_orderstatus", "o_totalprice")).withColumn("run", F.lit("a"))
    b = stamp(o.select("o_totalprice", "o_orderkey")).withColumn("run", F.lit("b"))
    return union_vintages(a, b).where(F.col(VINTAGE).isNotNull()).groupBy("run").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderstatus").alias("n_status"), F.count("o_totalprice").alias("n_price"))


@query("ad_hoc_sql", """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def ad_hoc_sql(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("tidemark_orders")
    return read_only_sql(spark, "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total "
                                "FROM tidemark_orders GROUP BY o_orderpriority")


# -- written and read again -----------------------------------------------------------

def two_vintages(spark, sf):
    """Customers written twice to a new warehouse in the shared folder: all of them, then the richer ones with a raised balance."""
    root = f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    at = lambda day: datetime(2024, 1, day, tzinfo=timezone.utc)
    write_table(c, root, "bank", "accounts", at(1))
    write_table(c.where("balance > 5000").withColumn("balance", F.col("balance") + 1), root, "bank", "accounts", at(8))
    return root


WRITTEN = """w AS (SELECT c_custkey, c_mktsegment AS segment, c_acctbal AS balance, DATE '2024-01-01' AS k FROM customer
  UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal + 1, DATE '2024-01-08' FROM customer WHERE c_acctbal > 5000)"""


@query("written_vintages_as_of", f"""WITH {WRITTEN} SELECT 'before' AS read, c_custkey, round(balance, 2) AS balance FROM w WHERE k = DATE '2024-01-01'
  UNION ALL SELECT 'after', c_custkey, round(balance, 2) FROM w QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY k DESC) = 1""")
def written_vintages_as_of(spark, sf):
    register("bank_accounts", ["c_custkey"])
    t = read_table(spark, two_vintages(spark, sf), "bank", "accounts")
    read = lambda name, day: collapse(t, natural_key("bank_accounts"), day, columns=["c_custkey", "balance"]).select(
        F.lit(name).alias("read"), "c_custkey", F.round("balance", 2).alias("balance"))
    return read("before", "2024-01-05").unionByName(read("after", None))


@query("registered_views", f"""WITH {WRITTEN} SELECT 'bank_accounts' AS "view", 'bank/accounts' AS dataset, true AS point_in_time, 'c_custkey' AS natural_key,
  count(*) AS rows, count(DISTINCT k) AS vintages FROM w""")
def registered_views(spark, sf):
    register("bank_accounts", ["c_custkey"])
    root = two_vintages(spark, sf)
    found = spark.createDataFrame([(f"{s}_{d}", f"{s}/{d}") for s, d in list_datasets(spark, root)], "view string, dataset string")
    counts = None
    for name in register_views(spark, root):
        one = spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(VINTAGE).alias("vintages")).withColumn("view", F.lit(name))
        counts = one if counts is None else counts.unionByName(one)
    return found.join(registered(spark), "view").join(counts, "view")


@query("bulk_tsv_members", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS nation FROM supplier")
def bulk_tsv_members(spark, sf):
    path = f"{shared_folder(spark)}/bulk-{uuid.uuid4().hex}"
    table(spark, sf, "supplier").select("s_suppkey", "s_name", F.lpad(F.col("s_nationkey").cast("string"), 4, "0").alias("nation")).write.csv(path, sep="\t", header=True)
    return tsv(spark, path)
