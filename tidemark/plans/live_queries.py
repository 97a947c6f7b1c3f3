"""Streaming queries: events as a tick feed, run until everything available is read.

Each run writes to its own new folder under the shared folder of the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.plans.bindings import prices, table
from tidemark.plans.registry import query
from tidemark.session import shared_folder
from tidemark.streaming import ticks as tk


def feed(spark, sf):
    """The events table as a stream of JSON frames, one per event, every kind of feed."""
    schema = table(spark, sf, "events").schema
    e = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    key = F.concat(F.lit("NSE_EQ|I"), F.col("user_id").cast("string"))
    ltpc = F.struct(F.col("value").alias("ltp"), F.col("event_id").alias("ltq"))
    price, full = "struct<ltp:double,ltq:bigint>", "struct<marketFF:struct<ltpc:struct<ltp:double,ltq:bigint>,vtt:bigint,iv:double,tbq:bigint>,indexFF:struct<ltpc:struct<ltp:double,ltq:bigint>>>"
    depth = F.struct(ltpc.alias("ltpc"), F.col("event_id").alias("vtt"), (F.col("value") / 2).alias("iv"), F.col("user_id").alias("tbq"))
    nested = F.when(F.col("event_type") == "view", F.struct(depth.alias("marketFF"), F.lit(None).alias("indexFF")).cast(full)) \
        .when(F.col("event_type") == "click", F.struct(F.lit(None).alias("marketFF"), F.struct(ltpc.alias("ltpc")).alias("indexFF")).cast(full))
    union = F.struct(nested.alias("fullFeed"), F.when(nested.isNull(), ltpc).cast(price).alias("ltpc"))
    tick = F.to_json(F.struct(F.lit("live_feed").alias("type"), F.col("ts").cast("string").alias("ts"), F.create_map(key, union).alias("feeds")))
    info = F.to_json(F.struct(F.lit("market_info").alias("type"), F.col("ts").cast("string").alias("ts"), F.create_map(
        F.concat(F.lit("SEG"), (F.col("user_id") % 10).cast("string")), F.element_at(F.array(F.lit("NORMAL_OPEN"), F.lit("CLOSING_END"), F.lit("PRE_OPEN_START")), (F.col("event_id") % 3 + 1).cast("int"))).alias("segmentStatus")))
    return e.select(F.when(F.col("event_type") == "error", info).otherwise(tick).alias("value"))


def folder(spark):
    base = f"{shared_folder(spark)}/live-{uuid.uuid4().hex}"
    return f"{base}/out", f"{base}/state"


TICKS = "tk AS (SELECT 'NSE_EQ|I' || user_id AS instrument_key, value AS ltp, event_id AS ltq, CASE event_type WHEN 'view' THEN event_id END AS volume, ts FROM events WHERE event_type <> 'error')"


@query("live_cold_ticks", f"WITH {TICKS} SELECT instrument_key, ltp, ltq, volume, CASE WHEN volume IS NOT NULL THEN ltp / 2 END AS iv, CASE WHEN volume IS NOT NULL THEN CAST(substr(instrument_key, 9) AS DOUBLE) END AS total_buy_qty, ts, true AS stamped FROM tk")
def live_cold_ticks(spark, sf):
    out, state = folder(spark)
    tk.drain(lambda: tk.cold_sink(tk.decode(feed(spark, sf)), out, state, None))
    stamped = F.col("_vintage_id").isNotNull() & (F.col("_vintage_id") == F.col("batch")) & F.col("knowledge_date").isNotNull()
    return spark.read.parquet(out).select("instrument_key", "ltp", "ltq", "volume", "iv", "total_buy_qty", F.col("ts").cast("timestamp_ntz").alias("ts"), stamped.alias("stamped"))


@query("live_rejects", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'not a frame' WHEN 1 THEN 'no known feed' ELSE 'no readable time' END AS reason FROM events WHERE event_id % 4 < 3")
def live_rejects(spark, sf):
    k, text = F.col("event_id") % 4, F.col("event_id").cast("string")
    frame = lambda ts, inner: F.concat(F.lit('{"type": "live_feed", "n": '), text, F.lit(f', "ts": "{ts}", "feeds": {{"K": {inner}}}}}'))
    price = '{"ltpc": {"ltp": 1.5}}'
    raw = table(spark, sf, "events").select(F.when(k == 0, F.concat(F.lit("junk "), text)).when(k == 1, frame("2024-01-01 00:00:00", '{"other": 1}'))
                                            .when(k == 2, frame("yesterday", price)).otherwise(frame("1704067200", price)).alias("value"))
    out = tk.rejects(raw)
    return out.select(F.regexp_extract("frame", r"(?:junk |\"n\": )(\d+)", 1).cast("long").alias("event_id"), "reason")


@query("live_last_value", f"WITH {TICKS} SELECT instrument_key, max(ts) AS ts, arg_max(ltp, ts) AS ltp, count(*) AS ticks_seen FROM tk GROUP BY 1")
def live_last_value(spark, sf):
    out, state = folder(spark)
    tk.drain(lambda: tk.keyed_sink(tk.last_value(tk.decode(feed(spark, sf))), out, state, ["instrument_key"], None))
    return tk.read_keyed(spark, out).select("instrument_key", F.col("ts").cast("timestamp_ntz").alias("ts"), "ltp", "ticks_seen")


@query("live_coalesced", f"WITH {TICKS} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, instrument_key, arg_max(ltp, ts) AS ltp, count(*) AS n FROM tk GROUP BY 1, 2")
def live_coalesced(spark, sf):
    out, state = folder(spark)
    tk.drain(lambda: tk.vintage_sink(tk.coalesced(tk.decode(feed(spark, sf)), "1 hour"), out, state, None))
    return tk.read_vintages(spark, out, ["window_start", "instrument_key"]).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "instrument_key", "ltp", "n")


@query("live_enriched", f"WITH {TICKS} SELECT tk.instrument_key, ltq, s.symbol FROM tk LEFT JOIN (SELECT DISTINCT l_suppkey, 'S' || l_suppkey AS symbol FROM lineitem) s ON tk.instrument_key = 'NSE_EQ|I' || l_suppkey")
def live_enriched(spark, sf):
    out, state = folder(spark)
    tk.drain(lambda: tk.enriched_sink(tk.decode(feed(spark, sf)), lambda s: tk.symbol_keys(prices(s, sf)), out, state, None))
    return spark.read.parquet(out).select("instrument_key", "ltq", "symbol")


@query("live_subscription", f"WITH {TICKS} SELECT instrument_key, ltq, ltp FROM tk WHERE instrument_key IN ('NSE_EQ|I3', 'NSE_EQ|I77')")
def live_subscription(spark, sf):
    out, state = folder(spark)
    tk.drain(lambda: tk.cold_sink(tk.subscribe(tk.decode(feed(spark, sf)), ["NSE_EQ|I3", "NSE_EQ|I77"]), out, state, None))
    return spark.read.parquet(out).select("instrument_key", "ltq", "ltp")


@query("live_deduplicated", f"WITH {TICKS} SELECT DISTINCT instrument_key, ts FROM tk")
def live_deduplicated(spark, sf):
    twice = feed(spark, sf).withColumn("value", F.explode(F.array("value", "value")))
    out, state = folder(spark)
    tk.drain(lambda: tk.cold_sink(tk.deduplicate(tk.decode(twice)), out, state, None))
    return spark.read.parquet(out).select("instrument_key", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("live_open_segments", """WITH s AS (SELECT 'SEG' || (user_id % 10) AS segment, ['NORMAL_OPEN', 'CLOSING_END', 'PRE_OPEN_START'][event_id % 3 + 1] AS status, ts FROM events WHERE event_type = 'error')
  SELECT * FROM (SELECT segment, arg_max(status, ts) AS status FROM s GROUP BY 1) WHERE status <> 'CLOSING_END'""")
def live_open_segments(spark, sf):
    out, state = folder(spark)
    tk.drain(lambda: tk.cold_sink(tk.market_info(feed(spark, sf)), out, state, None))
    return tk.open_segments(spark.read.parquet(out))


@query("live_feed_status", f"WITH {TICKS} SELECT count(*) AS ticks_seen, max(ts) AS last_tick FROM tk")
def live_feed_status(spark, sf):
    out, state = folder(spark)
    tk.drain(lambda: tk.cold_sink(tk.decode(feed(spark, sf)), out, state, None))
    return tk.feed_status(spark.read.parquet(out), F.lit("2024-02-01 00:00:00").cast("timestamp")).select("ticks_seen", F.col("last_tick").cast("timestamp_ntz").alias("last_tick"))
