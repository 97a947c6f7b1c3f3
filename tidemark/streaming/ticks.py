"""Live ticks with Structured Streaming.

One decoded stream feeds a cold append (every tick, as vintages) and hot views (last value
per instrument, coalesced windows). Frames arrive as JSON text on any source Spark reads.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import to_double

# Fixed values.
OPEN_STATUSES = ("NORMAL_OPEN", "PRE_OPEN_START", "PRE_OPEN_END")
FLUSH_INTERVAL = "60 seconds"
COALESCE = "100 milliseconds"
LATENESS = "10 seconds"

LTPC = "struct<ltp: double, ltt: bigint, ltq: bigint, cp: double>"
FULL = f"struct<ltpc: {LTPC}, atp: double, vtt: bigint, oi: double, iv: double, tbq: double, tsq: double>"
BOTH = f"marketFF: {FULL}, indexFF: struct<ltpc: {LTPC}>"
FRAME = (f"struct<type: string, ts: string, feeds: map<string, struct<ltpc: {LTPC}, fullFeed: struct<{BOTH}>, {BOTH}>>, "
         "segmentStatus: map<string, string>>")


def tick_time(text: Column) -> Column:
    """A time written as a timestamp, or as seconds, milliseconds or microseconds since 1970; NULL where it is neither."""
    n = text.try_cast("double")
    unit = F.when(F.abs(n) < 1e11, 1e6).when(F.abs(n) < 1e14, 1e3).otherwise(1.0)
    return F.coalesce(F.timestamp_micros((n * unit).try_cast("bigint")), F.try_to_timestamp(text))


def frames(raw: DataFrame, column: str = "value") -> DataFrame:
    """Parsed frames of a text or byte column; what is not a frame is in ``rejects``."""
    return raw.select(F.from_json(F.col(column).cast("string"), FRAME).alias("f")).where("f.type IS NOT NULL").select("f.*")


def _feeds(raw: DataFrame, column: str) -> DataFrame:
    f = frames(raw, column).where("type <> 'market_info'").select("ts", F.explode("feeds").alias("instrument_key", "u"))
    full = F.coalesce("u.fullFeed.marketFF", "u.marketFF")
    price = F.coalesce("u.ltpc", "u.fullFeed.marketFF.ltpc", "u.fullFeed.indexFF.ltpc", "u.marketFF.ltpc", "u.indexFF.ltpc")
    return f.select("instrument_key", price.alias("p"), full.alias("m"), tick_time(F.col("ts")).alias("ts"))


def decode(raw: DataFrame, column: str = "value") -> DataFrame:
    """Flat tick records of every feed kind: last price only, full market depth, or index, nested in ``fullFeed`` or not."""
    return _feeds(raw, column).where("p IS NOT NULL AND ts IS NOT NULL").select(
        "instrument_key", "p.ltp", "p.ltt", "p.ltq", F.col("p.cp").alias("close_price"), F.col("m.vtt").alias("volume"), "m.oi", "m.atp",
        "m.iv", F.col("m.tbq").alias("total_buy_qty"), F.col("m.tsq").alias("total_sell_qty"), "ts")


def rejects(raw: DataFrame, column: str = "value") -> DataFrame:
    """Rows that give no tick and no status, with the reason: not a frame, no known feed, or no readable time."""
    text = F.col(column).cast("string")
    f = F.from_json(text, FRAME)
    known = F.exists(F.map_values(f["feeds"]), lambda u: F.coalesce(
        u["ltpc"], u["fullFeed"]["marketFF"]["ltpc"], u["fullFeed"]["indexFF"]["ltpc"], u["marketFF"]["ltpc"], u["indexFF"]["ltpc"]).isNotNull())
    has = F.when(f["type"] == "market_info", f["segmentStatus"].isNotNull()).otherwise(F.coalesce(known, F.lit(False)))
    reason = F.when(f["type"].isNull(), "not a frame").when(~has, "no known feed").when(tick_time(f["ts"]).isNull(), "no readable time")
    return raw.select(text.alias("frame"), reason.alias("reason")).where("reason IS NOT NULL")


def market_info(raw: DataFrame, column: str = "value") -> DataFrame:
    """Segment status rows, apart from the ticks."""
    f = frames(raw, column).where("type = 'market_info'").select(tick_time(F.col("ts")).alias("ts"), F.explode("segmentStatus").alias("segment", "status"))
    return f.where("ts IS NOT NULL")


def flat_ticks(raw: DataFrame, column: str = "value") -> DataFrame:
    """Already flat tick records: {token, ltp, volume, oi, ts}."""
    d = F.from_json(F.col(column).cast("string"), "token string, ltp string, volume string, oi string, ts string")
    flat = raw.select(d.alias("d")).where("d.token IS NOT NULL").select(F.col("d.token").alias("instrument_key"), to_double("d.ltp").alias("ltp"),
                                                                       F.col("d.volume").try_cast("bigint").alias("volume"), to_double("d.oi").alias("oi"), tick_time(F.col("d.ts")).alias("ts"))
    return flat.where("ts IS NOT NULL")


def deduplicate(ticks: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Each (instrument, time) once; state older than the watermark is dropped."""
    return ticks.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["instrument_key", "ts"])


def subscribe(ticks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ticks.where(F.col("instrument_key").isin(*keys))


def symbol_keys(prices: DataFrame) -> DataFrame:
    """instrument_key to symbol through the ISIN both sides carry."""
    return prices.where("isin IS NOT NULL").groupBy(F.concat(F.lit("NSE_EQ|"), "isin").alias("instrument_key")).agg(F.min("symbol").alias("symbol"))


def enrich(ticks: DataFrame, keys: DataFrame) -> DataFrame:
    """Ticks with their symbol. A stream keeps the files of ``keys`` that were there when it started; ``enriched_sink`` looks again."""
    return ticks.join(keys, "instrument_key", "left")


def last_value(ticks: DataFrame) -> DataFrame:
    """Newest tick per instrument by event time; a late tick does not replace a newer one."""
    fields = [c for c in ticks.columns if c not in ("instrument_key", "ts")]
    return ticks.groupBy("instrument_key").agg(F.max("ts").alias("ts"), F.max_by(F.struct(*fields), "ts").alias("_t"), F.count(F.lit(1)).alias("ticks_seen")) \
        .select("instrument_key", "ts", "_t.*", "ticks_seen")


def coalesced(ticks: DataFrame, every: str = COALESCE, lateness: str = LATENESS) -> DataFrame:
    """Last tick of each instrument per window; an empty window has no row."""
    w = F.window("ts", every)
    return ticks.withWatermark("ts", lateness).groupBy(w, "instrument_key").agg(F.max_by("ltp", "ts").alias("ltp"), F.count(F.lit(1)).alias("n")) \
        .select(F.col("window.start").alias("window_start"), "instrument_key", "ltp", "n")


def open_segments(status: DataFrame) -> DataFrame:
    """Segments trading now, by the exact status of their newest message."""
    newest = status.groupBy("segment").agg(F.max_by("status", "ts").alias("status"))
    return newest.where(F.col("status").isin(*OPEN_STATUSES))


def feed_status(ticks: DataFrame, now) -> DataFrame:
    """Ticks seen, newest tick and its age in seconds."""
    return ticks.agg(F.count(F.lit(1)).alias("ticks_seen"), F.max("ts").alias("last_tick"),
                     F.timestamp_diff("SECOND", F.max("ts"), now).alias("last_tick_age_seconds"))


# -- sinks ----------------------------------------------------------------------------

def cold_sink(ticks: DataFrame, path: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL):
    """Start the append of every tick, one vintage per micro-batch. ``interval=None`` takes
    what is available and stops.

    A tick is known from the day it arrives, and its vintage is the batch that brought it. A batch that runs again
    overwrites its own folder.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumns({"_vintage_id": F.lit(batch_id).cast("long"), "knowledge_date": F.current_date()})
         .write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))

    w = ticks.writeStream.option("checkpointLocation", checkpoint).outputMode("append").foreachBatch(store)
    return (w.trigger(availableNow=True) if interval is None else w.trigger(processingTime=interval)).start()


def enriched_sink(ticks: DataFrame, keys_now: Callable[[SparkSession], DataFrame], path: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL):
    """Start the append of every tick with its symbol, looked up anew for each micro-batch.

    ``keys_now`` reads the table of keys when a batch comes in, so files that were added to it since the last batch are listed, without a restart.
    A batch that runs again overwrites its own folder.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        stamps = {"_vintage_id": F.lit(batch_id).cast("long"), "knowledge_date": F.current_date()}
        enrich(batch, keys_now(batch.sparkSession)).withColumns(stamps).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    w = ticks.writeStream.option("checkpointLocation", checkpoint).outputMode("append").foreachBatch(store)
    return (w.trigger(availableNow=True) if interval is None else w.trigger(processingTime=interval)).start()


#: Versions of a keyed table that stay: the newest, and the one that readers may be in.
VERSIONS_KEPT = 2


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Complete versions of a keyed table, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("version=") and fs.exists(done):
            found.append((int(name.removeprefix("version=")), status.getPath().toString()))
    return sorted(found)


def keyed_sink(updates: DataFrame, path: str, checkpoint: str, key: Sequence[str], interval: str | None = FLUSH_INTERVAL, files: int | None = None):
    """Start an aggregation whose changed rows replace those of their key in a table with one row per key.

    Batch k writes version k: the rows of the newest older version whose key did not change, and the changed ones. Versions before the
    previous one are removed, so neither reads nor the number of files grow with the batches. A batch that runs again after a failure starts
    from the same older version and overwrites its own. ``files`` is the most files of a version, by default what the
    join leaves.
    """
    key = list(key)

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        older = [v for v in _versions(spark, path) if v[0] < batch_id]
        merged = batch
        if older:
            before = spark.read.schema(batch.schema).parquet(older[-1][1])
            merged = before.join(batch.select(*key), key, "left_anti").select(*batch.columns).unionByName(batch)
        (merged if files is None else merged.coalesce(files)).write.mode("overwrite").parquet(f"{path}/version={batch_id:012d}")
        for _, gone in _versions(spark, path)[:-VERSIONS_KEPT]:
            old = spark._jvm.org.apache.hadoop.fs.Path(gone)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    w = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)
    return (w.trigger(availableNow=True) if interval is None else w.trigger(processingTime=interval)).start()


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a ``keyed_sink``, one row per key."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no version of a keyed table in {path}")
    return spark.read.parquet(versions[-1][1])


def vintage_sink(updates: DataFrame, path: str, checkpoint: str, interval: str | None = FLUSH_INTERVAL, mode: str = "update"):
    """Start an aggregation whose changed rows are appended as vintages numbered by batch.

    A batch that runs again after a failure overwrites its own folder, so it is not counted
    twice. Readers take the newest batch per key.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    w = updates.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)
    return (w.trigger(availableNow=True) if interval is None else w.trigger(processingTime=interval)).start()


def read_vintages(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """Newest stored row per key of a ``vintage_sink``."""
    from tidemark.operators.asof import collapse

    return collapse(spark.read.parquet(path), list(key), known="batch", order=()).drop("batch")


def drain(start: Callable[[], object]) -> None:
    """Run a query that stops by itself to its end."""
    q = start()
    q.awaitTermination()
