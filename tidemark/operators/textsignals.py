"""Transcripts, extracted items and the entities they name."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import lookup
from tidemark.functions.textsignals import ANCHOR_SECONDS, clean_ticker, transcript_piece
from tidemark.operators.asof import latest_vintage
from tidemark.session import materialise

# Fixed values.
LOOK_BACK = 400
BOUNDARIES = ("\n[", ". ", " ")
CANONICAL = {
    "meta platforms": "Meta",
    "facebook": "Meta",
    "anysphere": "Cursor",
    "alphabet inc.": "Alphabet",
    "google": "Alphabet",
    "x (twitter)": "X (Twitter)",
    "samsung": "Samsung Electronics",
    "sk hynix inc.": "SK hynix",
    "micron technology": "Micron",
}
STATUSES = ("discovered", "transcribed", "analyzed", "skipped", "error")


def recent(df: DataFrame, published: str, lookback_days: int, now: Column | None = None) -> DataFrame:
    """Rows published inside the window; text dates that cannot be read are kept, and a
    window of 0 or less keeps everything."""
    if lookback_days <= 0:
        return df
    cutoff = (now if now is not None else F.current_timestamp()) - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    ts = F.try_to_timestamp(F.col(published).cast("string"))
    return df.where(F.coalesce(ts >= cutoff, F.lit(True)))


def stamp_times(segments: DataFrame, doc: str = "video_id") -> DataFrame:
    """(doc, start) of the times that get a stamp: the first from 0 on, then always the first at least 30 s after the last stamp.

    The time after a stamp depends on that stamp alone, so each time is linked to its successor, and the chain from the first one is
    followed by pointer doubling: a round doubles both the length of the links and the stamps known. Rounds are the logarithm of the stamps of
    the longest recording, and no recording is gathered. Successors are found within slots of 30 s and, where the slot has none, in the next slot that
    has a time; only the slots of a recording, not its segments, meet in one window.
    """
    slot = lambda c: F.floor(F.col(c) / ANCHOR_SECONDS).alias("slot")
    start = F.col("start").cast("double")
    times = materialise(segments.where(F.col(doc).isNotNull() & (start >= 0) & ~F.isnan(start)).select(doc, start.alias("start")).distinct())
    due = times.select(doc, "start", (F.col("start") + ANCHOR_SECONDS).alias("at"))
    marks = times.select(doc, slot("start"), F.col("start").alias("at"), F.col("start").alias("time"), F.lit(None).cast("double").alias("start")).unionByName(
        due.select(doc, slot("at"), "at", F.lit(None).cast("double").alias("time"), "start"))
    # going down in time, a successor may be as late as what is due, so times come before what is due at the same moment
    within = Window.partitionBy(doc, "slot").orderBy(F.desc("at"), F.col("time").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy(doc).orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    slots = marks.groupBy(doc, "slot").agg(F.min("time").alias("first")).select(doc, "slot", F.min("first").over(later).alias("beyond"))
    near = marks.select(doc, "slot", "start", F.min("time").over(within).alias("near")).where("start IS NOT NULL")
    links = materialise(near.join(slots, [doc, "slot"]).select(doc, "start", F.coalesce("near", "beyond").alias("next")).where("next IS NOT NULL"))
    reached = times.groupBy(doc).agg(F.min("start").alias("start"))
    while not links.isEmpty():
        reached = materialise(reached.unionByName(reached.join(links, [doc, "start"]).select(doc, F.col("next").alias("start"))))
        links = materialise(links.join(links.select(doc, F.col("start").alias("next"), F.col("next").alias("after")), [doc, "next"]).select(doc, "start", F.col("after").alias("next")))
    return reached


def transcripts(segments: DataFrame, doc: str = "video_id") -> DataFrame:
    """One text per video with stamps, and its length in seconds.

    ``segments``: doc, start, duration, text, in the order of their starts; of several with the same start the shortest comes first, then the
    smaller text, and the first takes the stamp. Segments without a start, before 0 or without a document get no stamp. Only the finished pieces of a recording meet, as its text is one cell.
    """
    s = segments.select(doc, F.col("start").cast("double").alias("start"), F.col("duration").cast("double").alias("duration"), "text")
    first = F.row_number().over(Window.partitionBy(doc, "start").orderBy("duration", "text")) == 1
    s = s.withColumn("_first", first).join(stamp_times(segments, doc).withColumn("_stamp", F.lit(True)), [doc, "start"], "left")
    piece = transcript_piece(F.col("start"), F.col("text"), F.coalesce(F.col("_stamp") & F.col("_first"), F.lit(False)))
    # a stamped piece is the first of its time, whatever its text is
    pieces = F.struct("start", "duration", (~F.col("_first")).alias("later"), "text", piece.alias("piece"))
    g = s.groupBy(doc).agg(F.array_sort(F.collect_list(pieces)).alias("x"))
    last = F.element_at("x", -1)
    text = F.array_join(F.transform("x", lambda p: p["piece"]), "")
    return g.select(doc, F.regexp_replace(text, r"^\s+|\s+$", "").alias("transcript"), (last["start"] + last["duration"]).cast("int").alias("duration_sec"))


class Stops:
    """Where chunks of one text may end: the sorted ends of every kind of mark, listed when a kind is first asked for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.ends: dict[str, list[int]] = {}

    def before(self, limit: int) -> int:
        """The end of a chunk cut at ``limit``: after the last mark that lies within the look-back, of the strongest kind of mark that has
        one there, else the limit itself."""
        for mark in BOUNDARIES:
            if mark not in self.ends:
                self.ends[mark] = [m.end() for m in re.finditer(re.escape(mark), self.text)]
            ends = self.ends[mark]
            k = bisect_right(ends, limit)
            if k and ends[k - 1] - len(mark) >= limit - LOOK_BACK:
                return ends[k - 1]
        return limit


def spans(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of overlapping chunks of a text; the next one starts ``overlap`` before the end of the last."""
    n, stops, out = len(text), Stops(text), []
    start = end = 0
    while end < n:
        end = n if start + size >= n else stops.before(start + size)
        out.append((start, end))
        start = max(end - overlap, start + 1)
    return out


def chunks(docs: DataFrame, doc: str, text: str, size: int, overlap: int) -> DataFrame:
    """Overlapping chunks of whole texts on sentence boundaries, one row each."""
    if size <= LOOK_BACK:
        raise ValueError(f"size must be over {LOOK_BACK}")
    kind = docs.schema[doc].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for d, t in zip(pdf[doc], pdf[text]):
                if t is None:
                    continue
                parts = [t] if len(t) <= size else [p for p in (t[a:b].strip() for a, b in spans(t, size, overlap)) if p]
                rows += [(d, i, p) for i, p in enumerate(parts)]
            yield pd.DataFrame(rows, columns=[doc, "chunk_no", "chunk"])

    return docs.select(doc, text).mapInPandas(cut, f"{doc} {kind}, chunk_no int, chunk string")


# -- video state from an append-only log ----------------------------------------------

def video_state(log: DataFrame, key: str = "video_id", at: str = "seen_at", fixed: Sequence[str] = ("channel_name", "published"),
                refreshed: Sequence[str] = ("title", "views")) -> DataFrame:
    """Current row per video: first seen values stay, title and views follow the last write
    that carried them, and the status is the last one set."""
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(at)))
    oldest = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(at)))
    return log.groupBy(key).agg(*[oldest(c).alias(c) for c in fixed], *[newest(c).alias(c) for c in refreshed],
                                F.coalesce(newest("status"), F.lit("discovered")).alias("status"), F.min(at).alias("discovered_at"))


def current_items(items: DataFrame, key: str = "video_id", known: str = "knowledge_date", order: Sequence[str] = ("_vintage_id",)) -> DataFrame:
    """Items of the newest analysis of each video; earlier analyses are replaced."""
    return latest_vintage(items, [key], known=known, order=order)


def work_queue(videos: DataFrame, status: str, limit: int | None = None) -> DataFrame:
    out = videos.where(F.col("status") == status)
    return out if limit is None else out.orderBy(F.desc("published"), "video_id").limit(limit)


def to_fetch(feed: DataFrame, videos: DataFrame, min_duration: int = 0) -> DataFrame:
    """Feed entries that still need a transcript: not analyzed, none stored, long enough.

    ``feed``: video_id, duration_sec. Entries under the minimum are returned as skipped.
    """
    done = videos.where(F.col("status").isin("analyzed", "transcribed")).select("video_id")
    todo = feed.join(done, "video_id", "left_anti")
    return todo.withColumn("decision", F.when(F.col("duration_sec") < min_duration, "skipped").otherwise("fetch"))


def run_log(log: DataFrame, key: str = "video_id", run: str = "run_id", at: str = "seen_at") -> DataFrame:
    """What each run did, from the append-only log: started_at, finished_at, discovered, transcribed, analyzed, skipped, failed.

    A run discovers the videos it met that earlier runs had left neither transcribed nor analyzed, so a video that failed or
    was too short counts again when it is tried again. The others count videos that got that status in the run, ``error`` as failed; a
    video that got several counts for each. Rows without a run belong to none. The log is summed to a row per video and run before the window.
    """
    got = {"transcribed": "transcribed", "analyzed": "analyzed", "skipped": "skipped", "failed": "error"}
    status = F.when(F.col("status").isNotNull(), F.col(at))
    met = log.where(F.col(run).isNotNull()).groupBy(key, run).agg(
        F.max_by("status", status).alias("_last"), F.min(at).alias("_from"), F.max(at).alias("_to"),
        *[F.coalesce(F.bool_or(F.col("status") == v), F.lit(False)).alias(k) for k, v in got.items()])
    before = F.last("_last", ignorenulls=True).over(Window.partitionBy(key).orderBy(run).rowsBetween(Window.unboundedPreceding, -1))
    met = met.withColumn("_new", ~F.coalesce(before, F.lit("")).isin("transcribed", "analyzed"))
    return met.groupBy(run).agg(F.min("_from").alias("started_at"), F.max("_to").alias("finished_at"),
                                F.count_if("_new").alias("discovered"), *[F.count_if(k).alias(k) for k in got])


def roster_statistics(videos: DataFrame, items: DataFrame) -> DataFrame:
    """One row: videos, those waiting by status, analyzed episodes, their channels, and all signals."""
    by = {"discovered": "discovered", "transcribed": "transcribed", "skipped": "skipped", "failed": "error", "episodes": "analyzed"}
    done = F.when(F.col("status") == "analyzed", F.col("channel_name"))
    return videos.agg(F.count(F.lit(1)).alias("videos"), *[F.count_if(F.col("status") == v).alias(k) for k, v in by.items()], F.count_distinct(done).alias("channels")) \
        .withColumn("signals", items.agg(F.count(F.lit(1)).alias("n")).scalar())


def keep_items(items: DataFrame, allowed: Sequence[str] | None = None, min_confidence: float = 0.0) -> DataFrame:
    """Items of the allowed types and confidence, unusable fields filled in."""
    out = items if not allowed else items.where(F.col("type").isin(*allowed))
    out = out.where(F.coalesce("confidence", F.lit(0.0)) >= min_confidence)
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return out.withColumn("research_question", F.when((F.col("type") == "research_thread") & blank("research_question"), F.concat(F.lit("Verify: "), F.coalesce("headline", F.lit("None"))))
                          .otherwise(F.col("research_question"))) \
        .withColumn("era", F.when((F.col("type") == "historical_precedent") & blank("era"), "date unclear").otherwise(F.col("era")))


def board(videos: DataFrame, summaries: DataFrame, items: DataFrame, limit: int | None = None, min_confidence: float = 0.0) -> DataFrame:
    """Analyzed videos, the newest ``limit`` if one is given, with their summary and items, one row per item.

    Rows stay flat and carry what orders them (confidence, then time), so a video with very
    many items is neither gathered into one cell nor ranked in one task. A video without
    items keeps one row.
    """
    v = videos.where("status = 'analyzed'")
    v = v if limit is None else v.orderBy(F.desc("published"), "video_id").limit(limit)
    v = v.join(summaries, "video_id", "left")
    i = items.where(F.coalesce("confidence", F.lit(1.0)) >= min_confidence)
    return v.join(i.select("video_id", "type", "headline", "confidence", "t_start"), "video_id", "left")


def search(items: DataFrame, videos: DataFrame, phrase: str, limit: int | None = None) -> DataFrame:
    """Items whose headline, body or entities contain the phrase in any case; the newest ``limit`` if one is given."""
    p = F.lit(phrase.lower())
    hit = F.contains(F.lower("headline"), p) | F.contains(F.lower("body"), p) | F.contains(F.lower(F.array_join("entities", " ")), p)
    out = items.where(hit).join(videos.select("video_id", "channel_name", "published"), "video_id")
    return out if limit is None else out.orderBy(F.desc("published"), "video_id", "t_start").limit(limit)


def counts(videos: DataFrame, items: DataFrame) -> DataFrame:
    v = videos.agg(F.count(F.lit(1)).alias("videos"), F.count_if(F.col("status") == "analyzed").alias("analyzed"),
                   F.count_distinct(F.when(F.col("status") == "analyzed", F.col("channel_name"))).alias("channels"))
    return v.withColumn("items", items.agg(F.count(F.lit(1)).alias("n")).scalar())


# -- entities -------------------------------------------------------------------------

def mentions(items: DataFrame, videos: DataFrame) -> DataFrame:
    """One row per (item, entity) with the video it came from."""
    e = items.withColumn("name", F.explode("entities")).withColumn("name", F.trim("name")).where("name <> ''")
    return e.join(videos.select("video_id", "channel_name", "published"), "video_id")


def entity_totals(mentioned: DataFrame) -> DataFrame:
    """Mentions, channels, episodes and stance counts per entity.

    Channels are a short list; episodes are counted, not gathered. A name with a third of
    all mentions is summed in the map tasks.
    """
    by_stance = mentioned.groupBy("name", "stance", "channel_name").agg(F.count(F.lit(1)).alias("n"))
    totals = by_stance.groupBy("name").agg(F.sum("n").alias("mentions"), F.array_sort(F.collect_set("channel_name")).alias("channels"))
    mix = by_stance.where("stance IS NOT NULL AND stance <> ''").groupBy("name", "stance").agg(F.sum("n").alias("n"))
    mix = mix.groupBy("name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("stance", "n")))).alias("stance_mix"))
    episodes = mentioned.select("name", "video_id").distinct().groupBy("name").agg(F.count(F.lit(1)).alias("episodes"))
    return totals.join(episodes, "name").join(mix, "name", "left")


def entity_channels(mentioned: DataFrame) -> DataFrame:
    """Mentions and episodes of each entity in each channel, a row each: no set of channels is gathered, however many there are."""
    episodes = mentioned.groupBy("name", "channel_name", "video_id").agg(F.count(F.lit(1)).alias("n"))
    return episodes.groupBy("name", "channel_name").agg(F.sum("n").alias("mentions"), F.count("video_id").alias("episodes"))


def evidence(mentioned: DataFrame, totals: DataFrame, signals: int = 6, body_chars: int = 240, batch: int = 12) -> DataFrame:
    """The first signals naming each entity, newest first, with the batch the entity falls in
    when entities are taken most mentioned first."""
    w = Window.partitionBy("name").orderBy(F.desc("published"), "video_id", "t_start")
    top = mentioned.withColumn("signal_no", F.row_number().over(w)).where(F.col("signal_no") <= signals)
    return top.join(entity_batches(totals, batch), "name").select(
        "name", "batch_no", "signal_no", "type", "stance", "headline", F.substring("body", 1, body_chars).alias("body"))


def entity_batches(totals: DataFrame, batch: int = 12) -> DataFrame:
    """Batch number of each entity, most mentioned first.

    The position is an offset per mention count plus a rank within that count, so no single
    task sorts all entities: counts are few, and the rank is spread by first letters too.
    """
    key = F.lower("name")
    t = totals.select("name", "mentions", F.substring(key, 1, 2).alias("_p"))
    sizes = t.groupBy("mentions", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("mentions").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    per = sizes.groupBy("mentions").agg(F.sum("_n").alias("_m"))
    # One row per distinct mention count.
    per = per.withColumn("_off", F.coalesce(F.sum("_m").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("mentions")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("mentions", "_p").orderBy(F.lower("name"), "name")) - 1
    placed = t.withColumn("_r", rank).join(sizes.select("mentions", "_p", "_in"), ["mentions", "_p"]).join(per.select("mentions", "_off"), "mentions")
    return placed.select("name", F.floor((F.col("_off") + F.col("_in") + F.col("_r")) / batch).cast("bigint").alias("batch_no"))


def merge_aliases(classified: DataFrame, totals: DataFrame, mentioned: DataFrame, fixes: Mapping[str, str] = CANONICAL) -> DataFrame:
    """Fold aliases onto one company, in any case, and add up what was counted for each.

    ``classified``: seq, name, is_company, canonical_name, ticker, listing, theme, context.
    The description is the one of the most mentioned alias, the later one on a tie; the
    ticker is the first any alias supplies. Names nobody mentioned are dropped.
    """
    raw = F.coalesce("name", F.lit(""))
    canon = F.coalesce(F.nullif(F.trim(F.coalesce("canonical_name", F.lit(""))), F.lit("")), raw)
    c = classified.where("is_company").join(totals.select("name", "mentions", "channels"), "name").withColumn("_c", canon)
    c = c.withColumn("company", F.coalesce(lookup(fixes, F.lower("_c")), F.col("_c"))).withColumn("_k", F.lower("company"))
    c = c.withColumn("_t", F.nullif(clean_ticker("ticker", "company"), F.lit("")))
    best = F.struct("mentions", "seq")
    kept = lambda f: F.max_by(f, F.when(F.coalesce(F.col(f), F.lit("")) != "", best))
    g = c.groupBy("_k").agg(
        F.max_by("company", best).alias("company"), F.coalesce(F.min_by("_t", F.when(F.col("_t").isNotNull(), F.col("seq"))), F.lit("")).alias("ticker"),
        F.coalesce(kept("listing"), F.lit("unknown")).alias("listing"), F.coalesce(kept("theme"), F.lit("")).alias("theme"), F.coalesce(kept("context"), F.lit("")).alias("context"),
        F.sum("mentions").alias("mentions"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("channels")))).alias("channels"), F.array_sort(F.collect_set("name")).alias("aliases"))
    names = c.select("name", "_k").distinct()
    m = mentioned.join(names, "name")
    mix = m.where("stance IS NOT NULL AND stance <> ''").groupBy("_k", "stance").agg(F.count(F.lit(1)).alias("n")).groupBy("_k").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("stance", "n")))).alias("stance_mix"))
    episodes = m.select("_k", "video_id").distinct().groupBy("_k").agg(F.count(F.lit(1)).alias("episodes"))
    return g.join(episodes, "_k", "left").join(mix, "_k", "left").drop("_k")
