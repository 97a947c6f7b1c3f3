"""Transcript and entity queries on documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import textsignals as tf
from tidemark.operators import textsignals as ts
from tidemark.plans.bindings import events, table
from tidemark.plans.registry import query

# -- chapters and text ----------------------------------------------------------------


def stamped(spark, sf):
    """Documents whose lines carry a clock, every fifth going backwards."""
    d = table(spark, sf, "documents")
    lines = F.split("text", "\n")
    sec = lambda i: F.when(i % 5 == 4, i * 7).otherwise(i * 37)
    line = lambda t, i: F.concat(F.floor(sec(i) / 60).cast("string"), F.lit(":"), F.lpad((sec(i) % 60).cast("string"), 2, "0"), F.lit(" "), t)
    return d.select("doc_id", F.array_join(F.transform(F.slice(lines, 1, 1 << 30), line), "\n").alias("description"))


CHAPTERS = """l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
  k AS (SELECT doc_id, i, CASE WHEN i % 5 = 4 THEN i * 7 ELSE i * 37 END AS sec, trim(regexp_replace(trim(t, ' '), '^[-–—]+|[-–—]+$', '', 'g'), ' ') AS label, t FROM l),
  m AS (SELECT * FROM k WHERE length(regexp_replace(t, '^\\s+', '')) BETWEEN 2 AND 90 AND sec < 6000 AND label <> '' AND NOT starts_with(lower(label), 'http')),
  r AS (SELECT *, max(sec) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM m),
  ch AS (SELECT doc_id, i, sec, label FROM r WHERE top IS NULL OR sec > top)"""


@query("chapter_counts", f"""WITH {CHAPTERS}, n AS (SELECT doc_id, count(*) AS n, sum(sec) AS total FROM ch GROUP BY doc_id)
  SELECT d.doc_id, CASE WHEN n >= 2 THEN n ELSE 0 END AS chapters, CAST(CASE WHEN n >= 2 THEN total ELSE 0 END AS BIGINT) AS total_sec FROM documents d LEFT JOIN n USING (doc_id)""")
def chapter_counts(spark, sf):
    c = stamped(spark, sf).select("doc_id", tf.chapters("description").alias("c"))
    return c.select("doc_id", F.size("c").cast("bigint").alias("chapters"), F.aggregate("c", F.lit(0).cast("bigint"), lambda a, x: a + x["sec"]).alias("total_sec"))


@query("recency_filter", """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'soon' ELSE CAST(ts AS VARCHAR) END AS published FROM events WHERE event_id % 10 = 0 OR ts >= TIMESTAMP '2024-01-20'""")
def recency_filter(spark, sf):
    e = events(spark, sf).select("event_id", F.when(F.col("event_id") % 10 == 0, "soon").otherwise(F.col("ts").cast("string")).alias("published"))
    return ts.recent(e, "published", 11, F.lit("2024-01-31").cast("timestamp"))


def turns(spark, sf):
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("video_id"), (F.col("turn") * 13).cast("double").alias("start"), F.lit(10.0).alias("duration"), "text", "turn")


@query("transcripts", r"""WITH RECURSIVE s AS (SELECT conv_id, turn, turn * 13 AS st, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations),
  w AS (SELECT conv_id, rn, st + 30 AS due, chr(10) || '[' || (st // 60) || ':' || lpad(CAST(st % 60 AS VARCHAR), 2, '0') || '] ' || replace(text, chr(10), ' ') || ' ' AS out, st FROM s WHERE rn = 1
    UNION ALL SELECT w.conv_id, s.rn, CASE WHEN s.st >= due THEN s.st + 30 ELSE due END, out || CASE WHEN s.st >= due THEN chr(10) || '[' || (s.st // 60) || ':' || lpad(CAST(s.st % 60 AS VARCHAR), 2, '0') || '] ' ELSE '' END || replace(s.text, chr(10), ' ') || ' ', s.st
    FROM w JOIN s ON s.conv_id = w.conv_id AND s.rn = w.rn + 1)
  SELECT conv_id AS video_id, regexp_replace(arg_max(out, rn), '^\s+|\s+$', '', 'g') AS transcript, CAST(arg_max(st, rn) + 10 AS INTEGER) AS duration_sec FROM w GROUP BY conv_id""")
def transcripts(spark, sf):
    return ts.transcripts(turns(spark, sf))


AD = " Use my promo code SAVE20 at checkout today. Link in the description below. Thank you so much to Acme Labs for sponsoring this show."


@query("strip_sponsors", """SELECT doc_id, regexp_replace(CASE WHEN doc_id % 2 = 0 THEN text || '       end' ELSE text END, '\\s{3,}', '  ', 'g') AS text FROM documents""".replace("\\\\", "\\"))
def strip_sponsors(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", tf.strip_sponsors(F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit(AD), F.lit("    end"))).otherwise(F.col("text"))).alias("text"))


SIZE, OVERLAP = 1200, 150


CHUNKS = rf"""WITH RECURSIVE d AS (SELECT doc_id, text, length(text) AS n FROM documents),
  w AS (SELECT doc_id, text, n, 0 AS i, 0 AS s, CASE WHEN n <= {SIZE} THEN n ELSE NULL END AS e FROM d WHERE n <= {SIZE}
    UNION ALL SELECT doc_id, text, n, 0, 0, NULL FROM d WHERE n > {SIZE}),
  c AS (SELECT doc_id, text, n, i, s, least(s + {SIZE}, n) AS e0 FROM w
    UNION ALL SELECT doc_id, text, n, i + 1, greatest(cut - {OVERLAP}, s + 1), least(greatest(cut - {OVERLAP}, s + 1) + {SIZE}, n) FROM
      (SELECT *, CASE WHEN e0 >= n THEN e0 ELSE e0 - 400 + CASE
          WHEN contains(win, chr(10) || '[') THEN 400 - instr(reverse(win), '[' || chr(10)) + 1
          WHEN contains(win, '. ') THEN 400 - instr(reverse(win), ' .') + 1
          WHEN contains(win, ' ') THEN 400 - instr(reverse(win), ' ') + 1 ELSE 400 END END AS cut
       FROM (SELECT *, substr(text, e0 - 399, 400) AS win FROM c)) WHERE cut < n),
  f AS (SELECT doc_id, i, s, n, text, CASE WHEN e0 >= n THEN e0 ELSE e0 - 400 + CASE
          WHEN contains(win, chr(10) || '[') THEN 400 - instr(reverse(win), '[' || chr(10)) + 1
          WHEN contains(win, '. ') THEN 400 - instr(reverse(win), ' .') + 1
          WHEN contains(win, ' ') THEN 400 - instr(reverse(win), ' ') + 1 ELSE 400 END END AS cut FROM (SELECT *, substr(text, e0 - 399, 400) AS win FROM c)),
  cu AS (SELECT doc_id, i, s, cut, CASE WHEN n <= {SIZE} THEN text ELSE regexp_replace(substr(text, s + 1, cut - s), '^\s+|\s+$', '', 'g') END AS chunk FROM f)"""


@query("text_chunks", f"{CHUNKS} SELECT doc_id, count(*) AS chunks, CAST(sum(cut - s) AS BIGINT) AS covered FROM cu GROUP BY doc_id")
def text_chunks(spark, sf):
    d = table(spark, sf, "documents")

    def bounds(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(i, *p) for i, t in zip(pdf["doc_id"], pdf["text"]) for p in ([(0, len(t))] if len(t) <= SIZE else ts.spans(t, SIZE, OVERLAP))]
            yield pd.DataFrame(rows, columns=["doc_id", "s", "e"])

    b = d.select("doc_id", "text").mapInPandas(bounds, "doc_id bigint, s int, e int")
    return b.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.col("e") - F.col("s")).alias("covered"))


@query("text_chunk_rows", f"""{CHUNKS} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS chunk_no, chunk FROM cu WHERE chunk <> ''""")
def text_chunk_rows(spark, sf):
    return ts.chunks(table(spark, sf, "documents"), "doc_id", "text", SIZE, OVERLAP)


# -- videos and items -----------------------------------------------------------------

def video_log(spark, sf):
    c = table(spark, sf, "conversations")
    status = F.when(F.col("role") == "user", F.lit(None)).when(F.col("turn") % 4 == 3, "analyzed").otherwise("transcribed")
    return c.select(F.col("conv_id").alias("video_id"), F.col("turn").alias("seen_at"), F.concat(F.lit("ch"), (F.col("conv_id") % 4).cast("string")).alias("channel_name"),
                    F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 300).cast("int")).alias("published"),
                    F.concat("role", F.lit(" "), F.col("turn").cast("string")).alias("title"), F.length("text").alias("views"), status.alias("status"))


VIDEOS = """vd AS (SELECT conv_id AS video_id, 'ch' || (conv_id % 4) AS channel_name, DATE '2024-01-01' + CAST(conv_id % 300 AS INTEGER) AS published, arg_max(role || ' ' || turn, turn) AS title, arg_max(length(text), turn) AS views,
  coalesce(arg_max(CASE WHEN turn % 4 = 3 THEN 'analyzed' ELSE 'transcribed' END, turn) FILTER (role <> 'user'), 'discovered') AS status, min(turn) AS discovered_at FROM conversations GROUP BY conv_id)"""


def videos(spark, sf):
    return ts.video_state(video_log(spark, sf))


@query("video_state", f"WITH {VIDEOS} SELECT video_id, channel_name, published, title, CAST(views AS INTEGER) AS views, status, discovered_at FROM vd")
def video_state(spark, sf):
    return videos(spark, sf)


KINDS = ("investable_idea", "research_thread", "historical_precedent")


def items(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("video_id"), F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("turn") % 3 + 1).cast("int")).alias("type"), F.substring("text", 1, 60).alias("headline"),
                    F.col("text").alias("body"), (F.col("turn") * 20).alias("t_start"), (((F.col("conv_id") * 7 + F.col("turn")) % 10) / 10.0).alias("confidence"),
                    F.when(F.col("role") == "user", "bullish").when(F.col("turn") % 3 == 0, "bearish").alias("stance"), F.regexp_extract_all("text", F.lit("([A-Z][a-z]{3,7})"), F.lit(1)).alias("entities"),
                    F.lit(None).cast("string").alias("research_question"), F.when(F.col("turn") % 2 == 0, "1998").alias("era"))


ITEMS = f"""it AS (SELECT conv_id AS video_id, {list(KINDS)}[turn % 3 + 1] AS type, left(text, 60) AS headline, text AS body, turn * 20 AS t_start, ((conv_id * 7 + turn) % 10) / 10.0::DOUBLE AS confidence,
  CASE WHEN role = 'user' THEN 'bullish' WHEN turn % 3 = 0 THEN 'bearish' END AS stance, regexp_extract_all(text, '([A-Z][a-z]{{3,7}})', 1) AS entities, turn FROM conversations)"""


@query("keep_items", f"""WITH {ITEMS} SELECT video_id, t_start, type, confidence, CASE type WHEN 'research_thread' THEN 'Verify: ' || headline END AS research_question,
  CASE WHEN turn % 2 = 0 THEN '1998' WHEN type = 'historical_precedent' THEN 'date unclear' END AS era FROM it WHERE type <> 'investable_idea' AND confidence >= 0.5""")
def keep_items(spark, sf):
    return ts.keep_items(items(spark, sf), KINDS[1:], 0.5).select("video_id", "t_start", "type", "confidence", "research_question", "era")


@query("current_items", "SELECT conv_id AS video_id, turn, text AS body FROM conversations QUALIFY dense_rank() OVER (PARTITION BY conv_id ORDER BY turn // 3 DESC) = 1")
def current_items(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("video_id"), "turn", F.col("text").alias("body"), F.floor(F.col("turn") / 3).alias("knowledge_date"), F.lit(0).alias("_vintage_id"))
    return ts.current_items(c).select("video_id", "turn", "body")


@query("video_board", f"""WITH {VIDEOS}, {ITEMS}, v AS (SELECT * FROM vd WHERE status = 'analyzed' ORDER BY published DESC, video_id LIMIT 40)
  SELECT v.video_id, title, 'sum ' || v.video_id AS summary, i.type, i.headline, i.confidence, i.t_start FROM v LEFT JOIN
    (SELECT * FROM it WHERE confidence >= 0.2) i ON i.video_id = v.video_id""")
def video_board(spark, sf):
    v = videos(spark, sf)
    s = v.select("video_id", F.concat(F.lit("sum "), F.col("video_id").cast("string")).alias("summary"))
    return ts.board(v, s, items(spark, sf), 40, 0.2).select("video_id", "title", "summary", "type", "headline", "confidence", "t_start")


@query("item_search", f"WITH {VIDEOS}, {ITEMS} SELECT video_id, t_start, channel_name, published FROM it JOIN vd USING (video_id) WHERE contains(lower(body), 'tion') ORDER BY published DESC, video_id, t_start LIMIT 50")
def item_search(spark, sf):
    return ts.search(items(spark, sf), videos(spark, sf), "TION", 50).select("video_id", "t_start", "channel_name", "published")


@query("signal_counts", f"WITH {VIDEOS} SELECT count(*) AS videos, count(*) FILTER (status = 'analyzed') AS analyzed, count(DISTINCT channel_name) FILTER (status = 'analyzed') AS channels, (SELECT count(*) FROM conversations) AS items FROM vd")
def signal_counts(spark, sf):
    return ts.counts(videos(spark, sf), items(spark, sf))


@query("work_queue", f"WITH {VIDEOS} SELECT video_id, published FROM vd WHERE status = 'transcribed' ORDER BY published DESC, video_id LIMIT 100")
def work_queue(spark, sf):
    return ts.work_queue(videos(spark, sf), "transcribed", 100).select("video_id", "published")


@query("to_fetch", f"""WITH {VIDEOS} SELECT doc_id AS video_id, CASE WHEN n_chars < 500 THEN 'skipped' ELSE 'fetch' END AS decision FROM documents WHERE doc_id NOT IN (SELECT video_id FROM vd WHERE status IN ('analyzed', 'transcribed'))""")
def to_fetch(spark, sf):
    feed = table(spark, sf, "documents").select(F.col("doc_id").alias("video_id"), F.col("n_chars").alias("duration_sec"))
    return ts.to_fetch(feed, videos(spark, sf), 500).select("video_id", "decision")


def run_rows(spark, sf):
    """Every turn of a conversation as something a run wrote about a video."""
    status = F.element_at(F.array(*[F.lit(x) for x in ("transcribed", None, "error", "analyzed", "skipped")]), (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(5)) + 1).cast("int"))
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("video_id"), F.col("turn").alias("seen_at"), F.floor(F.col("turn") / 2).cast("int").alias("run_id"), status.alias("status"))


@query("run_log", """WITH lg AS (SELECT conv_id, turn, CAST(turn // 2 AS INTEGER) AS run_id, (['transcribed', NULL, 'error', 'analyzed', 'skipped'])[CAST((conv_id + turn) % 5 + 1 AS INTEGER)] AS status FROM conversations),
  vr AS (SELECT conv_id, run_id, min(turn) AS lo, max(turn) AS hi, arg_max(status, turn) FILTER (status IS NOT NULL) AS st, list(status) AS ss FROM lg GROUP BY 1, 2),
  pv AS (SELECT *, last_value(st IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM vr)
  SELECT run_id, min(lo) AS started_at, max(hi) AS finished_at, count(*) FILTER (prior IS NULL OR prior NOT IN ('transcribed', 'analyzed')) AS discovered, count(*) FILTER (list_contains(ss, 'transcribed')) AS transcribed,
    count(*) FILTER (list_contains(ss, 'analyzed')) AS analyzed, count(*) FILTER (list_contains(ss, 'skipped')) AS skipped, count(*) FILTER (list_contains(ss, 'error')) AS failed FROM pv GROUP BY run_id""")
def run_log(spark, sf):
    return ts.run_log(run_rows(spark, sf))


@query("roster_statistics", f"""WITH {VIDEOS} SELECT count(*) AS videos, count(*) FILTER (status = 'discovered') AS discovered, count(*) FILTER (status = 'transcribed') AS transcribed, 0::BIGINT AS skipped, 0::BIGINT AS failed,
  count(*) FILTER (status = 'analyzed') AS episodes, count(DISTINCT channel_name) FILTER (status = 'analyzed') AS channels, (SELECT count(*) FROM conversations) AS signals FROM vd""")
def roster_statistics(spark, sf):
    return ts.roster_statistics(videos(spark, sf), items(spark, sf))


MENTIONS = f"""{VIDEOS}, {ITEMS}, mn AS (SELECT it.*, vd.channel_name, vd.published, name FROM (SELECT *, unnest(entities) AS name FROM it) it JOIN vd USING (video_id)),
  tt AS (SELECT name, count(*) AS mentions, array_to_string(list_sort(list_distinct(list(channel_name))), ',') AS channels, count(DISTINCT video_id) AS episodes,
    count(*) FILTER (stance = 'bullish') AS bullish, count(*) FILTER (stance = 'bearish') AS bearish FROM mn GROUP BY name)"""


def mentioned(spark, sf):
    return ts.mentions(items(spark, sf), videos(spark, sf))


def flat(df, *cols):
    side = lambda s: F.coalesce(F.try_element_at("stance_mix", F.lit(s)), F.lit(0)).alias(s)
    return df.select(*cols, "mentions", F.array_join("channels", ",").alias("channels"), "episodes", side("bullish"), side("bearish"))


@query("entity_totals", f"WITH {MENTIONS} SELECT * FROM tt")
def entity_totals(spark, sf):
    return flat(ts.entity_totals(mentioned(spark, sf)), "name")


@query("entity_channels", f"WITH {MENTIONS} SELECT name, channel_name, count(*) AS mentions, count(DISTINCT video_id) AS episodes FROM mn GROUP BY 1, 2")
def entity_channels(spark, sf):
    return ts.entity_channels(mentioned(spark, sf))


@query("entity_evidence", f"""WITH {MENTIONS}, b AS (SELECT name, (row_number() OVER (ORDER BY mentions DESC, lower(name), name) - 1) // 12 AS batch_no FROM tt),
  e AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY published DESC, video_id, t_start) AS rk FROM mn)
  SELECT name, batch_no, CAST(rk AS INTEGER) AS signal_no, left(body, 240) AS body FROM e JOIN b USING (name) WHERE rk <= 6""")
def entity_evidence(spark, sf):
    full = mentioned(spark, sf)
    return ts.evidence(full, ts.entity_totals(full)).select("name", "batch_no", "signal_no", "body")


@query("merge_aliases", f"""WITH {MENTIONS}, cl AS (SELECT name, mentions, CASE WHEN substr(name, 1, 1) IN ('A', 'E', 'I') THEN 'Vowel Group' ELSE left(name, 2) END AS company FROM tt),
  ds AS (SELECT company, first(name ORDER BY mentions DESC, name DESC) AS top, first(name ORDER BY mentions DESC, name DESC) FILTER (length(name) % 2 = 0) AS even, array_to_string(list(name ORDER BY name), ',') AS aliases FROM cl GROUP BY company),
  j AS (SELECT company, mn.* FROM mn JOIN cl USING (name)),
  g AS (SELECT company, count(*) AS mentions, array_to_string(list_sort(list_distinct(list(channel_name))), ',') AS channels, count(DISTINCT video_id) AS episodes, count(*) FILTER (stance = 'bullish') AS bullish, count(*) FILTER (stance = 'bearish') AS bearish,
    CASE company WHEN 'Vowel Group' THEN 'VWL.N' ELSE '' END AS ticker FROM j GROUP BY company)
  SELECT g.*, coalesce('listed ' || even, 'unknown') AS listing, 'theme ' || top AS theme, 'about ' || top AS context, aliases FROM g JOIN ds USING (company)""")
def merge_aliases(spark, sf):
    m = mentioned(spark, sf)
    totals = ts.entity_totals(m)
    vowel = F.substring("name", 1, 1).isin("A", "E", "I")
    canon = F.when(vowel, "Vowel Group").otherwise(F.substring("name", 1, 2))
    c = totals.select("name", F.col("name").alias("seq"), F.lit(True).alias("is_company"), canon.alias("canonical_name"), F.when(vowel, "vwl.n").otherwise(F.upper(canon)).alias("ticker"),
                      F.when(F.length("name") % 2 == 0, F.concat(F.lit("listed "), "name")).alias("listing"), F.concat(F.lit("theme "), "name").alias("theme"), F.concat(F.lit("about "), "name").alias("context"))
    merged = ts.merge_aliases(c, totals, m).withColumn("aliases", F.array_join("aliases", ","))
    return flat(merged, "company", "ticker", "listing", "theme", "context", "aliases")
