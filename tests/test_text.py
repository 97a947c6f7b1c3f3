import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import textsignals as tf
from tidemark.operators import textsignals as ts


def one(spark, text, expr):
    return spark.createDataFrame([(text,)], "x string").select(expr.alias("y")).first().y


def test_chapters_keep_an_increasing_run(spark):
    d = "Intro line\n0:00 Intro\n10:19 - Cancer -\nprice 5:41 here\n5:41 Back\n 1:02:30 Closing\n2:00:00 https://x"
    assert [(c.sec, c.label) for c in one(spark, d, tf.chapters("x"))] == [(0, "Intro"), (619, "Cancer"), (3750, "Closing")]
    assert one(spark, "0:00 Only", tf.chapters("x")) == [] and one(spark, None, tf.chapters("x")) == []


def test_sponsor_passages_go(spark):
    t = "Good point. Use my promo code SAVE20 at checkout. Next. Link in the description below. End."
    assert one(spark, t, tf.strip_sponsors("x")) == "Good point.  Next.  End."


def test_transcript_anchors(spark):
    rows = [("v", float(s), 4.0, t) for s, t in ((0, "a"), (10, "b\nb"), (31, "c"), (60, "d"), (3700, "e"))]
    r = ts.transcripts(spark.createDataFrame(rows, "video_id string, start double, duration double, text string").repartition(3)).first()
    assert r.transcript == "[0:00] a b b \n[0:31] c d \n[1:01:40] e" and r.duration_sec == 3704


def folded(rows):
    """Transcript by one pass over the sorted segments."""
    due, out = 0.0, ""
    for start, _, text in sorted(rows):
        if start >= due:
            m, s = divmod(int(start), 60)
            out += f"\n[{m // 60}:{m % 60:02d}:{s:02d}] " if m >= 60 else f"\n[{m}:{s:02d}] "
            due = start + 30
        out += text.replace("\n", " ") + " "
    return out.strip()


def test_transcripts_equal_one_pass_over_the_segments(spark):
    rng = random.Random(8)
    talks = {"dense": [rng.uniform(0, 900) for _ in range(700)], "sparse": [rng.uniform(0, 90000) for _ in range(300)], "even": [30.0 * i for i in range(200)],
             "ties": [float(rng.randrange(0, 200, 5)) for _ in range(150)], "early": [-40.0, -3.0, 2.5, 31.0, 33.0], "one": [7.0], "gaps": [29.999999999999996, 60.0, 59.99999999999999, 1e5, 1e5 + 30]}
    rows = [(v, s, float(rng.randint(1, 9)), f"w{rng.randint(0, 99)}\nx") for v, starts in talks.items() for s in starts]
    df = spark.createDataFrame(rows, "video_id string, start double, duration double, text string").repartition(5)
    got = {r.video_id: r.transcript for r in ts.transcripts(df).collect()}
    assert got == {v: folded([r[1:] for r in rows if r[0] == v]) for v in talks}


def test_transcripts_of_nothing_and_without_times(spark):
    schema = "video_id string, start double, duration double, text string"
    assert ts.transcripts(spark.createDataFrame([], schema)).collect() == []
    r = ts.transcripts(spark.createDataFrame([("v", None, None, "a"), ("v", 5.0, 2.0, "b"), ("v", 5.0, 2.0, "b"), ("v", 50.0, 1.0, None)], schema)).first()
    assert r.transcript == "a \n[0:05] b b" and r.duration_sec == 51


def test_chunks_cover_whole_texts(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(["word ", "end. ", "\n[1:00] ", "x"]) for _ in range(n)) for n in (10, 400, 3000)] + ["y" * 5000, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {}
    for r in ts.chunks(df, "id", "text", 900, 100).orderBy("id", "chunk_no").collect():
        got.setdefault(r.id, []).append(r.chunk)
    assert got[0] == [texts[0]] and 4 not in got
    for i in (1, 2, 3):
        assert all(len(c) <= 900 for c in got[i]) and texts[i].lstrip().startswith(got[i][0]) and texts[i].rstrip().endswith(got[i][-1])
        assert all(c in texts[i] for c in got[i])
        spans = ts.spans(texts[i], 900, 100)
        assert spans[0][0] == 0 and spans[-1][1] == len(texts[i]) and all(b[0] <= a[1] for a, b in zip(spans, spans[1:]))
    with pytest.raises(ValueError):
        ts.chunks(df, "id", "text", 300, 10)


def test_run_log_counts_what_each_run_changed(spark):
    log = spark.createDataFrame([("a", 1, 10, None), ("a", 1, 11, "transcribed"), ("b", 1, 12, "error"), ("c", 1, 13, None), ("d", 1, 14, "skipped"),
                                 ("a", 2, 20, "analyzed"), ("b", 2, 21, "transcribed"), ("b", 2, 22, "analyzed"), ("c", 2, 23, None),
                                 ("b", 3, 30, None), ("c", 3, 31, "transcribed"), ("d", 3, 32, "error"), ("e", None, 33, "analyzed")],
                                "video_id string, run_id int, seen_at int, status string")
    rows = {r.run_id: tuple(r)[1:] for r in ts.run_log(log).collect()}
    assert rows == {1: (10, 14, 4, 1, 0, 1, 1),   # all four are new
                    2: (20, 23, 2, 1, 2, 0, 0),   # a is no longer open; b failed and c was only seen
                    3: (30, 32, 2, 1, 0, 0, 1)}   # b is done
    assert ts.run_log(log.limit(0)).count() == 0


def test_roster_statistics_of_some_and_no_videos(spark):
    v = spark.createDataFrame([("a", "x", "analyzed"), ("b", "x", "analyzed"), ("c", None, "analyzed"), ("d", "y", "error"), ("e", "y", None)], "video_id string, channel_name string, status string")
    items = spark.range(7)
    assert ts.roster_statistics(v, items).first().asDict() == {"videos": 5, "discovered": 0, "transcribed": 0, "skipped": 0, "failed": 1, "episodes": 3, "channels": 1, "signals": 7}
    assert set(ts.roster_statistics(v.limit(0), items.limit(0)).first()) == {0}


def test_entity_channels_are_rows(spark):
    m = spark.createDataFrame([("n", "x", 1), ("n", "x", 1), ("n", "x", 2), ("n", None, 3), ("k", "x", 1)], "name string, channel_name string, video_id long")
    assert {tuple(r) for r in ts.entity_channels(m).collect()} == {("n", "x", 3, 2), ("n", None, 1, 1), ("k", "x", 1, 1)}


def test_video_state_keeps_first_seen_fields(spark):
    log = spark.createDataFrame([("v", 1, "ch", "2026-01-01", "old", 5, None), ("v", 2, "other", "2026-02-02", "new", 9, None), ("v", 3, None, None, None, None, "transcribed"), ("w", 1, "ch", "2026-01-01", "t", 1, None)],
                                "video_id string, seen_at int, channel_name string, published string, title string, views int, status string")
    r = {x.video_id: x for x in ts.video_state(log).collect()}
    assert (r["v"].channel_name, r["v"].title, r["v"].views, r["v"].status, r["w"].status) == ("ch", "new", 9, "transcribed", "discovered")


def test_item_defaults(spark):
    df = spark.createDataFrame([("research_thread", "H", 0.9, None, None), ("historical_precedent", "P", 0.9, None, None), ("idea", "I", 0.9, None, None), ("research_thread", "L", None, "q", None)],
                               "type string, headline string, confidence double, research_question string, era string")
    r = {x.headline: (x.research_question, x.era) for x in ts.keep_items(df, ["research_thread", "historical_precedent"], 0.5).collect()}
    assert r == {"H": ("Verify: H", None), "P": (None, "date unclear")}


def test_aliases_fold_and_best_description_wins(spark):
    videos = spark.createDataFrame([("v1", "c1", "2026-01-02"), ("v2", "c2", "2026-01-01")], "video_id string, channel_name string, published string")
    items = spark.createDataFrame([("v1", ["Facebook", "Meta"], "bullish", 1), ("v1", ["Facebook"], "bearish", 2), ("v2", ["meta", "xAI"], None, 3)], "video_id string, entities array<string>, stance string, t_start int") \
        .withColumn("type", F.lit("t")).withColumn("headline", F.lit("h")).withColumn("body", F.lit("b"))
    m = ts.mentions(items, videos)
    totals = ts.entity_totals(m)
    assert {x.name: (x.mentions, x.channels, x.episodes) for x in totals.collect()}["Facebook"] == (2, ["c1"], 1)
    c = spark.createDataFrame([(1, "Meta", True, "Meta", "", "public", "social", "low"), (2, "Facebook", True, "Facebook", "meta", None, None, "rich"), (3, "meta", True, "Meta Platforms", "FB", "x", "y", "z"),
                               (4, "xAI", True, None, "xAI", None, None, None), (5, "Ghost", True, "Ghost", "G", None, None, None), (6, "xAI", False, "xAI", "X", None, None, None)],
                              "seq int, name string, is_company boolean, canonical_name string, ticker string, listing string, theme string, context string")
    r = {x.company: x for x in ts.merge_aliases(c, totals, m).collect()}
    assert set(r) == {"Meta", "xAI"}
    x = r["Meta"]
    assert (x.mentions, x.ticker, x.context, x.listing, x.aliases, x.channels, x.episodes) == (4, "FB", "rich", "x", ["Facebook", "Meta", "meta"], ["c1", "c2"], 2)
    assert x.stance_mix == {"bullish": 2, "bearish": 1} and r["xAI"].ticker == "" and r["xAI"].listing == "unknown"


def test_evidence_is_bounded_and_batched(spark):
    videos = spark.createDataFrame([(f"v{i}", "c", f"2026-01-{i + 1:02d}") for i in range(9)], "video_id string, channel_name string, published string")
    items = spark.createDataFrame([(f"v{i}", ["A"] + [f"E{j}" for j in range(i)], "s", 1, "h", "z" * 400, "t") for i in range(9)], "video_id string, entities array<string>, stance string, t_start int, headline string, body string, type string")
    m = ts.mentions(items, videos)
    totals = ts.entity_totals(m)
    ev = ts.evidence(m, totals, batch=3).collect()
    a = sorted((x for x in ev if x.name == "A"), key=lambda x: x.signal_no)
    assert len(a) == 6 and a[0].batch_no == 0 and all(len(x.body) == 240 for x in a)
    order = sorted(totals.collect(), key=lambda x: (-x.mentions, x.name.lower(), x.name))
    want = {x.name: i // 3 for i, x in enumerate(order)}
    assert {x.name: x.batch_no for x in ts.entity_batches(totals, 3).collect()} == want


def test_recent_keeps_unreadable_dates(spark):
    df = spark.createDataFrame([("2026-01-01",), ("2026-01-20T10:00:00Z",), ("soon",), (None,)], "p string")
    assert sorted(str(x.p) for x in ts.recent(df, "p", 5, F.lit("2026-01-22").cast("timestamp")).collect()) == ["2026-01-20T10:00:00Z", "None", "soon"]
    assert ts.recent(df, "p", 0).count() == 4
