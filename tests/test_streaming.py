import json

from pyspark.sql import functions as F

from tidemark.streaming import ticks as tk


def land(folder, name, *frames):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(f) if not isinstance(f, str) else f for f in frames))


def tick(key, ltp, ts, kind="ltpc", **more):
    ltpc = {"ltp": ltp, "ltt": 1, "ltq": 2, "cp": 9.0}
    union = {"ltpc": ltpc} if kind == "ltpc" else {kind: {"ltpc": ltpc, **more}}
    return {"type": "live_feed", "ts": ts, "feeds": {key: union}}


T0, T1, T2 = "2026-08-20 10:00:00.000", "2026-08-20 10:00:00.050", "2026-08-20 10:00:01.000"


def stream(spark, folder):
    return spark.readStream.text(str(folder))


def test_decode_kinds_and_late_tick_does_not_win(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(src, "a.json", tick("A", 10.0, T2), tick("B", 5.0, T0, "marketFF", vtt=7, oi=3.0), tick("I", 1.0, T0, "indexFF"), "not json",
         {"type": "market_info", "ts": T0, "segmentStatus": {"NSE": "NORMAL_OPEN", "MCX": "CLOSING_END", "CDS": "PRE_OPEN_START"}})
    tk.drain(lambda: tk.vintage_sink(tk.last_value(tk.decode(stream(spark, src))), out, state, None))
    land(src, "b.json", tick("A", 99.0, T1), tick("B", 6.0, T2, "marketFF", vtt=8))
    tk.drain(lambda: tk.vintage_sink(tk.last_value(tk.decode(stream(spark, src))), out, state, None))
    hot = {r.instrument_key: r for r in tk.read_vintages(spark, out, ["instrument_key"]).collect()}
    assert (hot["A"].ltp, hot["A"].ticks_seen) == (10.0, 2)          # the late tick is counted but older
    assert (hot["B"].ltp, hot["B"].volume) == (6.0, 8) and hot["I"].ltp == 1.0
    raw = spark.read.text(str(src))
    assert {r.segment for r in tk.open_segments(tk.market_info(raw)).collect()} == {"NSE", "CDS"}
    s = tk.feed_status(tk.decode(raw), F.lit("2026-08-20 10:00:31").cast("timestamp")).first()
    assert (s.ticks_seen, s.last_tick_age_seconds) == (5, 30)


def test_cold_sink_resumes_without_duplicates(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(src, "a.json", tick("A", 1.0, T0), tick("A", 1.0, T0))
    start = lambda: tk.cold_sink(tk.deduplicate(tk.decode(stream(spark, src))), out, state, None)
    tk.drain(start)
    land(src, "b.json", tick("A", 1.0, T0), tick("A", 2.0, T2))
    tk.drain(start)
    tk.drain(start)
    rows = spark.read.parquet(out).collect()
    # a tick is known from the day it was stored, and its vintage is its batch
    assert sorted(r.ltp for r in rows) == [1.0, 2.0] and all(r.knowledge_date >= r.ts.date() for r in rows)
    assert max(r._vintage_id for r in rows) > min(r._vintage_id for r in rows) == 0


def test_nested_feeds_epoch_times_and_rejects(spark):
    depth = {"ltpc": {"ltp": 5.0, "ltt": 1, "ltq": 2, "cp": 4.0}, "vtt": 7, "oi": 8.0, "atp": 4.5, "iv": 0.2, "tbq": 10, "tsq": 11}
    frame = lambda ts, feeds: json.dumps({"type": "live_feed", "ts": ts, "feeds": feeds})
    raw = spark.createDataFrame([(x,) for x in (
        frame("1704067200", {"A": {"fullFeed": {"marketFF": depth}}}), frame("1704067200000", {"B": {"fullFeed": {"indexFF": {"ltpc": {"ltp": 6.0}}}}}),
        frame("2024-01-01 00:00:00", {"C": {"ltpc": {"ltp": 7.0}}}), frame("soon", {"D": {"ltpc": {"ltp": 8.0}}}), frame("1704067200", {"E": {"x": 1}}), "no json")], "value string")
    got = {r.instrument_key: r for r in tk.decode(raw).collect()}
    assert set(got) == {"A", "B", "C"} and len({r.ts for r in got.values()}) == 1
    assert (got["A"].iv, got["A"].total_buy_qty, got["A"].total_sell_qty, got["A"].volume) == (0.2, 10.0, 11.0, 7) and got["B"].ltp == 6.0
    assert sorted(r.reason for r in tk.rejects(raw).collect()) == ["no known feed", "no readable time", "not a frame"]
    flat = spark.createDataFrame([('{"token": "1", "ltp": "2", "ts": "1704067200.5"}',), ('{"token": "1", "ltp": "2", "ts": "bad"}',)], "value string")
    assert [str(r.ts) for r in tk.flat_ticks(flat).collect()] == ["2024-01-01 00:00:00.500000"]


def test_coalescing_keeps_the_last_of_each_window(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    land(src, "a.json", tick("A", 1.0, T0), tick("A", 2.0, T1), tick("A", 3.0, T2), tick("B", 4.0, T0))
    tk.drain(lambda: tk.vintage_sink(tk.coalesced(tk.decode(stream(spark, src))), out, state, None))
    r = sorted((x.instrument_key, x.ltp, x.n) for x in tk.read_vintages(spark, out, ["window_start", "instrument_key"]).collect())
    assert r == [("A", 2.0, 2), ("A", 3.0, 1), ("B", 4.0, 1)]


def test_enrich_subscribe_and_flat_records(spark, tmp_path):
    src = tmp_path / "in"
    land(src, "a.json", tick("NSE_EQ|X", 1.0, T0), tick("NSE_EQ|Y", 2.0, T0))
    prices = spark.createDataFrame([("XCO", "X"), ("XCO", "X"), ("Z", None)], "symbol string, isin string")
    t = tk.decode(spark.read.text(str(src)))
    assert {(r.instrument_key, r.symbol) for r in tk.enrich(t, tk.symbol_keys(prices)).collect()} == {("NSE_EQ|X", "XCO"), ("NSE_EQ|Y", None)}
    assert tk.subscribe(t, ["NSE_EQ|Y"]).count() == 1
    flat = spark.createDataFrame([('{"token": 5, "ltp": 1.5, "volume": 7, "oi": null, "ts": "2026-08-20 10:00:00"}',), ("x",)], "value string")
    r = tk.flat_ticks(flat).collect()
    assert [(x.instrument_key, x.ltp, x.volume, x.oi) for x in r] == [("5", 1.5, 7, None)]


def test_last_values_are_one_row_per_key_however_many_batches(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    start = lambda: tk.keyed_sink(tk.last_value(tk.decode(stream(spark, src))), out, state, ["instrument_key"], None, 2)
    for k in range(6):  # each run is a restart from the checkpoint
        land(src, f"{k}.json", tick("A", float(k), f"2026-08-20 10:00:0{k}.000"), tick(f"K{k}", 1.0, T0), tick("B", 50.0 - k, f"2026-08-20 09:00:0{5 - k}.000"))
        tk.drain(start)
        hot = {r.instrument_key: r for r in tk.read_keyed(spark, out).collect()}
        assert len(hot) == k + 3 == tk.read_keyed(spark, out).count()
        assert (hot["A"].ltp, hot["A"].ticks_seen, hot["B"].ltp) == (float(k), k + 1, 50.0)  # later batches bring B's earlier ticks
    versions = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert len(versions) == tk.VERSIONS_KEPT and all(len(list((tmp_path / "out" / v).glob("part-*"))) <= 2 for v in versions)


def test_a_batch_that_runs_again_gives_the_same_version(spark, tmp_path):
    """A version that was left incomplete, or written but not committed, is written again from the version before it."""
    src, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    start = lambda: tk.keyed_sink(tk.last_value(tk.decode(stream(spark, src))), out, str(state), ["instrument_key"], None)
    land(src, "a.json", tick("A", 1.0, T0))
    tk.drain(start)
    land(src, "b.json", tick("A", 2.0, T1), tick("B", 3.0, T1))
    tk.drain(start)
    want = sorted(map(tuple, tk.read_keyed(spark, out).collect()))
    newest = sorted(p.name for p in (tmp_path / "out").iterdir())[-1]
    (tmp_path / "out" / newest / "_SUCCESS").unlink()
    assert [r.ltp for r in tk.read_keyed(spark, out).collect()] == [1.0]  # readers pass over it
    last = max(int(p.name) for p in (state / "commits").iterdir() if p.name.isdigit())
    for p in (state / "commits").iterdir():
        if p.name.strip(".").removesuffix(".crc") == str(last):
            p.unlink()
    tk.drain(start)
    assert sorted(map(tuple, tk.read_keyed(spark, out).collect())) == want and sorted(p.name for p in (tmp_path / "out").iterdir())[-1] == newest


def test_symbols_added_between_batches_are_seen(spark, tmp_path):
    src, out, state, keys = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "prices")
    prices = lambda rows: spark.createDataFrame(rows, "symbol string, isin string").write.mode("append").parquet(keys)
    prices([("ONE", "I1")])
    land(src, "a.json", tick("NSE_EQ|I1", 1.0, T0), tick("NSE_EQ|I2", 1.0, T0))
    q = tk.enriched_sink(tk.decode(stream(spark, src)), lambda s: tk.symbol_keys(s.read.parquet(keys)), out, state, "100 milliseconds")
    try:
        q.processAllAvailable()
        prices([("TWO", "I2")])  # while the stream runs
        land(src, "b.json", tick("NSE_EQ|I2", 2.0, T1), tick("NSE_EQ|I3", 2.0, T1))
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.instrument_key, r.ltp, r.symbol) for r in spark.read.parquet(out).collect())
    assert got == [("NSE_EQ|I1", 1.0, "ONE"), ("NSE_EQ|I2", 1.0, None), ("NSE_EQ|I2", 2.0, "TWO"), ("NSE_EQ|I3", 2.0, None)]
