"""Columns of a caller that are named like those an operator needs for itself."""

from tidemark.llm import chunk_dedup, decontamination


def test_cut_texts_keep_the_columns_of_the_caller(spark):
    rows = [(1, "some words " * 40, "a", "b", 7, "x"), (2, "some words " * 40, "c", "d", 8, "y"), (3, None, "e", "f", 9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id string, _text string, _spans int, `_doc` string")
    got = {r.doc_id: r for r in chunk_dedup.without_repeats(df).collect()}
    assert {k: (r["_id"], r["_text"], r["_spans"], r["_doc"]) for k, r in got.items()} == {r[0]: r[2:] for r in rows}
    assert got[1].n_removed == 0 and got[2].n_removed == got[2].n_bytes


def test_clean_texts_keep_the_columns_of_the_caller(spark):
    item = " ".join(f"word{k}" for k in range(30))
    df = spark.createDataFrame([(1, item, "a", 5), (2, "nothing of that", "b", 6)], "doc_id long, text string, _leaks string, _leaks0 int")
    out = decontamination.clean(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(2, "nothing of that", "b", 6)]


def test_each_block_of_a_benchmark_is_a_pass_of_its_own(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    bench = spark.createDataFrame([(i, " ".join(words[i * 20:i * 20 + 20])) for i in range(20)], "item_id long, text string")
    rows = [(i, " ".join(words[i * 20:i * 20 + 60]), i, f"x{i}") for i in range(17)] + [(98, "clean text", 0, "y"), (98, None, 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row long, _leaks string")
    plans, stored = [], decontamination.c.stored
    monkeypatch.setattr(decontamination.c, "stored", lambda d, label: plans.append((label, d._jdf.queryExecution().executedPlan().toString())) or stored(d, label))
    out = decontamination.with_leaks(df, bench, block_words=50)
    assert sum(label == "leaks" for label, _ in plans) >= 8 and all(p.count("MapInArrow") == (label != "documents") for label, p in plans)
    assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
    order = lambda d: sorted((str(r.doc_id), r["_row"], r["_leaks"], sorted(map(tuple, r.leaks))) for r in d.collect())
    assert out.columns == [*df.columns, "leaks"] and order(out) == order(decontamination.with_leaks(df, bench))
    assert {len(r.leaks) for r in out.where("doc_id < 17").collect()} == {3}
