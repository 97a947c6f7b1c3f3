"""Centroid clustering against whole scans in Python's integers."""

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import heap_clusters as h, queries

SF = "/root/testdata/sf0.001"


def by_hand(rows, clusters=40, rounds=5, size=64):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in order[:clusters]]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min(range(len(centroids)), key=lambda j: (d2(v, centroids[j]), j)) for _, v in kept]

    for _ in range(rounds):
        of = assign()
        for j in range(len(centroids)):
            own = [v for (_, v), a in zip(kept, of) if a == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own)]
    of = assign()
    away = [d2(v, centroids[a]) for (_, v), a in zip(kept, of)]
    name = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted((-1 if i is None else i, a, d, sum(x for x, b in zip(away, of) if b == a), sum(away), name(centroids[a])) for (i, _), a, d in zip(kept, of, away))


def got(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


@pytest.mark.parametrize("block", [1024, 7])
def test_against_whole_scans(spark, monkeypatch, block):
    monkeypatch.setattr(h, "BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 5)) * 3
    rows = [(k, (centres[k % 6] + rng.standard_normal(5) * rng.choice([0.05, 0.5])).tolist()) for k in range(300)]
    rows += [(300 + k, rows[k][1]) for k in range(40)] + [(400 + k, [0.0] * 5) for k in range(9)] + [(0, rows[0][1]), (0, rows[5][1])]
    rows += [(500, None), (501, [1.0] * 4), (502, [float("nan")] * 5), (503, [1.0, None, 1.0, 1.0, 1.0]), (504, [float("-inf")] * 5), (505, []), (None, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], "vec_id long, embedding array<double>, cluster string, id int").repartition(4)
    for clusters in (1, 2, 8, 40):
        out = h.clusters(df, clusters=clusters, rounds=4, size=5)
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert got(out) == by_hand(rows, clusters, 4, 5)


def test_ties_few_rows_and_large_components(spark):
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 0.0]), (4, [0.0, 1.0]), (5, [0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(h.clusters(df, clusters=2, rounds=3, size=2)) == by_hand(rows, 2, 3, 2)
    assert got(h.clusters(df, clusters=40, rounds=3, size=2)) == by_hand(rows, 40, 3, 2)
    large = [(k, [100_000.0 * (k % 5), -300_000.5 + k]) for k in range(30)]
    assert got(h.clusters(spark.createDataFrame(large, df.schema), clusters=3, size=2)) == by_hand(large, 3, 5, 2)
    with pytest.raises(Exception, match="larger than"):
        h.clusters(spark.createDataFrame([(1, [1e9, 0.0])], df.schema), size=2).count()
    assert h.clusters(df.where("false"), size=2).count() == 0


def test_later_rounds_scan_fewer_and_shuffle_no_vectors(spark):
    fitted = h.fit(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert fitted.scanned[0] == fitted.n == fitted.rows.count() and fitted.scanned[-1] < fitted.n
    with h.settings(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            blocks = h.bucketed(spark.range(8, numPartitions=3).selectExpr("cast(id % 3 as int) shard", "id block", "array(id) ids", "cast('' as binary) vectors"), 3)
            heaps = h.bucketed(spark.range(8, numPartitions=3).selectExpr("cast(id % 3 as int) shard", "id block", "1 as x"), 3)
            both = blocks.join(heaps, ["shard", "block"])
            assert both.count() == 8 and "Exchange hashpartitioning" not in both._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(queries.QUERIES["op11_heap_clusters"](spark, SF)) == by_hand(rows)
