"""Centroid clustering with heap-ordered bounds, exact in integers.

A vector's gap is the distance to its second nearest centroid less that to its nearest. Centroids that move shrink it by no more than
the drift of its own centroid plus the largest drift of any other. Each cluster of a block of vectors keeps its members ordered by gap plus
the drift accumulated when the gap was measured (an ascending array, which is a heap). A round pops those whose key the accumulated drift has
passed, scans them against all centroids, and puts them back; nobody else is looked at, since a positive gap can't have changed the
nearest centroid. Centroids are updated by the sums of vectors that moved.

Vectors are written once, in blocks of ``BLOCK``, as a table bucketed by the task that wrote them; a round joins the blocks with their
heaps (12 bytes a vector) bucket by bucket, without a shuffle, and writes new heaps. Each round reads and writes tables of the shared folder,
so lost executors repeat their own blocks. The driver holds the centroids only, and at most one sum for each.

Vectors count if they have exactly ``size`` components, none null or not finite; others have no row. A component beyond
``LARGEST`` after scaling raises an error, as squared distances would not fit a long. Rows with a null id are assigned but don't start a centroid;
repeated rows count each. Fewer vectors than centroids give fewer centroids, an empty table gives an empty table. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import common as c
from tidemark.session import shared_folder

BLOCK = 1024
#: Blocks that a task holds at once.
BATCH = 64
#: Most buckets of the table of vectors; Spark allows 100,000.
BUCKETS = 50_000
LARGEST = 1 << 27
#: Products of smaller components add up exactly in double precision.
SMALL = 1 << 22
#: A gap this small is scanned again: more than rounding can add up to, and ties are always scanned.
MARGIN = 1e-3

BLOCKS = "shard int, block long, ids array<bigint>, vectors binary"
HEAPS = "shard int, block long, members binary, keys binary, sizes array<int>, popped int, moved array<struct<cluster: int, n: bigint, sums: array<bigint>>>"
MOVED = pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
ROWS = "id long, cluster int, distance long"


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to each centroid."""
    if not x.size or max(np.abs(x).max(), np.abs(centroids).max()) < SMALL:
        products = (x.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
    else:
        products = x @ centroids.T
    return (x * x).sum(1)[:, None] + (centroids * centroids).sum(1)[None, :] - 2 * products


def sums(x: np.ndarray, of: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """How many vectors each cluster has, and their sums."""
    counts, total = np.bincount(of, minlength=k), np.zeros((k, x.shape[1]), np.int64)
    here = np.flatnonzero(counts)
    if len(here):
        total[here] = np.add.reduceat(x[np.argsort(of, kind="stable")], (np.cumsum(counts) - counts)[here])
    return counts, total


@dataclass
class Heaps:
    """Members of each cluster of a block in the order of their keys."""

    members: np.ndarray
    keys: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def empty(k: int) -> Heaps:
        return Heaps(np.zeros(0, np.int32), np.zeros(0), np.zeros(k, np.int64))

    def pop(self, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, Heaps]:
        """Members whose key the drift has passed, their clusters, and the heaps without them."""
        ends = np.cumsum(self.sizes)
        starts = ends - self.sizes
        out = np.array([np.searchsorted(self.keys[a:b], d + MARGIN, "right") for a, b, d in zip(starts, ends, drift)], np.int64)
        gone = c.ranges(starts, out)
        left = np.ones(len(self.members), bool)
        left[gone] = False
        return self.members[gone], np.repeat(np.arange(len(out)), out), Heaps(self.members[left], self.keys[left], self.sizes - out)

    def push(self, members: np.ndarray, keys: np.ndarray, of: np.ndarray) -> Heaps:
        cluster = np.concatenate([self.owners(), of])
        members, keys = np.concatenate([self.members, members.astype(np.int32)]), np.concatenate([self.keys, keys])
        order = np.lexsort((keys, cluster))
        return Heaps(members[order], keys[order], np.bincount(cluster, minlength=len(self.sizes)))

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)


def scan(x: np.ndarray, heaps: Heaps | None, centroids: np.ndarray, drift: np.ndarray) -> tuple[Heaps, np.ndarray, np.ndarray, np.ndarray]:
    """New heaps after one round, and the members scanned with their old (-1: none) and new clusters."""
    k = len(centroids)
    if heaps is None:
        members, old, heaps = np.arange(len(x), dtype=np.int32), np.full(len(x), -1), Heaps.empty(k)
    else:
        members, old, heaps = heaps.pop(drift)
    d = distances(x[members], centroids)
    new = d.argmin(1) if len(members) else np.zeros(0, np.int64)
    each = np.arange(len(members))
    near = np.sqrt(d[each, new].astype(np.float64))
    if k > 1:
        d[each, new] = np.iinfo(np.int64).max
        gap = np.sqrt(d.min(1).astype(np.float64)) - near if len(members) else near
    else:
        gap = np.full(len(members), np.inf)
    return heaps.push(members, gap + drift[new], new), members, old, new


def packed(size: int):
    """Blocks of consecutive vectors of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), itertools.count()
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                x = np.asarray(part.column(1).flatten(), np.int64)
                if len(x) and np.abs(x).max() > LARGEST:
                    raise ValueError(f"a component is larger than {LARGEST} after scaling")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([(shard << 32) + next(number)], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)),
                     pa.array([x.astype("<i4").tobytes()], pa.binary())], ["shard", "block", "ids", "vectors"])
    return run


def joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, int, pa.Array, np.ndarray, Heaps | None]]:
    """Shard, block, ids, vectors and heaps of every block."""
    for batch in batches:
        for k in range(batch.num_rows):
            shard, block, ids, raw, *heap = (batch.column(i)[k] for i in range(batch.num_columns))
            x = np.frombuffer(raw.as_buffer(), "<i4").reshape(-1, size).astype(np.int64)
            heaps = Heaps(np.frombuffer(heap[0].as_buffer(), "<i4"), np.frombuffer(heap[1].as_buffer(), "<f8"), np.array(heap[2].as_py(), np.int64)) if heap else None
            yield shard.as_py(), block.as_py(), ids.values, x, heaps


def round_of(centroids: np.ndarray, drift: np.ndarray):
    """New heaps of each block, and what changes in the sums of the clusters."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, block, _, x, heaps in joined(batches, size):
            heaps, members, old, new = scan(x, heaps, centroids, drift)
            changed = old != new
            counts, total = sums(x[members[changed]], new[changed], k)
            left = changed & (old >= 0)
            fewer, less = sums(x[members[left]], old[left], k)
            here = np.flatnonzero(counts + fewer)
            moved = pa.StructArray.from_arrays(
                [pa.array(here, pa.int32()), pa.array((counts - fewer)[here], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(here) + 1) * size, pa.int32()), pa.array((total - less)[here].ravel()))], fields=list(MOVED))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int64()), pa.array([heaps.members.astype("<i4").tobytes()], pa.binary()),
                 pa.array([heaps.keys.astype("<f8").tobytes()], pa.binary()), pa.array([heaps.sizes.tolist()], pa.list_(pa.int32())),
                 pa.array([len(members)], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(here)], pa.int32()), moved)],
                ["shard", "block", "members", "keys", "sizes", "popped", "moved"])
    return run


def last_round(centroids: np.ndarray, drift: np.ndarray):
    """Cluster and exact squared distance of every vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, ids, x, heaps in joined(batches, centroids.shape[1]):
            heaps = scan(x, heaps, centroids, drift)[0]
            of = np.empty(len(x), np.int32)
            of[heaps.members] = heaps.owners()
            away = x - centroids[of]
            yield pa.RecordBatch.from_arrays([ids, pa.array(of), pa.array((away * away).sum(1))], ["id", "cluster", "distance"])
    return run


@contextmanager
def settings(spark: SparkSession):
    """Few blocks a batch, and joins on a bucketed column without a shuffle."""
    own = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH), "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    before = {key: spark.conf.get(key, None) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in buckets of shards, and read again; the catalogue forgets it at once."""
    spark, name = df.sparkSession, f"heap_clusters_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "shard").option("path", f"{shared_folder(spark)}/llm/{name}").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


@dataclass
class Fitted:
    rows: DataFrame
    centroids: np.ndarray
    #: Vectors scanned against all centroids in each round but the last, and how many there are.
    scanned: list[int]
    n: int


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = 40, rounds: int = 5, size: int = 64,
        scale: int = 256, seed: int = 2) -> Fitted:
    """Clusters after ``rounds`` updates: rows (id, cluster, distance), written to the shared folder.

    Components become floor(scale * x). The vectors of smallest sha256 of ``seed:id`` start the centroids.
    """
    spark = df.sparkSession
    x = F.col("v")
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))
    rows = (df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
            .where((F.size(x) == size) & F.forall(x, finite)).select("id", F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e)).alias("v")))
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = rows.where("id is not null").orderBy(place, "v").limit(clusters).select("v").collect()
    if not starts:
        return Fitted(spark.createDataFrame([], ROWS), np.zeros((0, size), np.int64), [], 0)
    centroids = np.array([r.v for r in starts], np.int64)
    k, drift, counts, totals = len(centroids), np.zeros(len(centroids)), [0] * len(centroids), [[0] * size for _ in starts]
    buckets = min(max(rows.rdd.getNumPartitions(), 1), BUCKETS)
    scanned, heaps = [], None
    with settings(spark):
        vectors = bucketed(rows.mapInArrow(packed(size), BLOCKS), buckets)

        def blocks() -> DataFrame:
            return vectors if heaps is None else vectors.join(heaps.select("shard", "block", "members", "keys", "sizes"), ["shard", "block"])

        for _ in range(rounds):
            heaps = bucketed(blocks().mapInArrow(round_of(centroids, drift), HEAPS), buckets)
            moved = heaps.select(F.explode("moved").alias("m")).groupBy("m.cluster").agg(
                F.sum("m.n").alias("n"), F.array(*[F.sum(F.col("m.sums")[i]) for i in range(size)]).alias("sums")).collect()
            scanned.append(heaps.agg(F.sum("popped")).first()[0])
            for r in moved:
                counts[r.cluster] += r.n
                totals[r.cluster] = [a + b for a, b in zip(totals[r.cluster], r.sums)]
            after = np.array([[t // n for t in total] if n else old.tolist() for total, n, old in zip(totals, counts, centroids)], np.int64)
            far = np.sqrt(((after - centroids).astype(np.float64) ** 2).sum(1))
            others = np.array([max(np.delete(far, j), default=0.0) for j in range(k)])
            centroids, drift = after, drift + far + others
        out = c.stored(blocks().mapInArrow(last_round(centroids, drift), ROWS), "clusters")
    return Fitted(out, centroids, scanned, sum(counts))


def clusters(df: DataFrame, key: str = "vec_id", vector: str = "embedding", **parameters: int) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts; parameters as in ``fit``."""
    spark, fitted = df.sparkSession, fit(df, key, vector, **parameters)
    names = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in fitted.centroids.tolist()]
    own = fitted.rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()  # a row per centroid at most
    inertia = sum(r.d for r in own)
    table = spark.createDataFrame([(r.cluster, r.d, inertia, names[r.cluster]) for r in own],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return fitted.rows.join(F.broadcast(table), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
