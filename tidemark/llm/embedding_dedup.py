"""Embedding near-duplicates by randomised-rotation binary codes.

A unit vector is turned by one random rotation for its length, and kept as the signs of its coordinates, a bit each. With the sign
vector scaled to unit length, ``a`` is its inner product with the turned vector: the stored correction factor. For a second vector q,
<q, signs> / a is an unbiased estimate of the cosine, off by at most sqrt(1 - a^2) / a times the part of q across the
signs. That part is within sqrt(1 - t^2) for pairs at the threshold t, and within ``WIDTH`` / sqrt(d - 1) but for a
vanishing chance; the smaller is the bound. Pairs whose estimate plus bound stays under the threshold are dismissed,
the others are computed again from the vectors themselves in double precision.

Only rows of equal label and length meet. Rows of a label are cut into blocks of about ``BLOCK`` and pairs of blocks are compared in
tasks of their own, so a label with a third of all rows is many tasks. A task returns a count of links per row
and a spanning forest of its links, never pairs. Work grows with the square of a label's rows, codes and factors being what
is looked at.

Null, zero, non-finite vectors and such with a null component link with nothing, as do rows with a null label. Rows of equal id are
different vectors. Rows without an id link, but name no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import common as c

THRESHOLD = 0.98
WIDTH = 6.0
BLOCK = 2048
STEP = 256


@lru_cache(maxsize=4)
def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(20240501).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def coded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the turned unit vectors, and their correction factors."""
    d = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    turned = unit @ rotation(d)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / np.sqrt(d)


def with_codes(df: DataFrame) -> DataFrame:
    """(row, label, dim, vector, code, factor) of the rows of (row, label, embedding) that can link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            size = np.asarray(lists.value_lengths(), np.int64)
            flat = np.asarray(lists.flatten(), np.float64)
            at = np.cumsum(size) - size
            for d in np.unique(size).tolist():
                rows = np.flatnonzero(size == d)
                code, factor = coded(flat[at[rows][:, None] + np.arange(d)])
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(len(rows), d, np.int32)), lists.take(take),
                     pa.array([x.tobytes() for x in code], pa.binary()), pa.array(factor)],
                    ["row", "label", "dim", "vector", "code", "factor"])

    value = F.col("embedding")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = df.where(F.col("label").isNotNull() & value.isNotNull() & ~bad & F.exists(value, lambda x: x != 0))
    return usable.mapInArrow(run, "row long, label long, dim int, vector array<double>, code binary, factor double")


def near(left: tuple, right: tuple, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs at or over the threshold; left and right are (vectors, codes, factors)."""
    x, y = left[0], right[0]
    d = x.shape[1]
    turned = (x / np.linalg.norm(x, axis=1, keepdims=True) @ rotation(d)).astype(np.float32)
    signs = np.unpackbits(right[1], axis=1, count=d).astype(np.float32) * 2 - 1
    slope = np.sqrt(np.maximum(1 - right[2] ** 2, 0)) / right[2]
    half = slope * min(WIDTH / np.sqrt(max(d - 1, 1)), np.sqrt(1 - threshold ** 2)) + 1e-5  # and what single precision loses
    least = ((threshold - half) * right[2] * np.sqrt(d)).astype(np.float32)
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    for k in range(0, len(x), STEP):
        i, j = np.nonzero(turned[k:k + STEP] @ signs.T >= least)
        i += k
        keep = np.concatenate([np.einsum("ij,ij->i", x[i[a:a + 65536]], y[j[a:a + 65536]]) / (nx[i[a:a + 65536]] * ny[j[a:a + 65536]]) >= threshold
                               for a in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
        yield i[keep], j[keep]


def found(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, n): n links of row a (b null), or an edge between rows a and b (n null)."""
    rows = with_codes(df)
    sizes = rows.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    rows = rows.join(sizes, ["label", "dim"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    tasks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda m: F.struct(
        F.least(m, F.col("block")).alias("low"), F.greatest(m, F.col("block")).alias("high"), (m < F.col("block")).alias("side")))
    rows = rows.withColumn("task", F.explode(tasks)).select("label", "dim", "task.*", "row", "vector", "code", "factor")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[2].as_py(), key[3].as_py()
        table = table.combine_chunks()
        column = lambda name: table[name].chunk(0)
        d = key[1].as_py()
        names = np.asarray(column("row"), np.int64)
        vectors = np.asarray(column("vector").flatten(), np.float64).reshape(-1, d)
        codes = np.frombuffer(b"".join(column("code").to_pylist()), np.uint8).reshape(len(names), -1)
        factors = np.asarray(column("factor"), np.float64)
        side = np.asarray(column("side"), bool)
        here = lambda m: (vectors[m], codes[m], factors[m])
        a, b = (np.flatnonzero(~side), np.flatnonzero(side)) if low != high else (np.arange(len(names)),) * 2
        links = np.zeros(len(names), np.int64)
        forest = c.Forest()
        for i, j in near(here(a), here(b), threshold):
            i, j = a[i], b[j]
            keep = i != j
            i, j = i[keep], j[keep]
            links += np.bincount(i, minlength=len(names))
            if low != high:
                links += np.bincount(j, minlength=len(names))
            for p, q in zip(names[i].tolist(), names[j].tolist()):
                forest.link(p, q)
        x, y = forest.edges()
        linked = np.flatnonzero(links)
        return pa.table({"a": pa.array(np.r_[names[linked], np.array(x, np.int64)]),
                         "b": pa.array([None] * len(linked) + y, pa.int64()),
                         "n": pa.array(links[linked].tolist() + [None] * len(x), pa.int64())})

    return rows.groupBy("label", "dim", "low", "high").applyInArrow(compare, "a long, b long, n long")


def groups(df: DataFrame, threshold: float = THRESHOLD, vec: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = c.stored(df.select(F.monotonically_increasing_id().alias("row"), F.col(vec).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                              F.col(vector).cast("array<double>").alias("embedding")), "vectors")
    hits = c.stored(found(rows.select("row", "label", "embedding"), threshold), "links")
    counts = hits.where("b is null").groupBy(F.col("a").alias("linked")).agg(F.sum("n").alias("n_links"))
    roots = c.components(hits.where("b is not null").select("a", "b"))
    rows = rows.select("row", "vec_id")
    rows = rows.join(roots, rows["row"] == roots["node"], "left").select("row", "vec_id", F.coalesce("root", "row").alias("root"))
    least = rows.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    rows = rows.join(least, "root").join(counts, F.col("row") == F.col("linked"), "left")
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                       F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
