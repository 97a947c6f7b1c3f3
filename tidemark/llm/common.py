"""Helpers of the text operators: Arrow slices, byte-level tokens, connected groups."""

from __future__ import annotations

import ctypes
import gc
import itertools
from collections.abc import Iterator
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import shared_folder

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 4 << 20
SLICE_ROWS = 512

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet to the folder named in ``spark.checkpoint.dir``, and read again.

    A written table outlives lost executors and cuts the lineage of what follows. The shuffle files behind it are
    then needed no more; Spark removes them once the driver has dropped their plans, which a collection brings about.
    """
    path = f"{shared_folder(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    schema, spark = df.schema, df.sparkSession
    release(spark)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove shuffle files and broadcasts that nothing refers to."""
    for _ in range(2):  # what the first one frees lets go of more
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def text_array(column: pa.Array) -> pa.Array:
    """Strings with nulls as empty texts and 64-bit offsets."""
    return column.cast(pa.large_string()).fill_null("")


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = SLICE_BYTES,
           max_rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of at most ``max_bytes`` of text and ``max_rows`` rows; a longer text stands alone."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.diff(offsets_of(text_array(column)))
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > max_bytes or i - start >= max_rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def offsets_of(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large string array in a row, and the offsets of its texts in them."""
    at = offsets_of(texts)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n - 1) modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 1 << 16), BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n]


#: One odd value for each byte, case of A-Z folded.
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))[LOWER] | U64(1)


def words(data: np.ndarray, at: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of ``member`` bytes, and the first word of each text (one more than texts).

    A run never crosses a text boundary.
    """
    inside = member[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    last = at[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, with A-Z folded: a difference of polynomial prefix sums, made position-free and mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse_powers(len(data))[starts] + (ends - starts).astype(np.uint64))


_inverses = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        steps = np.full(max(n, 1 << 16), INVERSE, np.uint64)
        steps[0] = 1
        _inverses = np.multiply.accumulate(steps)
    return _inverses[:n]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the runs starts[i] .. starts[i] + lengths[i] - 1, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, lengths)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list per count over one flat array."""
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=at[1:])
    return pa.LargeListArray.from_arrays(pa.array(at), pa.array(values, type=kind)).cast(pa.list_(kind))


class Forest:
    """Union-find over the longs met so far; keeps the smallest of each group as its root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (y := self.up.get(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            self.up[p] = x
        return x

    def link(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        self.up.setdefault(min(a, b), min(a, b))
        return True

    def edges(self) -> tuple[list[int], list[int]]:
        """One edge from each member that isn't a root to its root."""
        members = [x for x in list(self.up) if self.root(x) != x]
        return members, [self.up[x] for x in members]


EDGE = "a long, b long"
FOREST_LIMIT = 200_000


def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the edges of this partition, sent on whenever it has ``FOREST_LIMIT`` members."""
    forest = Forest()

    def out() -> pa.RecordBatch:
        a, b = forest.edges()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.link(a, b)
        if len(forest.up) > FOREST_LIMIT:
            yield out()
            forest = Forest()
    yield out()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Every round points each node at the smallest label among its neighbours and itself, then lets
    labels follow their own label twice, so long chains shrink by doubling. Edges are first thinned to a spanning
    forest per partition. Rounds are written to the shared folder; nothing is collected but a count of changes.
    """
    edges = stored(edges.select("a", "b").where("a <> b").mapInArrow(thinned, EDGE).distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    for _ in itertools.count():
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node"))
                .agg(F.min("root").alias("near")))
        hooked = near.join(labels, "node").select("node", F.least("near", "root").alias("root"), F.col("root").alias("old"))
        # a root that learns of a smaller label through any of its members takes it over
        up = hooked.groupBy(F.col("old").alias("node")).agg(F.min("root").alias("up"))
        hooked = (hooked.join(up, "node", "left")
                  .select("node", F.least("root", F.coalesce("up", "root")).alias("root"), "old"))
        hooked = stored(hooked, "hooked")
        jump = hooked.select(F.col("node").alias("via"), F.col("root").alias("further"))
        jumped = (hooked.join(jump, hooked["root"] == jump["via"], "left")
                  .select("node", F.least("root", F.coalesce("further", "root")).alias("root"), "old"))
        jumped = stored(jumped, "labels")
        changed = jumped.where("root <> old").limit(1).count()
        labels = jumped.select("node", "root")
        if not changed:
            return labels


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name like ``name`` that none of the tables has, whatever its case."""
    taken = {x.lower() for df in tables for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tidy() -> None:
    """Gives memory that nothing uses back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def frugal(run):
    """``run`` for ``mapInArrow``; a worker that Spark keeps for later tasks holds no memory of this one."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            del batches
            tidy()
    return work


def with_columns(df: DataFrame, text: str, fields: list[tuple[str, str, pa.DataType]], make, max_bytes: int = SLICE_BYTES,
                 max_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with the columns that ``make(texts)`` returns for each slice, as (name, Spark type, Arrow type).

    Columns of those names are replaced. ``make`` is called inside the tasks and gets a large string array.
    """
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in {f[0] for f in fields} or c == text])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema] + [f"`{n}` {s}" for n, s, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, text, max_bytes, max_rows):
                new = work(part.column(part.schema.get_field_index(text)))
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *[f[0] for f in fields]])

    return kept.mapInArrow(frugal(run), schema)
