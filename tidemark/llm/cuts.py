"""Byte spans removed from texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import common as c

SPANS = "array<struct<start: bigint, size: bigint>>"


def merged(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the given spans: begins and ends."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + size)[order])
    new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]]) if len(start) else np.zeros(0, np.int64)
    return start[new], end[np.r_[new[1:] - 1, len(end) - 1]] if len(new) else start[new]


def cut(df: DataFrame, spans: str = "spans", text: str = "text", shortest: int = 1) -> DataFrame:
    """``df`` with kept (binary: bytes outside runs of ``shortest`` bytes or more), n_bytes, n_removed and n_spans.

    ``spans`` are structs (start, size) in bytes; null means none.
    """
    fields = [("kept", "binary", pa.binary()), ("n_bytes", "long", pa.int64()), ("n_removed", "long", pa.int64()),
              ("n_spans", "long", pa.int64())]
    rows = df.select(*[F.col(f"`{x}`") for x in df.columns if x not in {f[0] for f in fields}])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != spans]
                       + [f"`{n}` {s}" for n, s, _ in fields])

    def run(batches):
        for batch in batches:
            for part in c.slices(batch, text):
                texts = c.text_array(part.column(part.schema.get_field_index(text)))
                data, at = c.bytes_of(texts)
                raw = data.tobytes()
                lists = part.column(part.schema.get_field_index(spans))
                sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
                flat = lists.flatten()
                begin, size = (np.asarray(flat.field(k), np.int64) for k in (0, 1))
                out: list[list] = [[], [], [], []]
                done = 0
                for i, n in enumerate(sizes.tolist()):
                    own = raw[at[i]:at[i + 1]]
                    removed = runs = 0
                    if n:
                        a, b = merged(begin[done:done + n], size[done:done + n])
                        long = b - a >= shortest
                        a, b = a[long], b[long]
                        removed, runs = int((b - a).sum()), len(a)
                        own = b"".join(own[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(own)]))
                        done += n
                    for column, value in zip(out, (own, int(at[i + 1] - at[i]), removed, runs)):
                        column.append(value)
                names = [x for x in part.schema.names if x != spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(x)) for x in names] + [pa.array(v, f[2]) for v, f in zip(out, fields)],
                    names + [f[0] for f in fields])

    return rows.mapInArrow(c.frugal(run), schema)


def cut_found(df: DataFrame, found: DataFrame, doc: str, text: str, shortest: int = 1) -> DataFrame:
    """``df`` cut by the spans of (doc, text_key, spans): rows are told apart by id and the hash of their text."""
    key, hashed, spans = (c.fresh(x, df) for x in ("_id", "_text", "_spans"))
    found = found.select(F.col("doc").alias("_doc"), F.col("text_key").alias("_key"), "spans")
    keyed = df.withColumns({key: F.coalesce(F.col(doc).cast("long"), F.lit((1 << 63) - 1)), hashed: F.xxhash64(text)})
    joined = keyed.join(found, (keyed[key] == found["_doc"]) & (keyed[hashed] == found["_key"]), "left")
    return cut(joined.select(*[keyed[f"`{x}`"] for x in df.columns], found["spans"].alias(spans)), spans, text, shortest)


def digests(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
