"""Token files: ids of all documents in ascending id order, with Elias-Fano coded boundaries.

A file set is a table of segments. Segment k of shard s holds the ids of some documents in a row as
little-endian integers of 2 or 4 bytes, and the ends of its documents as an Elias-Fano sequence: the low bits of each
end packed tightly, the high bits in unary, and the place of every 256th one-bit, from which ``select`` finds
any end by looking at a few words. That is about 2 + log2(ids per document) bits per document; no 64-bit offset
is stored. Document ids, ascending, are coded the same way. Shards are ranges of document ids, so shards and
segments in order are the whole sequence in order.

Spark writes the segments, so a lost task is repeated and a half written shard never seen.
Null texts have no ids but the end id. Rows without a document id sort first and keep their order by text.
"""

from __future__ import annotations

from functools import lru_cache
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm import common as c

STEP = 256
SEGMENT_IDS = 1 << 21
KNOWN = 800_000
INSIDE = ~c.SPACES
LETTER, MARK = 1, 2
#: Letters and marks of ASCII; 0 for digits, the apostrophe and all else.
KIND = np.array([LETTER if chr(b).isalpha() else MARK if 32 < b < 127 and chr(b) not in "'0123456789" else 0 for b in range(128)] + [0] * 128, np.uint8)


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes) -> None:
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        last = int(values[-1]) if n else 0
        bits = max(0, (last // n).bit_length() - 1) if n else 0
        low = values & np.uint64((1 << bits) - 1)
        planes = ((low[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        pack = lambda x: np.packbits(x, bitorder="little").tobytes()
        return cls(n, bits, pack(planes.ravel()), pack(unary), ones[::STEP].astype("<u4").tobytes())

    def parts(self) -> tuple:
        return self.n, self.low_bits, self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()

    def select(self, i: int) -> int:
        """Value i: from the nearest sampled one-bit on, bytes are counted until the wanted one."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // STEP]), i % STEP
        byte = at // 8
        word = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (k := word.bit_count()) <= left:
            left -= k
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        start, low = i * self.low_bits, 0
        for k in range(self.low_bits):
            low |= (int(self.low[(start + k) // 8]) >> ((start + k) % 8) & 1) << k
        return (place - i) << self.low_bits | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        planes = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = (planes.astype(np.int64) << np.arange(self.low_bits)).sum(1)
        return ((ones - np.arange(self.n)) << self.low_bits) + low


class Numbered(dict):
    """Numbers keys as they are first asked for; ``taken`` gives the new ones since the last call."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number

    def taken(self) -> list[str]:
        new, self.new = self.new, []
        return new


def parted(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Parts of the texts of a large string array: distinct ones, the place of each among them, the number of parts before each text's end, and
    which distinct ones are words.

    A run between ASCII white space of Latin letters with ASCII marks behind (no apostrophe) is a word, its letters in lower case, and its marks. Any
    other run is one part as it is.
    """
    data, at = c.bytes_of(texts)
    starts, ends, first = c.words(data, at, INSIDE)
    data, bounds = data[INSIDE[data]], np.concatenate([[0], np.cumsum(ends - starts)])
    kind, begins = KIND[data], np.zeros(len(data) + 1, bool)
    begins[bounds] = True
    lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF, of which two are signs
    lead = lead[(data[lead + 1] & 0x5F) != 0x17]
    kind[lead] = kind[lead + 1] = LETTER
    behind, begin = np.concatenate([[0], kind[:-1]]), begins[:-1]
    odd = (kind == 0) | (begin & (kind == MARK)) | (~begin & (kind == LETTER) & (behind == MARK))
    plain = np.repeat(np.diff(np.concatenate([[0], np.cumsum(odd)])[bounds]) == 0, np.diff(bounds))
    begins[:-1] |= plain & (kind == MARK) & (behind == LETTER)
    upper = lead[plain[lead] & (data[lead + 1] < 0x9F)] + 1
    data = np.where(plain, c.LOWER[data], data)
    data[upper] += 32
    places = np.flatnonzero(begins[:-1])
    parts = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(np.append(places, len(data))), pa.py_buffer(data)).dictionary_encode()
    codes, words = np.asarray(parts.indices), np.zeros(len(parts.dictionary), bool)
    words[codes] = (plain & (kind == LETTER))[places]
    return parts.dictionary, codes, np.searchsorted(places, bounds[first[1:]]), words


class WordEncoder:
    """Ids by the tokenizers library, each distinct part of the runs between ASCII white space encoded once.

    The tokenizer drops white space, merges nothing across it, and parts letters from marks. So a text's ids are those of its
    parts in a row, see ``parted``. Words go to the library many at a time: the last id of each is one that ends a word.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.joint = all(self.ends[self.ids(w)].sum() == 1 and self.ends[self.ids(w)[-1]] for w in ("a", "zqéxk", "ÿj"))
        self.clear()

    def clear(self) -> None:
        self.known = Numbered()
        self.flat, self.at, self.count = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def learn(self, parts: list[str], words: np.ndarray) -> None:
        """Ids of the new parts: of words many at a time, of others one by one."""
        ids = [self.flat]
        counts = np.zeros(len(parts), np.int64)
        alone, order = np.flatnonzero(~words).tolist(), []
        words = np.flatnonzero(words)
        for k in range(0, len(words), 2000):
            some = words[k:k + 2000]
            joint = np.array(self.ids(" ".join([parts[i] for i in some])), np.uint32)
            cuts = np.flatnonzero(self.ends[joint]) + 1
            if self.joint and len(cuts) == len(some):
                ids.append(joint)
                counts[some] = np.diff(cuts, prepend=0)
                order.append(some)
            else:
                alone += some.tolist()
        for i in alone:
            ids.append(np.array(self.ids(parts[i]), np.uint32))
            counts[i] = len(ids[-1])
        order = np.concatenate([*order, alone]).astype(np.int64)
        at = np.zeros(len(parts), np.int64)
        at[order] = len(self.flat) + np.cumsum(counts[order]) - counts[order]
        self.at, self.count = np.concatenate([self.at, at]), np.concatenate([self.count, counts])
        self.flat = np.concatenate(ids)

    def __call__(self, texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a string array in a row, and where those of each text end."""
        if len(self.known) > KNOWN:
            self.clear()
        parts, codes, ends, words = parted(c.text_array(texts))
        before = len(self.known)
        numbers = np.fromiter(map(self.known.__getitem__, parts.to_numpy(zero_copy_only=False)), np.int64, len(parts))
        if new := self.known.taken():
            self.learn(new, words[numbers >= before])
        pieces = numbers[codes]
        width = self.count[pieces]
        values = self.flat[c.ranges(self.at[pieces], width)]
        ends = np.concatenate([[0], np.cumsum(width)])[ends]
        if end is not None:
            values = np.insert(values, ends, end)
            ends = ends + np.arange(1, len(ends) + 1)
        return values, ends


@lru_cache(1)
def encoder_of(path: str, job: str) -> WordEncoder:
    """The encoder that a worker keeps for its next tasks of one ``write``, with at most ``KNOWN`` parts and those of a slice."""
    return WordEncoder(path)


SEGMENT = ("shard int, segment int, ids_before long, first_doc long, n_docs long, n_ids long, id_bytes int, ids binary, "
           "end_low_bits int, end_low binary, end_high binary, end_samples binary, "
           "doc_low_bits int, doc_low binary, doc_high binary, doc_samples binary, null_docs int")
COLUMNS = [x.split()[0] for x in SEGMENT.split(", ")]


def segment(shard: int, number: int, before: int, docs: list[int | None], values: np.ndarray, ends: np.ndarray, width: int) -> tuple:
    held = np.array([d for d in docs if d is not None], np.int64)
    first = int(held[0]) if len(held) else 0
    bounds, names = EliasFano.of(ends), EliasFano.of(held - first)
    return (shard, number, before, first, len(docs), len(values), width, values.astype("<u2" if width == 2 else "<u4").tobytes(),
            *bounds.parts()[1:], *names.parts()[1:], len(docs) - len(held))


def write(df: DataFrame, tokenizer: str, path: str, end: int | None = None, doc: str = "doc_id", text: str = "text",
          shards: int | None = None, compression: str = "zstd") -> None:
    """Encodes the texts and writes their file set to ``path``, in ascending order of ``doc``."""
    columns = df.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("text"))
    job = uuid.uuid4().hex
    n = shards or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = columns.repartitionByRange(n, "doc").sortWithinPartitions("doc", "text")

    def run(batches):
        encoder = encoder_of(tokenizer, job)
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end or 0) <= 1 << 16 else 4
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        docs, values, ends, held = [], [], [], 0

        def out():
            row = segment(shard, number, before, docs, np.concatenate(values), np.concatenate(ends), width)
            return pa.RecordBatch.from_pylist([dict(zip(COLUMNS, row))], schema=ARROW)

        for batch in batches:
            for part in c.slices(batch, "text"):
                v, e = encoder(part.column(1), end)
                docs += part.column(0).to_pylist()
                values.append(v)
                ends.append(e + held)
                held += len(v)
                if held >= SEGMENT_IDS:
                    yield out()
                    docs, values, ends, held, number, before = [], [], [], 0, number + 1, before + held
        if docs:
            yield out()

    (ordered.mapInArrow(run, SEGMENT).write.option("compression", compression).option("parquet.block.size", 1 << 22)
     .parquet(path))


ARROW = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[k])
                   for n, k in (x.split() for x in SEGMENT.split(", "))])


def decoded(row: dict) -> tuple[list[int | None], np.ndarray, EliasFano]:
    """Document ids, ids and boundaries of one segment."""
    names = EliasFano(row["n_docs"] - row["null_docs"], row["doc_low_bits"], row["doc_low"], row["doc_high"], row["doc_samples"])
    bounds = EliasFano(row["n_docs"], row["end_low_bits"], row["end_low"], row["end_high"], row["end_samples"])
    docs = [None] * row["null_docs"] + (names.all() + row["first_doc"]).tolist()
    return docs, np.frombuffer(row["ids"], "<u2" if row["id_bytes"] == 2 else "<u4"), bounds


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a file set, in any order.

    A segment knows the ids before it in its shard; the start of a shard is a running sum over one row per shard.
    """
    files = spark.read.parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    placed = files.join(F.broadcast(shards), "shard")  # as many rows as the writing job had partitions

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                docs, ids, bounds = decoded(row)
                ends = bounds.all()
                starts = np.r_[0, ends[:-1]]
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(starts + row["shard_start"] + row["ids_before"], pa.int64()),
                     pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
