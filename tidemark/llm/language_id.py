"""Language identification in two steps: the family first, then one against one within it.

Texts become counts of hashed character sequences of one to three bytes (lower case; digits, marks and spaces are one
separator), scaled to unit length. One linear support vector machine per pair of families votes for the
family; one per pair of languages of that family votes for the language. Machines are fitted on a bounded
sample of labelled rows (``PER_LANGUAGE`` texts of each language, chosen by a hash of the id); prediction reads
whole texts and knows nothing else of a document.

Null texts and texts without a letter are ``und`` with score 0. Ties go to the language first in the alphabet.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import common as c

#: Family of each language code.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
}
FAMILY = {lang: family for family, langs in FAMILIES.items() for lang in langs}

SIZE = 4096
#: Text and rows whose counts a task holds at once.
PART_BYTES, PART_ROWS = 1 << 19, 64
PER_LANGUAGE = 1000
#: Most languages that labels may name.
LANGUAGES = 1000
SEPARATOR = np.uint8(32)
FOLD = np.where(c.ALNUM & ~((np.arange(256) >= 48) & (np.arange(256) < 58)), c.LOWER, SEPARATOR).astype(np.uint8)


def features(texts: pa.Array) -> np.ndarray:
    """Unit rows of sequence counts, one per text; zero rows for texts without any byte."""
    data, at = c.bytes_of(pc.utf8_lower(texts))
    data = FOLD[data].astype(np.uint32)
    counts = np.zeros(len(texts) * SIZE)
    sizes = np.diff(at)
    for n, multiplier in enumerate((1, 2654435761, 40503 * 65537), 1):
        gram = data[:max(len(data) - n + 1, 0)].copy()
        for k in range(1, n):
            gram = gram * np.uint32(multiplier % (1 << 32)) + data[k:len(data) - n + 1 + k]
        bucket = ((gram * np.uint32(2246822519)) >> np.uint32(20)).astype(np.int64) % SIZE
        of = np.repeat(np.arange(len(texts)) * SIZE, np.maximum(sizes - n + 1, 0))
        counts += np.bincount(of + bucket[c.ranges(at[:-1], np.maximum(sizes - n + 1, 0))], minlength=len(counts))
    rows = counts.reshape(len(texts), SIZE)
    return rows / np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-12)


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 12, c_value: float = 10.0) -> np.ndarray:
    """Weights and bias of a linear machine (squared hinge, dual coordinate descent); y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diagonal = (x * x).sum(1) + 0.5 / c_value
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / c_value
            new = max(0.0, alpha[i] - g / diagonal[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


class Model:
    """Fitted machines: between families, and between the languages of each."""

    def __init__(self, x: np.ndarray, langs: np.ndarray) -> None:
        self.langs = sorted(set(langs.tolist()))
        family = {lang: FAMILY.get(lang, f"other {lang}") for lang in self.langs}
        self.families = sorted(set(family.values()))
        self.members = {f: [x for x in self.langs if family[x] == f] for f in self.families}
        of = np.array([family[lang] for lang in langs])
        self.pairs = [(a, b) for a, b in combinations(self.families, 2)]
        machines = [fit(x[(of == a) | (of == b)], np.where(of == a, 1.0, -1.0)[(of == a) | (of == b)]) for a, b in self.pairs]
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                here = (langs == a) | (langs == b)
                self.pairs.append((a, b))
                machines.append(fit(x[here], np.where(langs[here] == a, 1.0, -1.0)))
        self.weights = np.array(machines).T if machines else np.zeros((SIZE + 1, 0))

    def vote(self, names: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner of the pairwise votes and the probability its machines give it."""
        votes, chance = np.zeros((len(margins), len(names))), np.ones((len(margins), len(names)))
        for k, (a, b) in enumerate(self.pairs):
            if a in names and b in names:
                p = 1 / (1 + np.exp(-4 * np.clip(margins[:, k], -20, 20)))
                i, j = names.index(a), names.index(b)
                votes[:, i] += (margins[:, k] >= 0) + p * 1e-3
                votes[:, j] += (margins[:, k] < 0) + (1 - p) * 1e-3
                chance[:, i] = np.minimum(chance[:, i], p)
                chance[:, j] = np.minimum(chance[:, j], 1 - p)
        best = votes.argmax(1)
        return best, chance[np.arange(len(margins)), best]

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.langs:
            return np.full(len(texts), "und", object), np.zeros(len(texts))
        margins = features(texts) @ self.weights[:-1] + self.weights[-1]
        family, sure = self.vote(self.families, margins)
        lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
        for k, f in enumerate(self.families):
            here = np.flatnonzero(family == k)
            if len(here):
                best, within = self.vote(self.members[f], margins[here])
                lang[here] = np.array(self.members[f], object)[best]
                score[here] = sure[here] * within
        letter = np.asarray(pc.match_substring_regex(texts, r"\p{L}").fill_null(False))
        lang[~letter], score[~letter] = "und", 0.0
        return lang, score


def trained(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
            per_language: int = PER_LANGUAGE) -> Model:
    """Model fitted on at most ``per_language`` texts of each language; rows without text or language don't count."""
    rows = (labelled.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
            .where("lang is not null and text is not null and doc_id is not null"))
    # of each language the ids of smallest hash: a bound that lets about four times as many through, then their rank
    ids = rows.select("doc_id", "lang", (F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))).alias("_place"))
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages; a machine per pair of them can't be fitted")
    sizes = labelled.sparkSession.createDataFrame(sizes, "lang string, _n long")
    near = ids.join(F.broadcast(sizes), "lang").where(F.col("_place") * F.col("_n") < 4 * per_language)
    rank = Window.partitionBy("lang").orderBy("_place", "doc_id")
    chosen = near.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= per_language).select("doc_id", "lang")
    # at most per_language ids for each of at most LANGUAGES languages
    sample = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select("lang", "text")

    def vectors(batches):
        for batch in batches:
            for part in c.slices(batch, "text", PART_BYTES, PART_ROWS):
                x = features(c.text_array(part.column(1))).astype(np.float32)
                where = np.nonzero(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), c.lists(where[1].astype(np.int32), (x > 0).sum(1), pa.int32()),
                     c.lists(x[where], (x > 0).sum(1), pa.float32())], ["lang", "at", "value"])

    table = sample.mapInArrow(c.frugal(vectors), "lang string, at array<int>, value array<float>").toArrow()
    rows = table.combine_chunks()
    counts = np.asarray(pc.list_value_length(rows["at"]).combine_chunks(), np.int64) if len(rows) else np.zeros(0, np.int64)
    x = np.zeros((len(rows), SIZE), np.float32)
    if len(rows):
        x[np.repeat(np.arange(len(rows)), counts), np.asarray(pc.list_flatten(rows["at"]))] = np.asarray(pc.list_flatten(rows["value"]))
    return Model(x, np.array(rows["lang"].to_pylist(), object))


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and lang_score for each whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = shared.value

        def work(column: pa.Array) -> list[pa.Array]:
            lang, score = fitted.predict(c.text_array(column))
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
        return work

    return c.with_columns(df, text, [("lang_pred", "string", pa.string()), ("lang_score", "double", pa.float64())], make, PART_BYTES, PART_ROWS)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))
