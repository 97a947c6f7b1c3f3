"""Isolation forest (Liu, Ting and Zhou 2008) as Spark jobs.

Each tree is grown from its own subsample of at most 256 rows, which is what the method
prescribes, so growing is one small grouped task per tree. The forest (100 trees of at
most 511 nodes) has a fixed size whatever the number of rows, and is shipped to the tasks
that score the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import exact_quantile, require_rows
from tidemark.session import materialise

# Features and settings of the screen.
FEATURES = ("beta", "momentum_zscore", "notional_zscore", "change_pct_points")
CONTAMINATION, SEED, MIN_SYMBOLS = 0.05, 42, 30
TREES, SAMPLE = 100, 256

NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, depth int, size int"


def path_correction(n: np.ndarray | float) -> np.ndarray:
    """Mean unsuccessful search length in a tree of n points."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        c = 2.0 * (np.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, c))


def grow_tree(x: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Nodes (node, feature, split, left, right, depth, size) of one isolation tree."""
    limit = int(math.ceil(math.log2(max(len(x), 2))))
    nodes: list[tuple] = []
    stack = [(0, np.arange(len(x)), 0)]
    used = 1
    while stack:
        node, rows, depth = stack.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.nonzero(high > low)[0]
        if depth >= limit or len(rows) <= 1 or len(open_features) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth, len(rows)))
            continue
        f = int(rng.choice(open_features))
        split = float(rng.uniform(low[f], high[f]))
        below = part[:, f] <= split
        nodes.append((node, f, split, used, used + 1, depth, len(rows)))
        stack.append((used, rows[below], depth + 1))
        stack.append((used + 1, rows[~below], depth + 1))
        used += 2
    return nodes


def path_lengths(forest: list[pd.DataFrame], x: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for t in forest:
        feature, split = t["feature"].to_numpy(), t["split"].to_numpy()
        left, right = t["left"].to_numpy(), t["right"].to_numpy()
        leaf_len = t["depth"].to_numpy() + path_correction(t["size"].to_numpy())
        at = np.zeros(len(x), dtype=int)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            go_left = x[np.arange(len(x)), np.maximum(f, 0)] <= split[at]
            at = np.where(inner, np.where(go_left, left[at], right[at]), at)
        total += leaf_len[at]
    return total / len(forest)


def grow_forest(features: DataFrame, columns: Sequence[str], key: str, trees: int, sample: int, seed: int) -> DataFrame:
    """Node table of a forest. Rows enter a tree by the rank of a seeded hash.

    A hash bound that keeps about four times the sample per tree is applied first, so the
    ranking never sees trees x rows; on small tables the bound keeps everything.
    """
    n = features.agg(F.count(F.lit(1)).alias("n")).scalar()
    spread = F.pmod(F.xxhash64(F.col(key), F.col("tree"), F.lit(seed)), F.lit(1 << 40)).cast("double") / float(1 << 40)
    candidates = (
        features.select(key, F.array(*columns).alias("x"))
        .withColumn("_n", n)
        .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("_h", spread)
        .where(F.col("_h") <= F.lit(4.0 * sample) / F.col("_n"))
    )
    w = Window.partitionBy("tree").orderBy("_h", key)
    drawn = candidates.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= sample).select("tree", "_rn", "x")

    def grow(key_: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(key_[0])
        x = np.vstack(pdf.sort_values("_rn")["x"].to_numpy())
        nodes = grow_tree(x, np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "depth", "size"])
        out.insert(0, "tree", tree)
        return out

    return drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def multivariate_outliers(features: DataFrame, columns: Sequence[str] = FEATURES, key: str = "symbol",
                          contamination: float = CONTAMINATION, seed: int = SEED, trees: int = TREES,
                          sample: int = SAMPLE, min_rows: int | None = None) -> DataFrame:
    """Anomaly score (more negative is stranger) and flag of the strangest fraction.

    A missing feature counts as 0, no signal. The flag cuts at the exact quantile of the
    scores.
    """
    if min_rows:
        require_rows(features, min_rows, "multivariate_outliers: too few symbols")
    features = materialise(features)     # read by the sample, the scoring and the count
    filled = features.select("*", *[F.coalesce(F.col(c), F.lit(0.0)).alias(f"_f_{c}") for c in columns])
    inputs = [f"_f_{c}" for c in columns]
    nodes = grow_forest(filled, inputs, key, trees, sample, seed).toPandas()   # at most trees x (2 sample - 1) rows
    forest = [t.sort_values("node").reset_index(drop=True) for _, t in nodes.groupby("tree")]
    drawn = int(nodes.loc[nodes["node"] == 0, "size"].max()) if len(nodes) else 1
    shipped = features.sparkSession.sparkContext.broadcast(forest)
    norm = float(path_correction(drawn)) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for pdf in batches:
            yield pd.Series(-np.power(2.0, -path_lengths(shipped.value, pdf.to_numpy(dtype=float)) / norm))

    scored = materialise(filled.withColumn("anomaly_score_raw", score(F.struct(*inputs))).drop(*inputs))
    cut = exact_quantile(scored, "anomaly_score_raw", contamination, -1.0, 0.0)
    return scored.withColumn("is_outlier", F.col("anomaly_score_raw") < cut)
