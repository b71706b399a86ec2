"""Isolation forest (Liu, Ting and Zhou, 2008) over a feature frame.

Trees grow from small hashed samples, so fitting reads the data once and its groups are at
most `sample` rows each. Scoring is a scan with the forest broadcast: the model's size
depends on trees and sample only, never on the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.operators.quantile import exact_quantile
from candlewick.operators.series import spread
from candlewick.sources.storage import stored

EULER = 0.5772156649015329
# Digests of 15 hexadecimal digits stand on a circle of this length.
CIRCLE = 16**15
# A tree is offered this multiple of its sample, then cut to it exactly.
OVERDRAW = 4
# A threshold stays this far below the largest value, so that rounding can't reach it.
MOST_SHARE = 0.999

NODES = "tree int, node int, feature int, threshold double, left int, right int, path double"


@dataclass(frozen=True)
class Forest:
    """Flattened trees, one row per tree; a leaf is its own child."""

    columns: tuple[str, ...]
    sample: int
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    children: np.ndarray  # left and right child of each node side by side
    path: np.ndarray


def fit_iforest(
    features: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
) -> Forest:
    """Grow `trees` trees on min(sample, n) rows each. `key` identifies a row."""
    rows = features.count()
    if rows == 0:
        raise ValueError("cannot fit a forest on an empty frame")
    sample = min(sample, rows)
    sampled = tree_samples(features, columns, key, rows, trees, sample, seed)
    nodes = grow_trees(sampled, columns, sample, seed).toPandas()
    return _forest(nodes, columns, sample)


def _digits(text: Column, place: int, size: int) -> Column:
    """`size` hexadecimal digits of a digest as a number."""
    return F.conv(F.substring(F.md5(text), place, size), 16, 10).cast("bigint")


def tree_samples(
    features: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    rows: int,
    trees: int,
    sample: int,
    seed: int,
) -> DataFrame:
    """(tree, rank, columns): `sample` distinct rows per tree, chosen by digests of the key.

    Digests put the rows and the trees on a circle; a tree takes the rows that follow it. A row
    is offered only to trees that stand up to OVERDRAW times the expected reach before it, whatever
    the size of the table, so a large one offers few rows to each tree. The choice depends on key
    and seed alone and is the same after a retry.
    """
    reach = min(CIRCLE, -(-CIRCLE * OVERDRAW * sample // rows))
    starts = [int(md5(f"{seed}|tree|{t}".encode()).hexdigest()[:15], 16) for t in range(trees)]
    place = _digits(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]), 1, 15)
    offers = F.array(*[F.lit(s).cast("bigint") for s in starts])
    near = F.filter(
        F.transform(
            offers,
            lambda start, t: F.struct(
                t.alias("tree"), F.pmod(F.col("_place") - start, F.lit(CIRCLE)).alias("draw")
            ),
        ),
        lambda offer: offer["draw"] < F.lit(reach),
    )
    order = Window.partitionBy("tree").orderBy("draw", *key)
    return (
        features.select(*key, *columns, place.alias("_place"))
        .withColumn("_offer", F.explode(near))
        .select(*key, *columns, "_offer.tree", "_offer.draw")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= sample)
        .select("tree", "rank", *columns)
    )


def grow_trees(
    sampled: DataFrame, columns: Sequence[str], sample: int, seed: int
) -> DataFrame:
    """Node table of all trees; a group is one tree's sample of at most `sample` rows."""
    names = list(columns)
    limit = _depth_limit(sample)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        values = group.sort_values("rank")[names].to_numpy(dtype=float)
        table = pd.DataFrame(_grow(values, limit, f"{seed}|{tree}")).assign(tree=tree)
        return table[["tree", "node", "feature", "threshold", "left", "right", "path"]]

    return spread(sampled, "tree").groupBy("tree").applyInPandas(grow, NODES)


def score_samples(features: DataFrame, forest: Forest, output: str = "score") -> DataFrame:
    """Add minus the anomaly measure 2^(-mean path / c(sample)): the lower, the odder."""
    model = features.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = model.value
        normal = _expected_path(np.array([trees.sample]))[0]
        for batch in batches:
            values = np.column_stack([series.to_numpy(dtype=float) for series in batch])
            yield pd.Series(-np.exp2(-_mean_path(values, trees) / normal))

    return features.withColumn(output, score(*forest.columns))


def score_iforest(
    features: DataFrame, forest: Forest, contamination: float = 0.05
) -> DataFrame:
    """Add anomaly_score (below 0 is anomalous) and is_anomaly.

    The offset is the exact `contamination` quantile of the scores. Scores are written
    once because the quantile and the result both read them.
    """
    scored = stored(score_samples(features, forest), "scores")
    offset = exact_quantile(scored, "score", contamination)
    decision = F.col("score") - F.lit(offset)
    return scored.withColumns(
        {"anomaly_score": decision, "is_anomaly": decision < 0}
    ).drop("score")


def _depth_limit(sample: int) -> int:
    return max(1, int(np.ceil(np.log2(max(sample, 2)))))


def _expected_path(sizes: np.ndarray) -> np.ndarray:
    """Mean path of an unsuccessful search among `sizes` points (equation 1 of the paper)."""
    sizes = sizes.astype(float)
    large = 2 * (np.log(np.maximum(sizes, 2) - 1) + EULER) - 2 * (sizes - 1) / np.maximum(sizes, 1)
    return np.where(sizes > 2, large, np.where(sizes == 2, 1.0, 0.0))


def _grow(values: np.ndarray, limit: int, name: str) -> dict[str, list]:
    """Split at random until points are alone, equal or `limit` deep.

    Node 1 is the root and node n has the children 2n and 2n + 1. A digest of tree and node
    picks the feature among those that vary, and the threshold.
    """
    columns = ("node", "feature", "threshold", "left", "right", "path")
    table: dict[str, list] = {column: [] for column in columns}
    pending = [(1, np.arange(len(values)), 0)]
    for node, members, depth in pending:
        points = values[members]
        low, high = points.min(axis=0), points.max(axis=0)
        varying = np.flatnonzero(low < high)
        entry = (node, 0, 0.0, node, node, 0.0)
        goes_left = np.ones(len(members), dtype=bool)
        if depth < limit and len(varying):
            digest = md5(f"{name}|{node}".encode()).hexdigest()
            feature = int(varying[int(digest[:8], 16) % len(varying)])
            share = MOST_SHARE * (int(digest[8:21], 16) / 16**13)
            threshold = float(low[feature] + share * (high[feature] - low[feature]))
            goes_left = points[:, feature] <= threshold
        if goes_left.all():
            entry = (*entry[:5], depth + float(_expected_path(np.array([len(members)]))[0]))
        else:
            entry = (node, feature, threshold, 2 * node, 2 * node + 1, 0.0)
            pending.append((2 * node, members[goes_left], depth + 1))
            pending.append((2 * node + 1, members[~goes_left], depth + 1))
        for column, value in zip(columns, entry, strict=True):
            table[column].append(value)
    return table


def _forest(nodes: pd.DataFrame, columns: Sequence[str], sample: int) -> Forest:
    """Pack at most trees * (2 * sample - 1) collected nodes into arrays by tree and node."""
    position = nodes["tree"].rank(method="dense").astype(int).to_numpy() - 1
    shape = (position.max() + 1, int(nodes["node"].max()) + 1)

    def packed(name: str, dtype) -> np.ndarray:
        array = np.zeros(shape, dtype=dtype)
        array[position, nodes["node"].to_numpy()] = nodes[name].to_numpy()
        return array

    children = np.stack([packed("left", np.int32), packed("right", np.int32)], axis=-1)
    return Forest(
        columns=tuple(columns),
        sample=sample,
        depth=_depth_limit(sample),
        feature=packed("feature", np.int32),
        threshold=packed("threshold", float),
        children=children.reshape(shape[0], -1),
        path=packed("path", float),
    )


def _mean_path(values: np.ndarray, trees: Forest) -> np.ndarray:
    """Walk all rows down each tree level by level."""
    cells = np.ascontiguousarray(values).ravel()
    starts = np.arange(len(values)) * values.shape[1]
    total = np.zeros(len(values))
    for feature, threshold, children, path in zip(
        trees.feature, trees.threshold, trees.children, trees.path, strict=True
    ):
        node = np.ones(len(values), dtype=np.int32)
        for _ in range(trees.depth):
            right = cells.take(starts + feature.take(node)) > threshold.take(node)
            node = children.take(2 * node + right)
        total += path.take(node)
    return total / len(trees.feature)
