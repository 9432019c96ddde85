"""Atypicality of notices: robust scaling, isolation forest and contributions.

A high score says that a notice is unlike the others, and nothing about why.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlake.operators.quantiles import exact_quantiles

TREES = 100
SUBSAMPLE = 256
DEFAULT_SEED = 42


# --- robust scaling ---------------------------------------------------------------------


def robust_stats(matrix: DataFrame, features: list[str]) -> DataFrame:
    """Per feature: median and interquartile range, a zero range becoming one."""
    long = matrix.select(*[F.col(c).cast("double") for c in features]).unpivot(
        [], features, "feature", "_value"
    )
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = exact_quantiles(long, ["feature"], "_value", wanted)
    spread = F.col("q3") - F.col("q1")
    return quartiles.select("feature", "median", F.when(spread == 0, 1.0).otherwise(spread).alias("iqr"))


@dataclass(frozen=True)
class RobustScaler:
    """Fitted medians and ranges: two numbers per feature, whatever the data size."""

    stats: dict[str, tuple[float, float]]

    @classmethod
    def fit(cls, matrix: DataFrame, features: list[str]) -> RobustScaler:
        rows = robust_stats(matrix, features).collect()
        return cls({r["feature"]: (r["median"], r["iqr"]) for r in rows})

    def z(self, feature: str) -> Column:
        median, iqr = self.stats[feature]
        return (F.col(feature).cast("double") - F.lit(median)) / F.lit(iqr)

    def transform(self, matrix: DataFrame) -> DataFrame:
        return matrix.withColumns({f: self.z(f) for f in self.stats})

    def contributions(self, features: list[str], top: int | None = None) -> Column:
        """Features with their absolute robust deviation, largest first, ties in feature order."""
        deviations = [
            F.struct((-F.abs(self.z(f))).alias("_neg"), F.lit(i).alias("_i"), F.lit(f).alias("feature"))
            for i, f in enumerate(features)
        ]
        ordered = F.sort_array(F.array(*deviations))
        ordered = ordered if top is None else F.slice(ordered, 1, top)
        return F.transform(ordered, lambda d: F.struct(d["feature"].alias("feature"), (-d["_neg"]).alias("deviation")))


# --- isolation forest (Liu, Ting & Zhou, ICDM 2008) ---------------------------------------


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points: the c(n) of the paper."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    deep = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.select([n <= 1, n <= 2], [0.0, 1.0], deep)


NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, depth double"


def _grow(sample: pd.DataFrame, features: list[str], seed: int) -> pd.DataFrame:
    """One random tree over the rows of its subsample."""
    tree = int(sample["_tree"].iloc[0])
    x = sample.sort_values("_position")[features].to_numpy(float)
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes: list[list[float]] = []

    def build(rows: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, me, me, depth + float(average_path(len(rows)))])
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(low < high)
        if depth < limit and len(usable):
            f = int(rng.choice(usable))
            cut = float(rng.uniform(low[f], high[f]))
            cut = cut if cut < high[f] else low[f]
            goes_left = rows[:, f] <= cut
            nodes[me][:2] = [f, cut]
            nodes[me][2] = build(rows[goes_left], depth + 1)
            nodes[me][3] = build(rows[~goes_left], depth + 1)
        return me

    build(x, 0)
    out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "depth"])
    out.insert(0, "node", range(len(out)))
    out.insert(0, "tree", tree)
    return out


#: Draws are whole numbers below this prime.
DRAW_PRIME = 2**31 - 1


def drawn_rows(matrix: DataFrame, features: list[str], key: list[str], seed: int, trees: int, share: float) -> DataFrame:
    """(features, key, _tie, _tree, _draw): the rows whose draw for a tree is in the lowest ``share``.

    A digest of seed and key gives a row three numbers, its draw for a tree is their quadratic in
    the tree's number: uniform over the rows, and independent between any three trees. A row goes
    to the shuffle only for the trees that have drawn it.
    """
    digest = F.md5(F.concat_ws("|", F.lit(f"{seed}|tree"), *[F.col(k).cast("string") for k in key]))
    number = lambda start: F.conv(F.substring("_digest", start, 10), 16, 10).cast("long")
    rows = matrix.select(*[F.col(f).cast("double").alias(f) for f in features], *key, digest.alias("_digest"))
    rows = rows.select(*features, *key, number(1).alias("_a"), number(11).alias("_b"), number(21).alias("_c"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("_tree"))
    at = F.col("_tree").cast("long") + 1
    draw = (F.col("_a") + at * F.col("_b") + at * at * F.col("_c")) % DRAW_PRIME
    drawn = rows.select(*features, *key, F.col("_b").alias("_tie"), "_tree", draw.alias("_draw"))
    return drawn.filter(F.col("_draw") < int(np.ceil(share * DRAW_PRIME)))


def subsamples(
    matrix: DataFrame, features: list[str], key: list[str], seed: int, n: int, trees: int = TREES, subsample: int = SUBSAMPLE
) -> DataFrame:
    """What every tree grows from: the ``subsample`` rows with its lowest draws, numbered by ``_position``.

    ``n`` is the number of rows; about four subsamples per tree are shuffled, whatever it is.
    """
    drawn = drawn_rows(matrix, features, key, seed, trees, min(1.0, 4.0 * subsample / n))
    position = F.row_number().over(Window.partitionBy("_tree").orderBy("_draw", "_tie"))
    return drawn.withColumn("_position", position).filter(F.col("_position") <= subsample)


def _scores(x: np.ndarray, arrays: tuple[np.ndarray, ...], levels: int, scale: float) -> np.ndarray:
    """Rows walk down one tree at a time, all rows together."""
    feature, threshold, left, right, depth, roots = arrays
    rows = np.arange(len(x))
    total = np.zeros(len(x))
    for root in roots:
        at = np.full(len(x), root)
        for _ in range(levels):
            goes_left = x[rows, feature[at]] <= threshold[at]
            at = np.where(goes_left, left[at], right[at])
        total += depth[at]
    mean = total / len(roots)
    return 2.0 ** -(mean / scale if scale else np.ones(len(x)))


@dataclass(frozen=True)
class IsolationForest:
    """Node arrays of all trees: at most trees x (2 x subsample - 1) rows, whatever the data size."""

    features: list[str]
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    roots: np.ndarray
    levels: int
    scale: float

    @classmethod
    def fit(
        cls,
        matrix: DataFrame,
        features: list[str],
        key: list[str],
        seed: int = DEFAULT_SEED,
        trees: int = TREES,
        subsample: int = SUBSAMPLE,
    ) -> IsolationForest:
        """Grow each tree from its own subsample, one task per tree.

        Draws are hashes of the row key and the tree, so they do not depend on the order or the
        partitioning of the rows. Every row is drawn for by every tree, in one narrow pass; about
        four subsamples per tree leave it, of which the tree keeps the lowest draws.
        """
        missing = [F.count_if(F.col(f).isNull()).alias(f) for f in features]
        counts = matrix.agg(F.count(F.lit(1)).alias("_n"), *missing).first()
        n = counts["_n"]
        if n == 0:
            raise ValueError("no rows to grow trees from")
        nulls = sorted(f for f in features if counts[f])
        if nulls:
            raise ValueError(f"nulls in {nulls}: fill them before fitting")

        def grow(sample: pd.DataFrame) -> pd.DataFrame:
            return _grow(sample, features, seed)

        rows = subsamples(matrix, features, key, seed, n, trees, subsample)
        return cls.of_nodes(rows.groupBy("_tree").applyInPandas(grow, NODE_SCHEMA), features, min(n, subsample))

    @classmethod
    def of_nodes(cls, nodes: DataFrame, features: list[str], subsample: int) -> IsolationForest:
        """The forest of a node table, as grown or as stored; ``subsample`` rows have grown each tree.

        A node names its children by their number in the tree; a leaf has feature -1 and its own number twice.
        """
        nodes = nodes.toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
        root = nodes.index.to_series().where(nodes["node"] == 0).ffill().to_numpy(int)
        return cls(
            features=features,
            feature=np.maximum(nodes["feature"].to_numpy(), 0),
            threshold=np.where(nodes["feature"] < 0, np.inf, nodes["threshold"]),
            left=nodes["left"].to_numpy() + root,
            right=nodes["right"].to_numpy() + root,
            depth=nodes["depth"].to_numpy(),
            roots=np.unique(root),
            levels=int(np.ceil(np.log2(max(subsample, 2)))),
            scale=float(average_path(subsample)),
        )

    def score(self, matrix: DataFrame, name: str = "score", inputs: list[str] | None = None) -> DataFrame:
        """Adds the score of every row, higher meaning more atypical; one narrow Arrow pass.

        ``inputs`` names the columns that hold the features, when they are called otherwise.
        """
        inputs = inputs or self.features
        # Plain arrays, so that workers can read them without this package.
        arrays = (self.feature, self.threshold, self.left, self.right, self.depth, self.roots)
        forest = matrix.sparkSession.sparkContext.broadcast(arrays)
        levels, scale = self.levels, self.scale
        schema = T.StructType([*matrix.schema.fields, T.StructField(name, T.DoubleType())])

        def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.column_stack(
                    [batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in inputs]
                )
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(_scores(x, forest.value, levels, scale))], names=[*batch.schema.names, name]
                )

        return matrix.mapInArrow(score_batches, schema)


def isolation_score(
    matrix: DataFrame, features: list[str], key: list[str], seed: int = DEFAULT_SEED, **kwargs
) -> DataFrame:
    """Robustly scaled features, fitted forest and score in one call."""
    scaler = RobustScaler.fit(matrix, features)
    scaled = scaler.transform(matrix)
    return IsolationForest.fit(scaled, features, key, seed, **kwargs).score(scaled)
