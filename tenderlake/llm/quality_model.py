"""Quality classifier: random Fourier features, ridge by summed normal equations, isotonic scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm.common import map_batches, materialize, table, text_of

STATISTICS = (
    "words", "word_length", "symbols", "exclamations", "bars", "capitals", "digits", "stops",
    "distinct_words", "repeated_windows", "repeated_lines", "line_words",
)
FEATURES = 192
RIDGE = 1e-4
SEED = 20240
#: Steps of the score on which the calibration counts labels; they bound what the driver gets.
STEPS = 512
#: The calibrated steps span this range of ridge scores; scores beyond it count at its ends.
LOW, HIGH = -0.5, 1.5


def statistics(text: str) -> list[float]:
    """The numbers a document is judged by; all are shares, means or logarithms of its whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lines = [line for line in text.split("\n") if line.strip()]
    windows = n - 2
    return [
        np.log1p(n),
        np.log1p(sum(map(len, words)) / n),
        np.log1p(sum(map(text.count, "#*$%&|<>")) / n),
        np.log1p(text.count("!") / n),
        text.count("|") / n,
        sum(map(str.isupper, words)) / n,
        sum(map(text.count, "0123456789")) / len(text),
        (text.count(".") + text.count(",")) / n,
        len(set(words)) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / windows if windows > 0 else 0.0,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))),
    ]


def document_statistics(docs: DataFrame, *keep: Column) -> DataFrame:
    """The kept columns and ``x``, the statistics of each text; a null text counts as empty."""
    kept = docs.select(*keep, text_of().alias("text"))
    names = kept.columns[:-1]
    schema = ", ".join(f"{n} {'long' if t == 'bigint' else t}" for n, t in kept.dtypes[:-1])

    def step(batch: pa.RecordBatch) -> dict:
        return {n: batch.column(n) for n in names} | {"x": [statistics(t) for t in batch.column("text").to_pylist()]}

    return map_batches(kept, f"{schema}, x array<double>", step)


@dataclass(frozen=True)
class Model:
    """What is needed to score; its size depends on the parameters only."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    seed: int = SEED

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(features(x, self.mean, self.scale, len(self.weights) - 1, self.seed) @ self.weights, self.knots, self.values)


def features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Cosines whose inner products approximate a Gaussian kernel of width sqrt(dimensions), and a constant."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(x.shape[1], count)) / np.sqrt(x.shape[1])
    phases = rng.uniform(0, 2 * np.pi, size=count)
    z = np.clip((x - mean) / scale, -6, 6)
    return np.hstack([np.sqrt(2 / count) * np.cos(z @ directions + phases), np.ones((len(x), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.values.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The normal equations: each partition sends its own sums, Spark adds them up."""
    upper = np.triu_indices(count + 2)

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((count + 2, count + 2))
        for batch in batches:
            if batch.num_rows:
                phi = features(_matrix(batch.column("x")), mean, scale, count, seed)
                both = np.hstack([phi, batch.column("y").to_numpy(zero_copy_only=False)[:, None]])
                total += both.T @ both
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], ["k", "v"])

    summed = rows.select("x", "y").mapInArrow(partition, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
    flat = np.zeros(len(upper[0]))
    for k, v in summed.collect():  # one number for each pair of features
        flat[k] = v
    full = np.zeros((count + 2, count + 2))
    full[upper] = flat
    full = np.triu(full) + np.triu(full, 1).T
    return full[:-1, :-1], full[:-1, -1]


def isotonic(position: np.ndarray, hits: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step means: neighbours that fall are pooled."""
    blocks: list[list[float]] = []  # weight, sum of positions, sum of hits
    for p, h, n in zip(position, hits, size, strict=True):
        blocks.append([n, p * n, h])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[1] / b[0] for b in blocks]), np.array([b[2] / b[0] for b in blocks])


def fit(rows: DataFrame, count: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """``rows``: x, y (0 or 1, double) and ``calibrates`` (boolean).

    The ridge scores come from the rows that do not calibrate, the calibration from the others.
    All rows take part. Without labels every score is one half; labels of one kind give that
    kind's share everywhere.
    """
    d = len(STATISTICS)
    sides = rows.agg(
        F.count(F.lit(1)), F.avg("y"),
        *[f(F.get("x", F.lit(i))) for i in range(d) for f in (F.avg, F.stddev_pop)],
    ).first()
    flat = Model(np.zeros(d), np.ones(d), np.zeros(count + 1), np.array([0.0]), np.array([0.5 if not sides[0] else sides[1]]), seed)
    if not sides[0] or sides[1] in (0, 1):
        return flat
    mean = np.array(sides[2::2], dtype=float)
    scale = np.array([s if s > 1e-9 else 1.0 for s in sides[3::2]])
    gram, target = _sums(rows.filter("NOT calibrates"), mean, scale, count, seed)
    weights = np.linalg.solve(gram + ridge * max(1.0, gram[-1, -1]) * np.eye(count + 1), target)
    raw = Model(mean, scale, weights, np.array([LOW, HIGH]), np.array([LOW, HIGH]), seed)
    step = F.least(F.lit(STEPS - 1), F.floor((F.col("score") - LOW) / (HIGH - LOW) * STEPS))
    binned = (
        scored(rows.filter("calibrates"), raw, "y")
        .groupBy(step.alias("step"))
        .agg(F.avg("score").alias("p"), F.sum("y").alias("hits"), F.count(F.lit(1)).alias("n"))
        .orderBy("step")
        .collect()  # at most STEPS rows
    )
    if not binned:
        return Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]), seed)
    knots, values = isotonic(*(np.array([r[k] for r in binned], dtype=float) for k in ("p", "hits", "n")))
    return Model(mean, scale, weights, knots, values, seed)


def scored(rows: DataFrame, model: Model, keep: str) -> DataFrame:
    """(keep, score) of rows with ``x``."""
    kind = dict(rows.dtypes)[keep].replace("bigint", "long")

    def step(batch: pa.RecordBatch) -> dict:
        return {keep: batch.column(keep), "score": model.score(_matrix(batch.column("x")))}

    return map_batches(rows.select(keep, "x"), f"{keep} {kind}, score double", step)


def remainder(doc_id: Column) -> Column:
    """Checksum of the id as text, modulo 3: 1 is held out, 2 calibrates."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows that are not held out; null labels are none, repeated ones count each."""
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    rest = remainder(F.col("doc_id"))
    return stats.join(known.filter(rest != 1), "doc_id").select("x", "y", (rest == 2).alias("calibrates"))


def learn(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """(doc_id, x) of every document, written once, and the model of their labels."""
    stats = materialize(document_statistics(docs, F.col("doc_id").cast("long").alias("doc_id")))
    return stats, fit(materialize(training_rows(stats, labels)))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows whose score is at least ``least``, with all their columns; nothing is shuffled."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text = batch.column(batch.schema.names.index("text")).to_pylist()
                score = model.score(np.array([statistics(t or "") for t in text]))
                yield batch.filter(pa.array(score >= least))

    return docs.mapInArrow(keep, docs.schema)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every row of ``documents``; null and empty texts are scored by the statistics of no words.

    Equal texts score alike; without labels, or with labels of one kind, all scores are alike. An
    empty table gives no rows.
    """
    stats, model = learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored(stats, model, "doc_id").select(
        "doc_id",
        (remainder(F.col("doc_id")) == 1).alias("held_out"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"),
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
