import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.operators.anomaly import IsolationForest, RobustScaler, average_path, isolation_score, robust_stats, subsamples
from tenderlake.operators.features import FEATURES
from tenderlake.operators.perturb import KINDS, lowest, perturb
from tenderlake.plans.score import explanation

NAMES = ["value_ratio_group", "bidders_ratio_modality", "agency_hhi"]


@pytest.fixture(scope="module")
def matrix(spark):
    """200 typical rows and three planted ones."""
    typical = [(i, 1.0 + (i % 10) * 0.05, 1.0, 0.02) for i in range(200)]
    planted = [(200, 80.0, 1.0, 0.02), (201, 1.0, 0.05, 0.9), (202, 95.0, 0.05, 0.85)]
    return spark.createDataFrame(typical + planted, ["id", *NAMES])


def scores(matrix, seed=42):
    return [r.score for r in isolation_score(matrix, NAMES, ["id"], seed).orderBy("id").collect()]


def test_scores_are_reproducible_and_oriented(matrix):
    first = scores(matrix)
    assert len(first) == 203 and all(0 < s <= 1 for s in first)
    assert min(first[200:]) > np.median(first[:200])
    assert scores(matrix.repartition(5, F.rand())) == first
    assert scores(matrix, seed=7) != first


def test_empty_and_null_matrices_are_refused(matrix):
    with pytest.raises(ValueError, match="no rows"):
        IsolationForest.fit(matrix.limit(0), NAMES, ["id"])
    with pytest.raises(ValueError, match="agency_hhi"):
        IsolationForest.fit(matrix.withColumn("agency_hhi", F.when(F.col("id") > 3, 0.0)), NAMES, ["id"])


def test_one_row_and_constant_columns(matrix):
    assert scores(matrix.filter("id = 0")) == [0.5]
    constant = matrix.filter("id < 200").withColumn("value_ratio_group", F.lit(1.0))
    assert len(set(scores(constant))) == 1


def test_subsamples_are_uniform_and_independent(spark):
    n, trees, size = 6000, 40, 64
    rows = subsamples(spark.range(n).repartition(7), [], ["id"], 9, n, trees, size).collect()
    by_tree = {t: sorted((r._position, int(r.id)) for r in rows if r._tree == t) for t in range(trees)}
    assert all([p for p, _ in of] == list(range(1, size + 1)) for of in by_tree.values())
    held = [{i for _, i in of} for of in by_tree.values()]
    assert all(len(ids) == size for ids in held)
    # Two trees share size * size / n rows on average, and no part of the ids is preferred.
    shared = np.mean([len(a & b) for k, a in enumerate(held) for b in held[:k]])
    assert abs(shared - size * size / n) < 0.15
    parts = np.bincount([i * 8 // n for ids in held for i in ids], minlength=8)
    assert parts.min() > 240 and parts.max() < 400
    again = subsamples(spark.range(n), [], ["id"], 9, n, trees, size)
    assert sorted((r._tree, r._position, r.id) for r in again.collect()) == sorted((r._tree, r._position, r.id) for r in rows)


def test_stored_nodes_score_as_grown(spark):
    nodes = [(0, 0, 0, 0.5, 1, 2, 0.0), (0, 1, -1, 0.0, 1, 1, 1.0), (0, 2, 1, 3.0, 3, 4, 1.0), (0, 3, -1, 0.0, 3, 3, 2.0),
             (0, 4, -1, 0.0, 4, 4, 6.0), (1, 0, -1, 0.0, 0, 0, 4.0)]
    stored = spark.createDataFrame(nodes, "tree int, node int, feature int, threshold double, left int, right int, depth double")
    forest = IsolationForest.of_nodes(stored.repartition(3), ["a", "b"], 4)
    rows = spark.createDataFrame([(0.5, 9.0), (0.6, 3.0), (0.6, 3.1)], ["a", "b"])
    got = {(r.a, r.b): r.score for r in forest.score(rows).collect()}
    want = {at: 2.0 ** -((d + 4.0) / 2 / float(average_path(4))) for at, d in {(0.5, 9.0): 1, (0.6, 3.0): 2, (0.6, 3.1): 6}.items()}
    assert got == pytest.approx(want)


def test_average_path():
    np.testing.assert_allclose(average_path([1, 2]), [0, 1])
    assert 10 < float(average_path(256)) < 10.5


def test_robust_stats_match_numpy(spark, matrix):
    x = matrix.toPandas()
    for r in robust_stats(matrix, NAMES).collect():
        q1, q2, q3 = np.percentile(x[r.feature], [25, 50, 75])
        np.testing.assert_allclose([r.median, r.iqr], [q2, (q3 - q1) or 1.0])


def test_contributions_are_complete_sorted_and_stable(spark, matrix):
    scaler = RobustScaler.fit(matrix, NAMES)
    rows = matrix.select("id", scaler.contributions(NAMES).alias("c")).orderBy("id").collect()
    for r in rows:
        deviations = [d.deviation for d in r.c]
        assert {d.feature for d in r.c} == set(NAMES)
        assert deviations == sorted(deviations, reverse=True) and min(deviations) >= 0
    assert rows[200].c[0].feature == "value_ratio_group"
    # Equal deviations keep the order of the features.
    flat = spark.createDataFrame([(1, 1.0, 1.0, 1.0), (2, 1.0, 1.0, 1.0)], ["id", *NAMES])
    row = flat.select(RobustScaler.fit(flat, NAMES).contributions(NAMES).alias("c")).first()
    assert [d.feature for d in row.c] == NAMES


@pytest.fixture(scope="module")
def full(spark):
    return spark.range(50).select(
        F.col("id").cast("string").alias("notice_no"), F.lit("1").alias("unit_id"), F.lit(5).alias("modality_id"),
        *[F.lit(0.5).alias(f) for f in FEATURES],
    )


def test_explanation_is_json(full):
    row = full.select(explanation(RobustScaler.fit(full, FEATURES)).alias("j")).first()
    document = json.loads(row.j)
    assert list(document["values"]) == FEATURES and len(document["contributions"]) == 5
    assert set(document["contributions"][0]) == {"feature", "deviation"}


@pytest.mark.parametrize("k", [10, 20])
def test_perturbation_marks_exactly_what_it_changes(full, k):
    out = perturb(full, k, 1).collect()
    assert len(out) == 50
    marked = [r for r in out if r.perturbed]
    assert len(marked) == k and {r.perturbed for r in marked} <= set(KINDS)
    for r in out:
        assert any(r[f] != 0.5 for f in FEATURES) == bool(r.perturbed)
        if r.perturbed == "value":
            assert 10 <= r.value_ratio_group <= 100 and r.item_ratio_max == r.value_ratio_group
        if r.perturbed == "competition":
            assert 0.005 <= r.bidders_ratio_modality <= 0.025 and 5 <= r.value_ratio_group <= 20
        if r.perturbed == "seasonal":
            assert 8 <= r.seasonal_deviation <= 20 and 5 <= r.value_ratio_group <= 20


def test_perturbation_is_seeded_and_bounded(full):
    def chosen(seed):
        return {r.notice_no for r in perturb(full, 10, seed).filter("perturbed is not null").collect()}

    assert chosen(1) == chosen(1) != chosen(2)
    with pytest.raises(ValueError):
        perturb(full, 51, 1)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 500, 2999, 3000])
def test_lowest_draws_with_ties(spark, k):
    rows = [(i, 0.5 if i % 3 == 0 else (0.25 + (i % 7) * 2.0**-52 if i % 2 else i / 4096)) for i in range(3000)]
    drawn = spark.createDataFrame(rows, "id long, draw double").repartition(5)
    found = lowest(drawn, k, ["id"])
    assert sorted(r.id for r in found.collect()) == sorted(i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))[:k])
    assert "Limit" not in found._jdf.queryExecution().toString()
