"""Exact quantiles against numpy."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.operators import quantiles
from tenderlake.operators.quantiles import exact_median, exact_quantiles, ranged_counts
from tenderlake.operators.ranking import keep_last, number_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, ties, heavy tails, null values and a null key."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 97 == 1, None).otherwise(F.col("id") % 300)
    value = (
        F.when(F.col("id") % 11 == 0, None)
        .when(F.col("id") % 5 == 0, 7.0)
        .otherwise(F.round(F.exp((F.xxhash64("id") % 1000) / 90.0), 3) + F.col("id") / 1e6)
    )
    df = spark.range(0, 60_000, 1, 12).select(key.cast("int").alias("g"), value.alias("v"))
    return df.toPandas(), df


def test_matches_numpy(spark, skewed):
    pandas, df = skewed
    out = exact_quantiles(
        df,
        ["g"],
        "v",
        {"q1": 0.25, "q2": 0.5, "q3": 0.75, "p99": 0.99},
        extras={"n": (F.count(F.lit(1)), F.sum), "total": (F.sum("v"), F.sum)},
    ).collect()
    groups = {(None if np.isnan(g) else int(g)): part["v"] for g, part in pandas.groupby("g", dropna=False)}
    assert {r.g for r in out} == set(groups)
    for r in out:
        values = groups[r.g].dropna().to_numpy()
        assert r.n == len(groups[r.g])
        np.testing.assert_allclose([r.q1, r.q2, r.q3, r.p99], np.percentile(values, [25, 50, 75, 99]), rtol=1e-12)
        np.testing.assert_allclose(r.total, values.sum(), rtol=1e-9)


@pytest.mark.parametrize("n", range(1, 12))
def test_tiny_groups(spark, n):
    df = spark.createDataFrame([(1, float(i * i)) for i in range(n)], "g int, v double")
    row = exact_quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.75}).first()
    np.testing.assert_allclose(row[1:], np.percentile([float(i * i) for i in range(n)], [25, 50, 75]))


def test_group_of_nulls_has_no_median(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5.0)], "g int, v double")
    assert {r.g: r.m for r in exact_median(df, ["g"], "v", "m").collect()} == {1: None, 2: 5.0}


def test_values_of_every_sign_and_size(spark):
    values = [s * 10.0**e * f for s in (-1, 1) for e in range(-12, 13, 3) for f in (1, 1.0001, 2)] + [0.0, -0.0, float("inf"), float("-inf")]
    df = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    row = exact_quantiles(df, ["g"], "v", {f"p{i}": i / (len(values) - 1) for i in range(len(values))}).first()
    np.testing.assert_allclose([row[f"p{i}"] for i in range(len(values))][1:-1], sorted(values)[1:-1])


@pytest.mark.parametrize("value", ["id / 2e8", "exp(id / 1e4)", "1e9 + id", "CASE WHEN id < 150000 THEN id / 1e12 ELSE id END"])
def test_no_task_holds_much_more_than_its_share(spark, value):
    """One group of 200,000 distinct values, however close, is cut evenly."""
    df = spark.range(200_000).select(F.lit(1).alias("g"), F.expr(value).alias("v"))
    parts = 16
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ranged_counts(df, ["g"], "v", {}).groupBy("_g", "_q_part").count().collect()]
        row = exact_quantiles(df, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.999}).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 200_000 and max(sizes) < 2 * 200_000 / parts
    np.testing.assert_allclose(row[1:], np.percentile(df.toPandas()["v"], [25, 50, 99.9]), rtol=1e-12)


def test_without_keys_all_rows_are_one_group(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,), (2.0,)], "v double")
    row = exact_quantiles(df, [], "v", {"m": 0.5}, extras={"n": (F.count(F.lit(1)), F.sum)}).collect()
    assert [tuple(r) for r in row] == [(2.0, 4)]


def test_row_numbers_are_dense_and_ordered_under_ties(spark):
    df = spark.range(0, 20_000, 1, 7).select("id", (F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50)).alias("v"))
    ranked = number_rows(df, [F.col("v").desc(), F.col("id").asc()]).toPandas().sort_values("rank")
    assert ranked["rank"].tolist() == list(range(1, 20_001))
    expected = df.toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert ranked["id"].tolist() == expected["id"].tolist()


def test_keep_last_keeps_whole_rows(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "c"), (None, 1, "n")], "k int, o int, x string")
    assert rows(keep_last(df, ["k"], ["o"]), "k", "o", "x") == [(1, 2, None), (2, 1, "c"), (None, 1, "n")]


def test_medians_of_rows_in_ranges(spark, monkeypatch):
    """Groups within a range, across ranges and too large to be held, nulls in keys and values, equal values."""
    monkeypatch.setattr(quantiles, "PASSING", 300)
    rng = random.Random(5)
    rows = [(f"g{g:03d}", g % 3, rng.choice([None, 1.0, rng.random()])) for g in range(200) for _ in range(rng.randint(1, 9))]
    rows += [("hot", 1, rng.choice([2.5, rng.random()])) for _ in range(4000)] + [(None, 1, 1.0), ("g000", None, 2.0), ("empty", 0, None)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "id int, a string, b int, v double").repartition(7)
    groups = {}
    for a, b, v in rows:
        groups.setdefault((a, b), []).extend([] if v is None else [v])
    out = quantiles.with_median(df, ["a", "b"], F.col("v"), "m").collect()
    assert sorted(r["id"] for r in out) == list(range(len(rows)))
    for r in out:
        a, b, v = rows[r["id"]]
        values = groups[a, b]
        assert (r["a"], r["b"], r["v"]) == (a, b, v)
        wanted = None if a is None or b is None or not values else statistics.median(values)
        assert r["m"] == (None if wanted is None else pytest.approx(wanted, rel=1e-15))


def test_only_groups_at_the_ends_of_ranges_are_ranked(spark, monkeypatch):
    ranked = []
    exact = quantiles.exact_median
    monkeypatch.setattr(quantiles, "exact_median", lambda df, *args, **kwargs: (ranked.append(df.select("g").distinct().count()), exact(df, *args, **kwargs))[1])
    df = spark.range(20_000).select((F.col("id") % 1000).alias("g"), F.col("id").alias("v"))
    out = quantiles.with_median(df, ["g"], F.col("v"), "m")
    assert out.filter("m != g + 9500").isEmpty() and out.count() == 20_000
    assert ranked and ranked[0] <= 2 * spark.sparkContext.defaultParallelism
