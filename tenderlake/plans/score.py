"""Atypicality scores of every loaded notice, ranked and explained."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.operators.anomaly import DEFAULT_SEED, TREES, IsolationForest, RobustScaler
from tenderlake.operators.features import FEATURES, feature_matrix, neutralize
from tenderlake.operators.ranking import number_rows
from tenderlake.plans.runs import new_run_id, record_run
from tenderlake.schemas import KEY
from tenderlake.session import materialize
from tenderlake.sources.silver import read_silver
from tenderlake.sources.tables import Tables

RUN_TYPE = "anomaly:notice"
TOP_CONTRIBUTIONS = 5


def explanation(scaler: RobustScaler) -> Column:
    """JSON text of the feature values and the largest deviations."""
    top = scaler.contributions(FEATURES, TOP_CONTRIBUTIONS)
    rounded = F.transform(
        top, lambda d: F.struct(d["feature"].alias("feature"), F.round(d["deviation"], 4).alias("deviation"))
    )
    return F.to_json(F.struct(F.struct(*FEATURES).alias("values"), rounded.alias("contributions")))


def score_matrix(matrix: DataFrame, seed: int = DEFAULT_SEED) -> tuple[DataFrame, RobustScaler]:
    """Adds the score to a stored, null-free matrix; also returns the fitted scaler."""
    scaler = RobustScaler.fit(matrix, FEATURES)
    forest = IsolationForest.fit(scaler.transform(matrix), FEATURES, KEY, seed)
    # The trees were grown on scaled values; the row keeps its original ones for the reader.
    scaled = matrix.withColumns({f"_z_{f}": scaler.z(f) for f in FEATURES})
    return forest.score(scaled, inputs=[f"_z_{f}" for f in FEATURES]).drop(*[f"_z_{f}" for f in FEATURES]), scaler


def rank_scores(scored: DataFrame) -> DataFrame:
    """One distinct position per notice, highest score first, ties by natural key."""
    return number_rows(scored, [F.col("score").desc(), *[F.col(k).asc() for k in KEY]])


def score(spark: SparkSession, silver: str, tables: Tables, seed: int = DEFAULT_SEED) -> int:
    """Scores silver, keeps the loaded notices, and replaces the previous scores and their run record in one commit.

    With no data at all the former scores stay.
    """
    with tables.commit():
        return _score(spark, silver, tables, seed)


def _score(spark: SparkSession, silver: str, tables: Tables, seed: int) -> int:
    notices, items, bids = (read_silver(spark, silver, t) for t in ("notice", "item", "bid"))
    matrix = materialize(neutralize(feature_matrix(notices, items, bids, stage=materialize)))
    if matrix.isEmpty():
        return 0
    scored, scaler = score_matrix(matrix, seed)
    loaded = tables.read("notice").select(*KEY, "period")
    # Range partitioning reads its input twice: the forest must not walk every row for each.
    ranked = rank_scores(materialize(scored.drop("period").join(loaded, KEY)))
    run_id = new_run_id()
    written = tables.replace(
        "notice_score",
        ranked.withColumns(
            {
                "run_id": F.lit(run_id),
                "score": F.round("score", 6).cast("decimal(12,6)"),
                "features": explanation(scaler),
            }
        ),
        partition_by="period",
    )
    total = written.count()
    record_run(
        tables,
        run_id,
        RUN_TYPE,
        "isolation forest",
        {"n_estimators": TREES, "seed": seed, "scaling": "median/IQR"},
        {"scored": total},
    )
    return total
