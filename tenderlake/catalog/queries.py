"""One registered query per operator, over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.catalog import bundles, samples
from tenderlake.functions import periods as P
from tenderlake.functions.scalars import br_date, br_decimal, lenient_int, yes_flag
from tenderlake.operators import features as X
from tenderlake.operators import merge, series as S
from tenderlake.operators.aggregates import (
    monthly_series,
    named_winners,
    regroup,
    supplier_series,
    supplier_total,
    with_agency,
)
from tenderlake.operators.anomaly import NODE_SCHEMA, IsolationForest, RobustScaler, average_path, isolation_score, subsamples
from tenderlake.operators.autoregression import fit_orders, forecast_orders
from tenderlake.operators.forecast import forecast
from tenderlake.operators.metrics import error_metrics
from tenderlake.operators.perturb import perturb
from tenderlake.operators.quality import integrity_report
from tenderlake.operators.ranking import keep_last, latest, number_rows
from tenderlake.functions.periods import listing
from tenderlake.plans.ingest import ingest, ingest_report, unpacked_as_silver
from tenderlake.plans.load import last_ingestion, load
from tenderlake.plans.score import explanation, rank_scores, score_matrix
from tenderlake.plans.train import backtest, backtest_pairs, train, training_points
from tenderlake.schemas import KEY, SERVING
from tenderlake.session import materialize, scratch_folder
from tenderlake.sources.archives import parse_lines, unpack
from tenderlake.sources.silver import read_silver, write_silver
from tenderlake.sources.tables import Tables

# Parameters chosen so that both branches of each rule occur in the sample tables.
MIN_GROUP = 115
CUT = 4_000_000
SEED = 42
HORIZON = 12
MIN_TRAIN = 24
LONG_TRAIN = 68
REPLACED = "199507"
#: Orders at which autoregressions are compared: last month, the same month a year ago, both.
ORDERS = ([1], [12], [1, 12])
FIT_AHEAD = 3
WALK_ROWS = 256


def _walk_nodes() -> list[tuple[int, int, int, float, int, int, float]]:
    """A node table by rule: per attribute a tree of three levels, whose last inner node of the second level is a leaf."""
    nodes = []
    for tree in range(len(X.FEATURES)):
        for node in range(15):
            level = (node + 1).bit_length() - 1
            leaf = level == 3 or node == 6
            feature = -1 if leaf else (tree + 3 * node) % len(X.FEATURES)
            left, right = (node, node) if leaf else (2 * node + 1, 2 * node + 2)
            depth = float(level + average_path(1 + (tree + node) % 5)) if leaf else float(level)
            nodes.append((tree, node, feature, 0.0 if leaf else 0.3137 + 0.2713 * node + 0.0517 * tree, left, right, depth))
    return nodes


WALK_NODES = _walk_nodes()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def r(name: str, digits: int = 6) -> F.Column:
    return F.round(F.col(name).cast("double"), digits).alias(name)


# --- parsing and periods ----------------------------------------------------------------


@query("parse_br_decimal_date")
def run_parse_br_decimal_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.table(spark, sf_dir, "orders")
    price = F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    raw = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "").otherwise(price).alias("price"),
        # Day and month swapped: impossible after the twelfth of a month.
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"),
        F.substring("o_orderpriority", 1, 1).alias("code"),
        F.col("o_orderpriority").alias("bad_code"),
        F.when(F.col("o_orderstatus") == "F", " SIM ").when(F.col("o_orderstatus") == "O", "NÃO").alias("flag"),
    )
    return raw.select(
        "o_orderkey",
        br_decimal(F.col("price")).cast("double").alias("price"),
        br_date(F.col("day")).cast("string").alias("day"),
        lenient_int(F.col("code")).alias("code"),
        lenient_int(F.col("bad_code")).alias("bad_code"),
        yes_flag(F.col("flag")).alias("flag"),
    )


@query("period_validate")
def run_period_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = samples.table(spark, sf_dir, "orders")
    candidates = orders.select(F.date_format("o_orderdate", "yyyydd").alias("candidate"))
    return candidates.groupBy("candidate").agg(F.count(F.lit(1)).alias("n")).select(
        "candidate", P.is_period(F.col("candidate")).alias("valid"), "n"
    )


@query("next_periods")
def run_next_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = samples.notices(spark, sf_dir).groupBy("unit_id").agg(
        F.max("period").alias("last"), F.min("period").alias("first")
    )
    known = known.select("unit_id", "last", F.size(P.span(F.col("first"), F.col("last"))).alias("months"))
    ahead = known.select("*", F.explode(F.sequence(F.lit(1), F.lit(HORIZON))).alias("step"))
    return ahead.select("unit_id", "months", "step", P.shift(F.col("last"), F.col("step")).alias("period"))


# --- aggregates ---------------------------------------------------------------------------


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = with_agency(samples.notices(spark, sf_dir), samples.units(spark, sf_dir))
    return monthly_series(placed.select("period", "agency_id", "modality_id", "value"))


@query("monthly_series")
def run_monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir).withColumns(
        {c: F.col(c).cast("double") for c in ("total_value", "median_value")}
    )


@query("sentinel_filter")
def run_sentinel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_winners(samples.items(spark, sf_dir)).select(*KEY, "item_code", "winner_id")


def _supplier_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_series(samples.items(spark, sf_dir))


@query("supplier_series")
def run_supplier_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplier_series(spark, sf_dir).withColumn("total_value", F.col("total_value").cast("double"))


@query("supplier_total")
def run_supplier_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_total(_supplier_series(spark, sf_dir)).withColumn("total_value", F.col("total_value").cast("double"))


def _counts_and_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly series without its median, for what is built on counts and totals."""
    placed = with_agency(samples.notices(spark, sf_dir), samples.units(spark, sf_dir))
    return placed.groupBy("period", "agency_id", "modality_id").agg(
        F.count(F.lit(1)).alias("notice_count"), F.coalesce(F.sum("value"), F.lit(0)).alias("total_value")
    )


def _regrouped(grouping: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return regroup(_counts_and_totals(spark, sf_dir), grouping).withColumn(
            "total_value", F.col("total_value").cast("double")
        )

    return run


QUERIES["series_by_agency"] = _regrouped("agency")
QUERIES["series_by_modality"] = _regrouped("modality")
QUERIES["series_global"] = _regrouped("global")


# --- features -----------------------------------------------------------------------------


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.notice_base(samples.notices(spark, sf_dir))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.bidder_pairs(samples.bids(spark, sf_dir))


@query("plausibility")
def run_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.mark_plausible(samples.items(spark, sf_dir), CUT).select(*KEY, "line_no", "item_code", "plausible")


@query("value_ratio_group")
def run_value_ratio_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = materialize(_base(spark, sf_dir))
    return X.value_ratio(base, base, MIN_GROUP).select(*KEY, r("value_ratio_group"))


@query("bidders_ratio_modality")
def run_bidders_ratio_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = materialize(X.participation(_pairs(spark, sf_dir)).join(_base(spark, sf_dir).select(*KEY), KEY))
    return X.bidders_ratio(counted, counted).select(*KEY, "n_bidders", "n_winners", "winner_id", r("bidders_ratio_modality"))


@query("win_rate")
def run_win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = X.supplier_record(_pairs(spark, sf_dir), _base(spark, sf_dir))
    return record.select("agency_id", "winner_id", "wins", r("winner_win_rate"))


@query("agency_hhi")
def run_agency_hhi(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = X.supplier_record(_pairs(spark, sf_dir), _base(spark, sf_dir))
    return X.concentration(record).select("agency_id", r("agency_hhi", 9))


@query("item_ratio_max")
def run_item_ratio_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.item_features(samples.items(spark, sf_dir), CUT).select(*KEY, r("item_ratio_max"))


@query("implausible_flag")
def run_implausible_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.item_features(samples.items(spark, sf_dir), CUT).select(*KEY, "has_implausible_item")


@query("no_winner_flag")
def run_no_winner_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _base(spark, sf_dir).join(X.participation(_pairs(spark, sf_dir)), KEY, "left")
    return rows.select(*KEY, X.no_winner())


@query("seasonal_deviation")
def run_seasonal_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.seasonal(_base(spark, sf_dir)).select("agency_id", "period", r("seasonal_deviation"))


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.feature_matrix(
        samples.notices(spark, sf_dir),
        samples.items(spark, sf_dir),
        samples.bids(spark, sf_dir),
        MIN_GROUP,
        CUT,
        stage=materialize,
    )


def _neutral_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(X.neutralize(_matrix(spark, sf_dir)))


@query("feature_matrix")
def run_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = [f for f in X.FEATURES if f in X.NEUTRAL]
    return _matrix(spark, sf_dir).select(
        *KEY, "period", *[r(f) for f in ratios], "no_winner", "has_implausible_item"
    )


# --- dimensions, merges and quality ---------------------------------------------------------


@query("dedupe_keep_last")
def run_dedupe_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = samples.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *order)
    kept = keep_last(lines, ["l_orderkey", "l_linenumber"], order)
    return kept.withColumn("l_shipdate", F.col("l_shipdate").cast("date").cast("string"))


def _dimension(name: str, batch: Callable[[SparkSession, str], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return merge.fold_upserts(batch(spark, sf_dir), name).select(*SERVING[name].names)

    QUERIES[f"{name}_dim"] = run


_dimension("modality", lambda spark, d: merge.modality_batch(samples.notices(spark, d)))
_dimension("agency", lambda spark, d: merge.agency_batch(samples.notices(spark, d)))
_dimension("unit", lambda spark, d: merge.unit_batch(samples.notices(spark, d)))
_dimension("supplier", lambda spark, d: merge.supplier_batch(samples.items(spark, d), samples.bids(spark, d)))


def _revised_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All notices, and every finished one published again a month later with changes."""
    first = samples.notices(spark, sf_dir)
    again = first.filter("status = 'F'").withColumns(
        {
            "status": F.lit("REVISED"),
            "value": (F.col("value") * 2).cast("decimal(18,4)"),
            "result_date": F.date_add("result_date", 15),
            "subject": F.lit("changed"),
            "period": P.shift(F.col("period"), 1),
        }
    )
    return first.unionByName(again)


def _revised_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bids, and the winning bids of finished notices sent again a month later."""
    first = samples.bids(spark, sf_dir)
    finished = samples.notices(spark, sf_dir).filter("status = 'F'").select(*KEY)
    again = first.filter("is_winner").join(finished, KEY, "left_semi")
    return first.unionByName(again.withColumn("period", P.shift(F.col("period"), 1)))


@query("upsert_notices")
def run_upsert_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = merge.fold_upserts(merge.notice_batch(_revised_notices(spark, sf_dir)), "notice")
    return folded.select(
        *KEY, "process_no", "subject", "status", "period", F.col("value").cast("double").alias("value"),
        F.col("opening_date").cast("string").alias("opening_date"), F.col("result_date").cast("string").alias("result_date"),
    )


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices that are not pending, folded over their batches."""
    batch = merge.notice_batch(_revised_notices(spark, sf_dir).filter("status <> 'P'"))
    return merge.fold_upserts(batch, "notice")


@query("replace_children")
def run_replace_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.createDataFrame([], SERVING["bid"])
    batch = merge.child_batch(_revised_bids(spark, sf_dir), "bid")
    return merge.replace_children(stored, batch, _loaded(spark, sf_dir))


@query("integrity_report")
def run_integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run on unmerged batches without the pending notices, so that checks find something."""
    notices = _revised_notices(spark, sf_dir).filter("status <> 'P'")
    agencies = merge.fold_upserts(merge.agency_batch(notices), "agency")
    placed = with_agency(notices, samples.units(spark, sf_dir))
    series = placed.groupBy("period", "agency_id", "modality_id").agg(
        F.count(F.lit(1)).alias("notice_count"), F.sum("value").alias("total_value")
    )
    return integrity_report(
        notices,
        samples.items(spark, sf_dir),
        samples.bids(spark, sf_dir),
        samples.units(spark, sf_dir),
        agencies,
        series,
        _supplier_series(spark, sf_dir),
    )


@query("load_accounting")
def run_load_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = _revised_notices(spark, sf_dir).filter("status <> 'P'")
    bids = _revised_bids(spark, sf_dir)
    read = notices.groupBy("period").agg(F.count(F.lit(1)).alias("rows")).unionByName(
        bids.groupBy("period").agg(F.count(F.lit(1)).alias("rows"))
    )
    batch = merge.notice_batch(notices)
    inserted = merge.inserted_counts(batch, [(merge.child_batch(bids, "bid"), _loaded(spark, sf_dir))])
    return merge.accounting(read, inserted)


@query("last_ingestion")
def run_last_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last row of a log in which all periods of a year ended together."""
    log = samples.notices(spark, sf_dir).groupBy("period").agg(F.count(F.lit(1)).alias("rows_read"))
    return latest(log.withColumn("finished_at", F.substring("period", 1, 4)), "finished_at", "period")


@query("silver_roundtrip")
def run_silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periods written to silver, one of them replaced, two years read back."""
    root = scratch_folder(spark)
    notices = samples.notices(spark, sf_dir)
    write_silver(notices, root, "notice")
    write_silver(notices.filter(F.col("period") == REPLACED).withColumn("status", F.lit("again")), root, "notice")
    back = read_silver(spark, root, "notice", listing("199501", "199612"))
    return back.select(*KEY, "period", "status", F.col("value").cast("double").alias("value"))


@query("load_twice")
def run_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two successive loads onto written tables, in which later periods name notices of earlier ones again."""
    root = scratch_folder(spark)
    silver, tables = f"{root}/silver", Tables(spark, f"{root}/serving")
    notices = _revised_notices(spark, sf_dir)
    write_silver(notices, silver, "notice")
    write_silver(_revised_bids(spark, sf_dir), silver, "bid")
    periods = sorted(row["period"] for row in notices.select("period").distinct().collect())  # months
    for part in (periods[: len(periods) // 2], periods[len(periods) // 2 :]):
        load(spark, silver, tables, part)
    # The children of a notice are those of its last period.
    bids = tables.read("bid").groupBy(*KEY).agg(F.count(F.lit(1)).alias("bids"), F.count_if("is_winner").alias("wins"))
    notice = tables.read("notice").select(*KEY, "status", "period", F.col("value").cast("double").alias("value"))
    return notice.join(bids, KEY, "left")


@query("load_log")
def run_load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a load in which one month lacks a column and one is missing, and of that month loaded again when mended."""
    root = scratch_folder(spark)
    silver, tables = f"{root}/silver", Tables(spark, f"{root}/serving")
    notices = samples.notices(spark, sf_dir)
    torn = F.when((F.col("period") != REPLACED) | (F.col("status") != "F"), F.col("agency_name"))
    write_silver(notices.withColumn("agency_name", torn), silver, "notice")
    write_silver(samples.items(spark, sf_dir), silver, "item")
    write_silver(samples.bids(spark, sf_dir), silver, "bid")
    periods = sorted(row["period"] for row in notices.select("period").distinct().collect())  # months
    load(spark, silver, tables, [*periods, "209912"])
    rows = {"failed": tables.read("notice").count()}
    write_silver(notices.filter(F.col("period") == REPLACED), silver, "notice")
    load(spark, silver, tables, [REPLACED])
    rows["success"] = tables.read("notice").count()
    log = tables.read("ingestion_log")
    newest = last_ingestion(tables).select("period", "finished_at", F.lit(True).alias("newest"))
    return log.join(newest, ["period", "finished_at"], "left").select(
        "period", "file", "status", "rows_read", "rows_inserted", "rows_updated", "rows_rejected", "error",
        F.coalesce("newest", F.lit(False)).alias("newest"),
        F.when(F.col("period") == REPLACED, F.when(F.col("status") == "success", rows["success"]).otherwise(rows["failed"])).cast("long").alias("notices"),
    )


@query("train_runs")
def run_train_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored after three training runs, the second in place of the first: forecasts with the record of their run."""
    tables = Tables(spark, f"{scratch_folder(spark)}/serving")
    tables.replace("monthly_series", _counts_and_totals(spark, sf_dir))
    for grouping, h in (("agency", 3), ("agency", HORIZON), ("global", 3)):
        train(tables, grouping, h)
    runs = tables.read("model_run")
    of_type = runs.groupBy("run_type").agg(F.count(F.lit(1)).alias("records"))
    number = lambda text, name: F.get_json_object(text, f"$.{name}").cast("int").alias(name)
    record = runs.join(of_type, "run_type").select(
        "run_id", "run_type", "records", "algorithm", "window_start", "window_end",
        number("params", "horizon"), number("params", "min_train"), number("metrics", "series_trained"), number("metrics", "series_dropped"),
    )
    return tables.read("forecast").select("run_id", "run_type", "series_key", "target", "target_period").join(record, ["run_id", "run_type"], "left").drop("run_id")


@query("latest_batch")
def run_latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = samples.notices(spark, sf_dir)
    log = notices.groupBy("period").agg(F.count(F.lit(1)).alias("rows_read"))
    return latest(log, "period")


# --- series -------------------------------------------------------------------------------


def _agency_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regroup(_counts_and_totals(spark, sf_dir), "agency")


def _points(spark: SparkSession, sf_dir: str, min_train: int = MIN_TRAIN) -> DataFrame:
    # A few rows per agency and month, read by the bounds, the calendar and the models.
    return training_points(materialize(_agency_series(spark, sf_dir)), min_train, HORIZON)


@query("dense_calendar")
def run_dense_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_unit = samples.notices(spark, sf_dir).groupBy("period", F.concat_ws(":", F.lit("unit"), "unit_id").alias("series_key")).agg(
        F.count(F.lit(1)).alias("notice_count"), F.coalesce(F.sum("value"), F.lit(0)).alias("total_value")
    )
    dense = S.densify(by_unit, S.series_bounds(by_unit))
    return dense.select("series_key", "period", "pos", "n_points", "quantity", r("value", 4))


@query("eligible_series")
def run_eligible_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = samples.notices(spark, sf_dir).groupBy("period", F.col("unit_id").alias("series_key")).agg(
        F.count(F.lit(1)).alias("notice_count")
    )
    bounds = S.series_bounds(series)
    kept = S.eligible(bounds, LONG_TRAIN, HORIZON).select("series_key", "start", "end", "n_points")
    counts = S.selection_counts(bounds, LONG_TRAIN, HORIZON)
    totals = counts.select(F.lit("eligible/dropped").alias("series_key"), F.col("eligible").cast("string").alias("start"), F.col("dropped").cast("string").alias("end"), F.lit(0).alias("n_points"))
    return kept.unionByName(totals)


@query("seasonal_naive")
def run_seasonal_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.seasonal_naive(_points(spark, sf_dir), HORIZON + 6).withColumn("predicted", F.round("predicted", 4))


@query("backtest_windows")
def run_backtest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.backtest_windows(S.series_bounds(_agency_series(spark, sf_dir)), HORIZON, MIN_TRAIN)


@query("backtest_metrics")
def run_backtest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal naive against repeating the last value, which is the naive of season one."""
    points = _points(spark, sf_dir)
    at = ["series_key", "target", "origin", "step"]
    last = S.backtest_naive(points, HORIZON, MIN_TRAIN, m=1).select(*at, F.col("predicted").alias("baseline"))
    paired = S.backtest_naive(points, HORIZON, MIN_TRAIN).join(last, at, "left")
    errors = error_metrics(paired, ["series_key", "target"], "observed", "predicted", "baseline")
    return errors.select("series_key", "target", r("mae"), r("rmse"), r("mape"), "mape_skipped", r("mase"))


@query("forecast")
def run_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast(_points(spark, sf_dir), HORIZON)


@query("forecast_frame")
def run_forecast_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for every forecast whatever the fit: its months, the order of its bounds, none below zero."""
    sound = (F.col("lower") <= F.col("predicted")) & (F.col("predicted") <= F.col("upper")) & (F.col("lower") >= 0)
    return forecast(_points(spark, sf_dir), HORIZON).select("series_key", "target", "step", "target_period", sound.alias("sound"))


@query("backtest_model")
def run_backtest_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backtest(_points(spark, sf_dir), HORIZON)


@query("forecast_fit")
def run_forecast_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Autoregressions of the given orders with what they forecast, as parts of the mean of their series."""
    points = materialize(_points(spark, sf_dir))

    def fitted(lags: list[int]) -> DataFrame:
        at = {k: F.col("phi")[i] for i, k in enumerate(lags)}
        ahead = forecast_orders(points, lags, FIT_AHEAD).groupBy("series_key", "target").pivot("step", list(range(1, FIT_AHEAD + 1))).agg(F.first("predicted"))
        part = lambda c, digits=6: F.round(F.col(c) / F.col("mean"), digits)
        return fit_orders(points, lags).join(ahead, ["series_key", "target"]).select(
            "series_key", "target", F.lit("+".join(map(str, lags))).alias("lags"), "n",
            *[F.round(at.get(k, F.lit(None).cast("double")), 6).alias(f"phi_{k}") for k in (1, 12)],
            part("intercept").alias("level"), F.round(F.sqrt("variance") / F.col("mean"), 6).alias("noise"),
            *[part(str(k)).alias(f"step_{k}") for k in range(1, FIT_AHEAD + 1)],
        )

    return reduce(DataFrame.unionByName, [fitted(lags) for lags in ORDERS])


@query("backtest_frame")
def run_backtest_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for every backtest whatever the fit: its points and windows, what is skipped, the baseline's error."""
    paired = materialize(backtest_pairs(_points(spark, sf_dir), HORIZON))
    by = ["series_key", "target"]
    errors = error_metrics(paired, by, "observed", "predicted", "baseline")
    answered = F.count_if(F.col("predicted") >= 0)
    held = paired.groupBy(*by).agg(
        F.count(F.lit(1)).alias("points"), answered.alias("answered"), F.count_distinct("origin").alias("windows"),
        F.min("origin").alias("first_origin"), F.round(F.sum("observed"), 4).alias("observed"),
    )
    baseline = F.round(F.col("mae") / F.col("mase"), 6).alias("baseline_mae")
    return held.join(errors, by).select(*held.columns, "mape_skipped", baseline, (F.col("mae") <= F.col("rmse") * (1 + 1e-12)).alias("sound"))


# --- detector -----------------------------------------------------------------------------


@query("robust_scale")
def run_robust_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = _neutral_matrix(spark, sf_dir)
    scaler = RobustScaler.fit(matrix, X.FEATURES)
    return matrix.select(*KEY, *[F.round(scaler.z(f), 5).alias(f) for f in X.FEATURES])


@query("contributions_top5")
def run_contributions_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = _neutral_matrix(spark, sf_dir)
    scaler = RobustScaler.fit(matrix, X.FEATURES)
    ranked = matrix.select(*KEY, F.posexplode(scaler.contributions(X.FEATURES, 5)).alias("pos", "c"))
    return ranked.select(*KEY, (F.col("pos") + 1).alias("position"), F.col("c.feature").alias("feature"), F.round("c.deviation", 4).alias("deviation"))


@query("global_rank")
def run_global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    notices = samples.notices(spark, sf_dir).select(*KEY, "value")
    order = [F.col("value").desc_nulls_last(), *[F.col(k).asc() for k in KEY]]
    return number_rows(notices, order).withColumn("value", F.col("value").cast("double"))


@query("perturb")
def run_perturb(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = perturb(_neutral_matrix(spark, sf_dir), 200, SEED)
    return out.select(*KEY, "perturbed", *[r(f, 5) for f in X.FEATURES])


@query("isolation_score")
def run_isolation_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = isolation_score(_neutral_matrix(spark, sf_dir), X.FEATURES, KEY, SEED)
    return scored.select(*KEY, "score")


@query("forest_draws")
def run_forest_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notices that each tree of the forest grows from, in the order of their draws."""
    notices = samples.notices(spark, sf_dir).select(*KEY)
    rows = subsamples(notices, [], KEY, SEED, notices.count())
    return rows.select(*KEY, F.col("_tree").alias("tree"), F.col("_position").alias("position"))


@query("forest_walk")
def run_forest_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all notices by a stored node table."""
    stored = materialize(spark.createDataFrame(WALK_NODES, NODE_SCHEMA))
    forest = IsolationForest.of_nodes(stored, X.FEATURES, WALK_ROWS)
    return forest.score(_neutral_matrix(spark, sf_dir).select(*KEY, *X.FEATURES)).select(*KEY, F.round("score", 9).alias("score"))


@query("score_job")
def run_score_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, scaler = score_matrix(_neutral_matrix(spark, sf_dir), SEED)
    loaded = samples.notices(spark, sf_dir).select(*KEY, "period")
    # Range partitioning reads its input twice: the forest must not walk every row for each.
    ranked = rank_scores(materialize(scored.drop("period").join(loaded, KEY)))
    return ranked.select(
        *KEY, "period", F.round("score", 6).cast("decimal(12,6)").alias("score"), "rank", explanation(scaler).alias("features")
    )


@query("score_frame")
def run_score_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for every score whatever the forest: one per notice, its range, values and contributions."""
    scored, scaler = score_matrix(_neutral_matrix(spark, sf_dir), SEED)
    loaded = samples.notices(spark, sf_dir).select(*KEY, "period")
    text = scored.drop("period").join(loaded, KEY).withColumn("features", explanation(scaler))
    schema = "values map<string,double>, contributions array<struct<feature:string,deviation:double>>"
    read = text.withColumn("read", F.from_json("features", schema))
    return read.select(
        *KEY, "period",
        ((F.col("score") > 0) & (F.col("score") <= 1)).alias("in_range"),
        F.size("read.values").alias("n_values"),
        F.size("read.contributions").alias("n_contributions"),
        F.transform("read.contributions", lambda c: c["feature"])[0].alias("first_feature"),
    )


# --- ingest -------------------------------------------------------------------------------


@query("archive_report")
def run_archive_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = ingest_report(unpack(bundles.archives(spark, sf_dir)))
    return report.withColumn("missing_tables", F.concat_ws(",", "missing_tables"))


@query("archive_notices")
def run_archive_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(unpack(bundles.archives(spark, sf_dir)), "notice")
    dates = {c: F.col(c).cast("string") for c in ("result_date", "opening_date")}
    return parsed.drop("line_no").withColumns({**dates, "value": F.col("value").cast("double")})


@query("archive_ingest")
def run_archive_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and bids read back from archives: amounts and winners per period."""
    silver = unpacked_as_silver(unpack(bundles.archives(spark, sf_dir)))
    amounts = silver["item"].groupBy("period").agg(
        F.count(F.lit(1)).alias("items"), F.sum(F.col("quantity") * F.col("unit_value")).cast("double").alias("amount")
    )
    winners = silver["bid"].groupBy("period").agg(
        F.count(F.lit(1)).alias("bids"), F.count_if("is_winner").alias("winning_bids"), F.count_distinct("bidder_id").alias("bidders")
    )
    return amounts.join(winners, "period", "left")


@query("bronze_ingest")
def run_bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive files written, ingested and read back row by row; each month has a second file that revises notices of the first."""
    root = scratch_folder(spark)
    notices = samples.notices(spark, sf_dir)
    ordered = notices.sortWithinPartitions("period")
    revisions = F.when(F.col("status") == "F", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))
    parts = ordered.withColumn("part", F.explode(revisions))
    parts = parts.withColumn("status", F.when(F.col("part") == "b", "REVISED").otherwise(F.col("status")))
    of_notices = bundles.csv_lines(parts, "notice", keep=["part"])
    of_lines = bundles.csv_lines(samples.items_and_bids(spark, sf_dir), "item", "bid").withColumn("part", F.lit("a"))
    bundles.write_archives(of_notices.unionByName(of_lines), f"{root}/bronze")
    periods = sorted(row["period"] for row in notices.select("period").distinct().collect())  # months
    report = ingest(spark, f"{root}/bronze", f"{root}/silver", periods)
    outcome = report.select("period", F.coalesce("error", F.when(F.col("partial"), "partial").otherwise("intact")).alias("outcome"))
    silver = {t: read_silver(spark, f"{root}/silver", t) for t in ("notice", "item", "bid")}

    def rows(table: str, code: str, who: str, number: str) -> DataFrame:
        text = lambda c: F.lit(None).cast("string") if not c else F.col(c)
        df = silver[table]
        if table == "notice":
            df = keep_last(df.select(*KEY, "period", "line_no", who, number), KEY, ["line_no"])
        return df.select(F.lit(table).alias("table"), *KEY, "period", text(code).alias("code"), text(who).alias("who"), F.col(number).cast("double").alias("number"))

    every = rows("notice", "", "status", "value").union(rows("item", "item_code", "winner_id", "unit_value")).union(rows("bid", "item_code", "bidder_id", "is_winner"))
    # A row per month; planned by its size only after the rows have been shuffled for it.
    return every.join(F.broadcast(outcome), "period")
