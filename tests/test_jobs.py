"""The five jobs end to end on silver written by hand."""

import json

import pytest
from pyspark.sql import functions as F

from tenderlake.functions.periods import listing
from tenderlake.operators import merge
from tenderlake.operators.quality import integrity_report
from tenderlake.plans import load as plan
from tenderlake.plans.aggregate import aggregate_series, aggregate_suppliers
from tenderlake.plans.load import last_ingestion, load
from tenderlake.plans.score import score
from tenderlake.plans.train import train
from tenderlake.schemas import KEY, SERVING, SILVER
from tenderlake.sources.silver import write_silver
from tenderlake.sources.tables import Tables


def notice(no, period, line, **changes):
    row = dict(
        notice_no=no, unit_id="10", unit_name="Unit", modality_id=5, modality_name="Auction", process_no="p",
        subject="s", status="open", parent_agency_id="1", parent_agency_name="Parent", agency_id="2",
        agency_name="Agency", state="DF", city="c", result_date=None, opening_date=None, value=None,
        line_no=line, period=period,
    )
    return {**row, **changes}


def item(no, period, line, code="i1", winner="111"):
    return dict(
        notice_no=no, unit_id="10", modality_id=5, item_code=code, description="d", quantity=None, unit_value=None,
        winner_id=winner, winner_name=f"N{winner}", line_no=line, period=period,
    )


def bid(no, period, line, bidder="111", won=True):
    return dict(
        notice_no=no, unit_id="10", modality_id=5, item_code="i1", bidder_id=bidder, bidder_name=f"N{bidder}",
        is_winner=won, line_no=line, period=period,
    )


def put(spark, silver, **tables):
    for table, rows in tables.items():
        names = SILVER[table].names
        write_silver(spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SILVER[table]), silver, table)


@pytest.fixture
def lake(spark, tmp_path):
    return str(tmp_path / "silver"), Tables(spark, str(tmp_path / "serving"))


@pytest.fixture
def january(spark, lake):
    silver, tables = lake
    put(
        spark, silver,
        notice=[notice("1", "202401", 0), notice("2", "202401", 1, agency_id="1", agency_name="Parent", unit_id="11"),
                notice("1", "202401", 2, status="closed")],
        item=[item("1", "202401", 0), item("1", "202401", 1, "i2", ""), item("9", "202401", 2)],
        bid=[bid("1", "202401", 0), bid("1", "202401", 1, "222", False)],
    )
    return load(spark, silver, tables, ["202401", "209912"])


def counts(tables, names=("modality", "agency", "unit", "supplier", "notice", "item", "bid")):
    return {t: tables.read(t).count() for t in names}


def test_load_fills_dimensions_and_facts(spark, lake, january):
    tables = lake[1]
    assert counts(tables) == {"modality": 1, "agency": 2, "unit": 2, "supplier": 2, "notice": 2, "item": 2, "bid": 2}
    assert tables.read("notice").filter("notice_no = '1'").first().status == "closed"
    # Agency 1 is a parent and a member: its parent comes from the member role.
    assert {r.agency_id: r.parent_agency_id for r in tables.read("agency").collect()} == {"2": "1", "1": "1"}


def test_children_are_written_once(spark, lake, monkeypatch):
    silver, tables = lake
    staged, real = [], plan.materialize
    monkeypatch.setattr(plan, "materialize", lambda df, *args: staged.append(df.columns) or real(df, *args))
    put(spark, silver, notice=[notice("1", "202401", 0)], item=[item("1", "202401", 0)], bid=[bid("1", "202401", 0)])
    load(spark, silver, tables, ["202401"])
    assert staged and not any("item_code" in columns for columns in staged)
    assert counts(tables, ("notice", "item", "bid")) == {"notice": 1, "item": 1, "bid": 1}


def test_load_logs_every_period(spark, lake, january):
    log = {r.period: r for r in lake[1].read("ingestion_log").collect()}
    good, bad = log["202401"], log["209912"]
    assert (good.status, good.rows_read, good.rows_inserted, good.rows_rejected) == ("success", 8, 6, 2)
    assert bad.status == "error" and "silver" in bad.error and bad.rows_read == 0
    assert [r.period for r in last_ingestion(lake[1]).collect()] == ["209912"]


def test_last_ingestion_of_one_load_is_its_last_period(spark, lake):
    silver, tables = lake
    periods = ["202401", "202402", "202403"]
    put(spark, silver, notice=[notice(str(i), p, 0) for i, p in enumerate(periods)])
    load(spark, silver, tables, periods)
    assert [r.period for r in last_ingestion(tables).collect()] == ["202403"]


def test_a_corrupt_period_is_logged_and_the_others_load(spark, lake, tmp_path):
    silver, tables = lake
    put(spark, silver, notice=[notice("1", "202401", 0), notice("2", "202402", 0)], item=[item("1", "202401", 0), item("2", "202402", 0)])
    for file in (tmp_path / "silver" / "item" / "period=202402").glob("*.parquet"):
        file.write_bytes(b"PAR1 not parquet PAR1")
    log = {r.period: r for r in load(spark, silver, tables, ["202401", "202402"]).collect()}
    assert log["202401"].status == "success" and log["202402"].status == "error" and log["202402"].error
    assert [r.notice_no for r in tables.read("notice").collect()] == ["1"]
    assert tables.read("item").count() == 1


def test_loading_again_changes_nothing(spark, lake, january):
    silver, tables = lake
    before = {t: sorted(map(str, tables.read(t).collect())) for t in merge.KEYS} | counts(tables)
    load(spark, silver, tables, ["202401"])
    assert {t: sorted(map(str, tables.read(t).collect())) for t in merge.KEYS} | counts(tables) == before


def february(spark, silver):
    put(
        spark, silver,
        notice=[notice("1", "202402", 0, status="revised", subject="other", unit_name="Renamed", agency_id="3"),
                notice("3", "202402", 1, unit_name="Renamed")],
        item=[item("1", "202402", 0, "i9"), item("2", "202402", 1)],
        bid=[bid("3", "202402", 0, "333")],
    )


@pytest.mark.parametrize("together", [False, True])
def test_a_later_period_updates_and_replaces(spark, lake, together):
    """Two loads one after the other and one load of both periods end in the same state."""
    silver, tables = lake
    put(
        spark, silver,
        notice=[notice("1", "202401", 0), notice("2", "202401", 1, unit_id="10")],
        item=[item("1", "202401", 0), item("1", "202401", 1, "i2")],
        bid=[bid("1", "202401", 0), bid("2", "202401", 1)],
    )
    february(spark, silver)
    if together:
        load(spark, silver, tables, ["202401", "202402"])
    else:
        load(spark, silver, tables, ["202401"])
        load(spark, silver, tables, ["202402"])
    one = tables.read("notice").filter("notice_no = '1'").first()
    assert (one.status, one.subject, one.period) == ("revised", "s", "202401")
    unit = tables.read("unit").first()
    assert (unit.name, unit.agency_id) == ("Renamed", "2")
    items = {(r.notice_no, r.item_code, r.period) for r in tables.read("item").collect()}
    # Notice 2 is absent from the second notice file, yet stored: its item is accepted.
    assert items == {("1", "i9", "202401"), ("2", "i1", "202401")}
    bids = {(r.notice_no, r.bidder_id, r.period) for r in tables.read("bid").collect()}
    assert bids == {("1", "111", "202401"), ("2", "111", "202401"), ("3", "333", "202402")}


def test_period_with_incomplete_notices_fails_alone(spark, lake):
    silver, tables = lake
    put(spark, silver, notice=[notice("1", "202401", 0), notice("2", "202402", 0, modality_id=None)])
    load(spark, silver, tables, ["202401", "202402"])
    log = {r.period: r.status for r in tables.read("ingestion_log").collect()}
    assert log == {"202401": "success", "202402": "error"}
    assert tables.read("notice").count() == 1


def test_child_before_its_notice_is_dropped(spark):
    owner = notice("1", "202402", 0)
    notices = spark.createDataFrame([tuple(owner[n] for n in SILVER["notice"].names)], SILVER["notice"])
    folded = merge.fold_upserts(merge.notice_batch(notices), "notice")
    rows = [item("1", "202401", 0, "early"), item("1", "202402", 0, "kept")]
    items = spark.createDataFrame([tuple(r[n] for n in SILVER["item"].names) for r in rows], SILVER["item"])
    kept = merge.replace_children(spark.createDataFrame([], SERVING["item"]), merge.child_batch(items, "item"), folded)
    assert [r.item_code for r in kept.collect()] == ["kept"]


def test_integrity_of_a_load(spark, lake, january):
    tables = lake[1]
    aggregate_series(tables)
    aggregate_suppliers(spark, lake[0], tables)
    report = integrity_report(
        *(tables.read(t) for t in ("notice", "item", "bid", "unit", "agency", "monthly_series", "supplier_series"))
    )
    assert {r["check"] for r in report.collect() if r.violations} == set()


def test_aggregate_reconciles_and_reruns(spark, lake, january):
    silver, tables = lake
    assert aggregate_series(tables) == 2
    assert aggregate_suppliers(spark, silver, tables) == (2, 2)
    assert tables.read("monthly_series").agg(F.sum("notice_count")).first()[0] == tables.read("notice").count()
    assert aggregate_series(tables) == 2 and tables.read("monthly_series").count() == 2


def test_aggregate_of_nothing(spark, lake):
    silver, tables = lake
    assert aggregate_series(tables) == 0 and aggregate_suppliers(spark, silver, tables) == (0, 0)


def monthly(spark, tables, months):
    rows = [(p, "26000", 5, 100 + (i % 12) * 10) for i, p in enumerate(months)]
    df = spark.createDataFrame(rows, "period string, agency_id string, modality_id int, notice_count long")
    tables.replace("monthly_series", df.withColumn("total_value", (F.col("notice_count") * 10).cast("decimal(38,4)")))


def test_train_writes_future_months_and_replaces_its_run(spark, lake):
    tables = lake[1]
    monthly(spark, tables, listing("201301", "201612"))
    result = train(tables, "agency", 6)
    assert (result.series_trained, result.series_dropped, result.forecasts_written) == (1, 0, 12)
    train(tables, "agency", 3)
    train(tables, "global", 3)
    rows = tables.read("forecast").filter("run_type = 'forecast:agency'").collect()
    assert len(rows) == 6 and {r.series_key for r in rows} == {"agency:26000"}
    assert {r.target_period for r in rows} == {"201701", "201702", "201703"}
    assert {r.target for r in rows} == {"quantity", "value"}
    runs = {r.run_type: r for r in tables.read("model_run").collect()}
    assert set(runs) == {"forecast:agency", "forecast:global"}
    run = runs["forecast:agency"]
    assert (run.window_start, run.window_end) == ("201301", "201612")
    assert json.loads(run.params)["horizon"] == 3 and {r.run_id for r in rows} == {run.run_id}


def test_train_drops_short_series_and_still_records(spark, lake):
    tables = lake[1]
    monthly(spark, tables, listing("201301", "201612"))
    train(tables, "agency", 3)
    monthly(spark, tables, listing("201301", "201408"))
    result = train(tables, "agency", 12)
    assert (result.series_trained, result.series_dropped, result.forecasts_written) == (0, 1, 0)
    assert tables.read("forecast").filter("run_type = 'forecast:agency'").count() == 0
    assert tables.read("model_run").count() == 1
    with pytest.raises(ValueError):
        train(tables, "unit")


def test_score_ranks_loaded_notices(spark, lake, january):
    silver, tables = lake
    # A notice that was never loaded takes part in the features and gets no score.
    put(spark, silver, notice=[notice("7", "202405", 0)])
    assert score(spark, silver, tables) == 2
    assert score(spark, silver, tables, seed=7) == 2
    rows = tables.read("notice_score").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2] and rows[0].score >= rows[1].score
    assert {r.period for r in rows} == {"202401"} and len({tuple(r[k] for k in KEY) for r in rows}) == 2
    assert len(json.loads(rows[0].features)["contributions"]) == 5
    run = tables.read("model_run").filter("run_type = 'anomaly:notice'").collect()
    assert len(run) == 1 and json.loads(run[0].metrics) == {"scored": 2}


def test_score_of_nothing_keeps_the_old_rows(spark, lake, january, tmp_path):
    silver, tables = lake
    score(spark, silver, tables)
    assert score(spark, str(tmp_path / "none"), tables) == 0
    assert tables.read("notice_score").count() == 2
