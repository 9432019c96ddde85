"""Serving tables change by commits: together, or not at all."""

import pytest

from tenderlake.plans.load import load
from tenderlake.plans.train import train
from tenderlake.sources import tables as module
from tenderlake.sources.files import matches
from tenderlake.sources.tables import ConflictError, Tables
from test_jobs import bid, february, item, lake, monthly, notice, put  # noqa: F401
from tenderlake.functions.periods import listing

ALL = ("modality", "agency", "unit", "supplier", "notice", "item", "bid", "ingestion_log")


class Died(BaseException):
    """What no handler of a job may swallow."""


def state(spark, root, names=ALL):
    tables = Tables(spark, root)
    return {t: sorted(map(str, tables.read(t).collect())) for t in names}


def loaded(spark, silver, tables):
    put(
        spark, silver,
        notice=[notice("1", "202401", 0), notice("2", "202401", 1)],
        item=[item("1", "202401", 0), item("1", "202401", 1, "i2")],
        bid=[bid("1", "202401", 0), bid("2", "202401", 1)],
    )
    load(spark, silver, tables, ["202401"])


def test_a_load_that_dies_at_any_write_changes_nothing(spark, lake, monkeypatch):  # noqa: F811
    silver, tables = lake
    loaded(spark, silver, tables)
    february(spark, silver)
    before = state(spark, tables.root)
    real, made, last = Tables._write, 0, 0

    def write(self, *args):
        nonlocal made
        made += 1
        if made > last:
            raise Died
        real(self, *args)

    monkeypatch.setattr(Tables, "_write", write)
    for last in (0, 4, len(ALL) - 1):
        made = 0
        with pytest.raises(Died):
            load(spark, silver, Tables(spark, tables.root), ["202401", "202402"])
        assert state(spark, tables.root) == before
    made, last = 0, len(ALL)
    load(spark, silver, Tables(spark, tables.root), ["202401", "202402"])
    monkeypatch.undo()
    assert made == len(ALL)
    after = state(spark, tables.root)
    assert all(after[t] != before[t] for t in ("unit", "notice", "item", "bid", "ingestion_log"))
    # Dying before the manifest is published is no different, and what died is cleared away.
    monkeypatch.setattr(module, "write_text", lambda *a: (_ for _ in ()).throw(Died))
    with pytest.raises(Died):
        load(spark, silver, Tables(spark, tables.root), ["202401"])
    monkeypatch.undo()
    assert state(spark, tables.root) == after
    assert Tables(spark, tables.root).vacuum() > len(ALL)
    assert state(spark, tables.root) == after and Tables(spark, tables.root).vacuum() == 0


def test_a_failing_write_takes_back_its_period_only(spark, lake, monkeypatch):  # noqa: F811
    """The pass over both periods fails at its last fact table, then February fails there again."""
    silver, tables = lake
    put(spark, silver, notice=[notice("1", "202401", 0), notice("2", "202402", 0, unit_name="Renamed")], bid=[bid("1", "202401", 0), bid("2", "202402", 0, "222")])
    real = Tables.replace_partitions

    def write(self, name, df, partition):
        if name == "notice" and df.filter("notice_no = '2'").count():
            raise OSError("no space left")
        real(self, name, df, partition)

    monkeypatch.setattr(Tables, "replace_partitions", write)
    log = {r.period: r for r in load(spark, silver, tables, ["202401", "202402"]).collect()}
    monkeypatch.undo()
    assert (log["202401"].status, log["202402"].status) == ("success", "error") and "no space" in log["202402"].error
    assert [r.notice_no for r in tables.read("notice").collect()] == ["1"]
    assert [r.bidder_id for r in tables.read("bid").collect()] == ["111"] and tables.read("supplier").count() == 1
    assert tables.read("unit").first().name == "Unit"
    assert load(spark, silver, tables, ["202402"]).first().status == "success"
    assert tables.read("bid").count() == 2 and tables.read("ingestion_log").count() == 3


def test_readers_keep_their_rows_and_old_folders_go(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    make = lambda i: spark.createDataFrame([(i,)], "n int")
    tables.replace("numbers", make(0))
    reader = tables.read("numbers")
    tables.replace("numbers", make(1))
    assert reader.first().n == 0 and tables.read("numbers").first().n == 1
    for i in range(2, 7):
        tables.replace("numbers", make(i))
    assert len(matches(spark, f"{tmp_path}/numbers/*")) == module.KEPT == len(matches(spark, f"{tmp_path}/_commits/*"))


def test_partitions_appends_and_nested_commits(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    runs = lambda *r: spark.createDataFrame([(f"id{i}", t, None, t, "p", float(i), 0.0, 1.0) for i, t in r], "run_id string, run_type string, series_key string, target_period string, target string, predicted double, lower double, upper double")
    with tables.commit():
        tables.replace_partitions("forecast", runs((1, "a:b"), (2, "c")), "run_type")
        with tables.commit():
            tables.replace_partitions("forecast", runs((3, "c")), "run_type")
        assert not Tables(spark, str(tmp_path)).exists("forecast")
    key = lambda: sorted((r.run_id, r.run_type) for r in tables.read("forecast").collect())
    assert key() == [("id1", "a:b"), ("id3", "c")]
    tables.clear_partition("forecast", "run_type", "a:b")
    tables.clear_partition("forecast", "run_type", "none")
    assert key() == [("id3", "c")]
    tables.clear_partition("forecast", "run_type", "c")
    assert key() == []
    with pytest.raises(ZeroDivisionError), tables.commit():
        tables.replace_partitions("forecast", runs((1, "a:b")), "run_type")
        raise ZeroDivisionError
    assert key() == []
    for i in range(module.PARTS + 3):
        tables.append("list", spark.createDataFrame([(i,)], "n int"))
    assert sorted(r.n for r in tables.read("list").collect()) == list(range(module.PARTS + 3))
    assert len(tables._state["list"]["paths"]) < module.PARTS
    with pytest.raises(FileNotFoundError):
        tables.read("never")


def test_a_second_writer_is_refused_and_a_cut_manifest_does_not_count(spark, tmp_path):
    one, two = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    df = lambda n: spark.createDataFrame([(n,)], "n int")
    one.replace("t", df(1))
    with pytest.raises(ConflictError), one.commit():
        one.replace("t", df(2))
        two.replace("t", df(3))
    assert two.read("t").first().n == one.read("t").first().n == 3
    (tmp_path / "_commits" / f"{9:010d}.json").write_text('{"t": {"pa')
    assert one.read("t").first().n == 3
    one.replace("t", df(4))
    assert two.read("t").first().n == 4


def test_a_training_run_that_dies_keeps_the_run_before(spark, lake, monkeypatch):  # noqa: F811
    tables = lake[1]
    monthly(spark, tables, listing("201301", "201612"))
    train(tables, "agency", 3)
    before = state(spark, tables.root, ("forecast", "model_run"))
    real = Tables.replace_partitions
    monkeypatch.setattr(Tables, "replace_partitions", lambda s, name, *a: real(s, name, *a) if name == "forecast" else (_ for _ in ()).throw(Died))
    with pytest.raises(Died):
        train(tables, "agency", 6)
    monkeypatch.undo()
    assert state(spark, tables.root, ("forecast", "model_run")) == before
