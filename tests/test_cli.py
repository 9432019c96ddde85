import pytest

from tenderlake.cli import main
from tenderlake.session import job_scratch, materialize
from tenderlake.sources.files import any_match
from test_archives import archive


@pytest.mark.parametrize(
    "argv",
    [
        ["ingest", "--start", "202413", "--end", "202401"],
        ["load", "--start", "202402", "--end", "202401"],
        ["train", "--series", "unit"],
        ["ingest", "--start", "202401"],
        [],
    ],
)
def test_bad_arguments_are_refused(argv):
    with pytest.raises(SystemExit):
        main(["--data", "/nowhere", *argv])


def test_jobs_run_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "bronze").mkdir()
    (tmp_path / "bronze" / "202401.zip").write_bytes(archive())
    for job in (
        ["ingest", "--start", "202401", "--end", "202402"],
        ["load", "--start", "202401", "--end", "202401"],
        ["aggregate"],
        ["train", "--series", "global", "--horizon", "3"],
        ["score", "--seed", "1"],
    ):
        main(["--data", str(tmp_path), *job])
    out = capsys.readouterr().out
    assert "archive unavailable" in out and "series_trained=0" in out


def test_a_job_leaves_nothing_behind(spark):
    with pytest.raises(ZeroDivisionError), job_scratch(spark) as folder:
        assert materialize(spark.range(3)).count() == 3 and any_match(spark, folder + "/*")
        1 / 0
    assert not any_match(spark, folder)
