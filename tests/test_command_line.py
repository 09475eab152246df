from __future__ import annotations

import pytest

from lossmill.__main__ import _arguments, _settings, main
from tests.fixtures import PERIOD, write_sample


def test_all_steps_and_reports(spark, folder, capsys):
    paths = write_sample(folder)
    files = ["--premium", paths["premium"], "--claim", paths["claim"], "--regions", paths["region"]]
    main(["all", "--base", f"{folder}/layers", "--period", PERIOD, *files])
    shown = capsys.readouterr().out
    assert "0.7284" in shown and "|100.0" in shown and "DF - Brasília" in shown
    assert "source and written rows" in shown and "premium coverages" in shown
    main(["publish", "--base", f"{folder}/layers", "--period", PERIOD])
    assert "top alerts" in capsys.readouterr().out


@pytest.mark.parametrize("step", ["ingest", "refine", "all"])
def test_missing_files_are_named(step, capsys):
    with pytest.raises(SystemExit):
        main([step, "--base", "x", "--period", PERIOD])
    assert f"{step} needs --" in capsys.readouterr().err


def test_options_reach_the_settings(spark, folder):
    options = _arguments(
        ["publish", "--base", "b", "--period", "p", "--loss-threshold", "0.9", "--watch-threshold",
         "0.5", "--alert-threshold", "3", "--strict-numbers", "--rule", "claim_repeated",
         "--rule", "period_null", "--compact", "--may-be-empty", "p", "--repeated-claim-keys"]
    )
    run = _settings(options)
    assert (run.loss_threshold, run.watch_threshold, run.alert_threshold) == (0.9, 0.5, 3.0)
    assert run.strict_numbers and run.compact and run.repeated_claim_keys
    assert [r.code for r in run.rules[-2:]] == ["claim_repeated", "period_null"]
    assert run.may_be_empty == ("p",) and run.null_periods
    assert run.hot_claim_share == 0.02 and not run.quarantine_lines


def test_malformed_lines_and_hot_keys_are_options(spark, folder, capsys):
    paths = write_sample(folder)
    with open(paths["claim"], "a", encoding="ISO-8859-1") as f:
        f.write("38;too short\n")
    files = ["--premium", paths["premium"], "--claim", paths["claim"], "--regions", paths["region"]]
    options = ["--quarantine-lines", "--hot-claim-share", "0"]
    main(["all", "--base", f"{folder}/layers", "--period", PERIOD, *files, *options])
    assert "bronze_claim_lines" in capsys.readouterr().out
    given = _arguments(["publish", "--base", "b", "--period", "p", *options])
    assert _settings(given).hot_claim_share is None and _settings(given).quarantine_lines
