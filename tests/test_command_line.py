"""The command line: modes, the configuration file, what is logged, and the exit."""

import json

import pytest
from test_round_two import yes
from test_sources import FINAL, NO, config, reviewed_row, table_of

from sievemill import __main__ as cli
from sievemill.sources import workbooks


def arguments(tmp_path, *more):
    return ["--folder", f"file://{tmp_path}/run", "--query", "q", "--years", "2020", *more]


@pytest.fixture
def transports(tmp_path):
    return {**config(tmp_path).transports, "model": yes}


def test_a_whole_run_in_parts(spark, tmp_path, transports):
    run = lambda *more: cli.main(arguments(tmp_path, *more), spark, transports)
    assert run("--stop-before-ai") == 0
    text = (tmp_path / "run" / "pipeline.log").read_text()
    assert "stopped before classified" in text and "screened: " in text and json.loads((tmp_path / "run" / "config.json").read_text())["stop_before_ai"]
    with pytest.raises(FileExistsError):
        run()
    assert run("--resume", "--most-answers", "1") == 3
    assert run("--resume") == 0
    text = (tmp_path / "run" / "pipeline.log").read_text()
    assert text.index("stopped before") < text.index("paused: classified: 1 of") < text.index("curation: ")


def test_modes_exclude_one_another(spark, tmp_path, capsys):
    with pytest.raises(SystemExit):
        cli.options(arguments(tmp_path, "--curation-only", "--finalize-only"), spark)
    assert "not allowed with" in capsys.readouterr().err
    (tmp_path / "c.json").write_text('{"page_size": 7, "query": "other", "curation_only": true}')
    args = cli.options(arguments(tmp_path, "--config", f"file://{tmp_path}/c.json"), spark)
    assert (args.page_size, args.query) == (7, "q") and cli.config_of(args, {}).stages == ["curation"]
    with pytest.raises(ValueError, match="exclude one another"):
        cli.options(arguments(tmp_path, "--config", f"file://{tmp_path}/c.json", "--finalize-only"), spark)
    (tmp_path / "c.json").write_text('{"pages": 7}')
    with pytest.raises(ValueError, match="unknown options.*pages"):
        cli.options(arguments(tmp_path, "--config", f"file://{tmp_path}/c.json"), spark)


def test_a_part_needs_what_is_before_it(spark, tmp_path, transports):
    with pytest.raises(ValueError, match="stage search is needed"):
        cli.main(arguments(tmp_path, "--classify-only"), spark, transports)
    assert "the run failed" in (tmp_path / "run" / "pipeline.log").read_text()


def test_finalization_from_workbooks(spark, tmp_path):
    workbooks.write(table_of(spark, [{**FINAL, "id": "10"}, {**FINAL, "id": "9"}, {**FINAL, "id": "2", **NO}]), str(tmp_path / "curated"))
    rows = [reviewed_row("10", "9;10", "atlas", "10"), reviewed_row("9", "9;10", "atlas", "10", original48="yes")]
    workbooks.write(table_of(spark, rows, ("group", "members", "canonical", "representative")), str(tmp_path / "reviewed"))
    more = ("--finalize-only", "--curated", str(tmp_path / "curated"), "--reviewed", str(tmp_path / "reviewed"), "--neural-columns", "tissue")
    assert cli.main(arguments(tmp_path, *more), spark) == 0
    final = workbooks.read(spark, f"file://{tmp_path}/run/final", pos="pos").orderBy("pos").collect()
    assert [(r.id, r.original48) for r in final] == [("2", "no"), ("10", "yes")]
    with pytest.raises(ValueError, match="needs --curated"):
        cli.main(arguments(tmp_path, "--finalize-only"), spark)
