from tests.conftest import SF001
from vitalmart.__main__ import main


def test_cli_list(capsys):
    assert main(["list"]) == 0
    assert "q_ws_region_rank" in capsys.readouterr().out.split()


def test_cli_query(spark, capsys):
    assert main(["query", "q_dim_date", "--sf", SF001, "--show", "3"]) == 0
    assert "date_year" in capsys.readouterr().out
    assert main(["query", "no_such_query", "--sf", SF001]) == 2
