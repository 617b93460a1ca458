from __future__ import annotations

import pytest

from wardmart import cli
from wardmart.sources import files
from wardmart.sources.targets import JdbcTarget, ParquetTarget

FOLDERS = ["--input", "i", "--bronze", "b", "--silver", "s"]


def settings(*argv, environ=None):
    return cli.settings_from(cli.parser().parse_args(["all", *FOLDERS, *argv]), environ or {})


def test_parquet_settings():
    s = settings("--gold", "g", "--as-of", "2024-01-01", "--id-type", "bigint",
                 "--extra-table", "rooms")
    assert s.target == ParquetTarget("g")
    assert (s.as_of, s.id_type, s.extra_tables) == ("2024-01-01", "bigint", ("rooms",))
    assert s.load_mode == "insert_if_absent" and s.staging_root is None


def test_jdbc_settings_take_the_password_from_the_environment():
    s = settings("--jdbc-url", "jdbc:x://h/db", "--jdbc-driver", "x.Driver",
                 environ={"WARDMART_JDBC_USER": "u", "WARDMART_JDBC_PASSWORD": "p"})
    assert isinstance(s.target, JdbcTarget)
    assert s.target.connection.options("t") == {
        "url": "jdbc:x://h/db", "dbtable": "t", "driver": "x.Driver", "user": "u",
        "password": "p"}


@pytest.mark.parametrize("argv", [[], ["--gold", "g", "--jdbc-url", "u"],
                                  ["--gold", "g", "--load-mode", "merge"]])
def test_wrong_arguments(argv):
    with pytest.raises(SystemExit):
        settings(*argv)


def test_calendar_stage(spark, tmp_path):
    argv = ["calendar", "--input", "i", "--bronze", "b", "--silver", str(tmp_path),
            "--gold", "g", "--calendar-start", "2024-01-01", "--calendar-end", "2024-01-31"]
    cli.main(argv)
    cli.main([*argv[:-1], "2024-12-31"])
    assert files.read_parquet(spark, str(tmp_path / "dim_date")).count() == 31
