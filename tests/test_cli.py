"""The command line: arguments to settings, and one job in a process of its own."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from oreflow.__main__ import check, main, parser, settings_of, topic_of
from oreflow.sources import Topic, write_topic

REPO = Path(__file__).resolve().parents[1]


def test_settings_of_an_iceberg_job():
    args = parser().parse_args(
        "bronze --servers host:9092 --format iceberg --catalog rest --catalog-uri http://c --root s3://lake "
        "--s3-endpoint http://s --packages --conf spark.sql.shuffle.partitions=4000 --topic-option a=b".split()
    )
    settings = settings_of(args)
    assert settings["spark.jars.packages"].count(":") == 6
    assert settings["spark.sql.catalog.rest.uri"] == "http://c"
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://s"
    assert settings["spark.sql.shuffle.partitions"] == "4000"
    assert topic_of(args).options == {"a": "b"}


def test_iceberg_needs_a_catalog():
    with pytest.raises(SystemExit):
        settings_of(parser().parse_args(["gold", "--format", "iceberg"]))


def test_unknown_job_is_refused():
    with pytest.raises(SystemExit):
        main(["platinum"])


def test_tables_need_a_root():
    with pytest.raises(SystemExit):
        main(["gold"])


def test_tables_need_a_format(capsys):
    with pytest.raises(SystemExit, match="format"):
        main(["gold", "--root", "/lake"])


def test_what_scales_can_be_set():
    args = parser().parse_args(
        "silver --format parquet --root /lake --salts 500 --state-partitions 4000 --spread 30 --keep-seconds 60".split()
    )
    assert (args.salts, args.spread, args.keep_seconds) == (500, 30, 60)
    assert settings_of(args)["spark.sql.shuffle.partitions"] == "4000"


def test_check_tells_whether_messages_come_back(spark, tmp_path, capsys):
    assert check(spark, Topic("t", path=str(tmp_path / "topic"))) == 0
    assert "3 of 3 messages came back from t" in capsys.readouterr().out
    assert check(spark, Topic("t", path=str(tmp_path / "lost"), options={"pathGlobFilter": "nothing*"})) == 1


def test_bronze_in_a_process_of_its_own(spark, tmp_path):
    topic = Topic("t", path=str(tmp_path / "topic"))
    write_topic(spark.createDataFrame([("k", '{"ticker": "a"}')], "key string, value string"), topic)
    command = [sys.executable, "-m", "oreflow", "bronze", "--topic", "t", "--path", topic.path, "--once"]
    command += ["--master", "local[2]", "--format", "parquet", "--root", str(tmp_path / "lake")]
    env = os.environ | {"PYTHONPATH": str(REPO)}
    done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    assert list((tmp_path / "lake/bronze/trades/ticker=A").rglob("*.parquet"))


def test_state_is_laid_out_anew_from_the_command_line(spark, tmp_path):
    """Bronze until idle, silver once, its state in more partitions, and silver again in the new generation."""
    topic = Topic("t", path=str(tmp_path / "topic"))
    value = '{"trade_id":"%s","portfolio_id":"p","ticker":"a","side":"buy","quantity":1,"price":1,"fees":0,"trade_timestamp":"2024-01-01"}'
    write_topic(spark.createDataFrame([(x, value % x) for x in "ab"], "key string, value string"), topic)
    base = ["--path", topic.path, "--root", str(tmp_path / "lake"), "--format", "parquet", "--master", "local[2]"]
    base += ["--conf", "spark.ui.enabled=false", "--conf", f"spark.sql.warehouse.dir={tmp_path / 'wh'}"]

    def run(*args):
        command = [sys.executable, "-m", "oreflow", args[0], *base, *args[1:]]
        return subprocess.run(command, capture_output=True, text=True, cwd=REPO, env={**os.environ, "PYTHONPATH": str(REPO)})

    assert run("bronze", "--until-idle").returncode == 0
    assert run("silver", "--once", "--attempts", "2", "--state-partitions", "2").returncode == 0
    made = run("repartition", "--state-partitions", "3")
    assert made.returncode == 0 and "--generation 2" in made.stdout, made.stderr[-2000:]
    write_topic(spark.createDataFrame([(x, value % x) for x in "bc"], "key string, value string"), topic)
    assert run("bronze", "--once").returncode == 0
    assert run("silver", "--once", "--generation", "2").returncode == 0
    ids = [r.trade_id for t in ("trades", "trades_g2") for r in spark.read.parquet(f"{tmp_path}/lake/silver/{t}").collect()]
    assert sorted(ids) == ["a", "b", "c"]
