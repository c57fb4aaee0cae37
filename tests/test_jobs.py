"""Settings and arguments of the jobs."""

import pytest

from loghaven import jobs


def test_settings_from_the_environment():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "b:1", "KAFKA_STARTING_OFFSETS": "latest", "MAX_OFFSETS_PER_TRIGGER": "2000",
           "KMEANS_K": "5", "ANOMALY_THRESHOLD": "2.5"}
    assert jobs.kafka_settings(env, ("t",)) == {
        "bootstrap_servers": "b:1", "topics": ("t",), "starting_offsets": "latest", "max_offsets_per_trigger": 2000,
    }
    assert jobs.detector_settings(env) == {"k": 5, "threshold": 2.5}
    assert jobs.kafka_settings({}, ("t",))["max_offsets_per_trigger"] is None
    assert jobs.detector_settings({}) == {"k": 8, "threshold": 3.0}


def test_arguments():
    args = jobs.arguments().parse_args(["log-etl", "--lake", "/l", "--checkpoint", "/c"])
    assert (args.job, args.lake, args.checkpoint, args.database) == ("log-etl", "/l", "/c", "siem")
    with pytest.raises(SystemExit):
        jobs.arguments().parse_args(["log-etl"])


def test_merge_logs(spark, tmp_path, capfd, folder):
    for d, text in (("a", "1\n2\n"), ("b", "3\n")):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.log").write_text(text)
    jobs.merge_logs(spark, str(tmp_path), folder)
    assert sorted(r.value for r in spark.read.text(folder).collect()) == ["1", "2", "3"]
    out = capfd.readouterr().out
    assert "x.log" in out
