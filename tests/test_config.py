import dataclasses

import pytest

from telestream.config import REJECT, SPLIT, TRUNCATE, ConfigError, KeySource, ReaderConfig, WriterConfig, env_int

W = WriterConfig(stream_name="s", region="r")
R = ReaderConfig(stream_name="s", region="r")


def test_defaults_are_valid():
    assert W.validate().strategy == "random"
    assert R.validate().worker_id.startswith("otelcol-")


@pytest.mark.parametrize(
    "change",
    [
        {"stream_name": ""}, {"region": ""}, {"encoding": "x"}, {"compression": "lz4"}, {"max_record_size": 0}, {"max_records": 0}, {"max_bytes": 10},
        {"strategy": "tag_hash"}, {"strategy": "tag_hash", "tags": ("a",), "keys": (KeySource(name="a"),)}, {"strategy": "tag_hash", "keys": (KeySource(),)},
        {"strategy": "tag_hash", "keys": (KeySource("metric_name", "x"),)}, {"strategy": "tag_hash", "keys": (KeySource("span", "x"),)}, {"strategy": "tag_hash", "keys": (KeySource(name="x", regex="("),)},
        {"hash": "md5"}, {"legacy_policy": "reject"}, {"policies": ()}, {"policies": (SPLIT, TRUNCATE)}, {"policies": (REJECT, SPLIT)}, {"policies": ("drop",)}, {"max_attempts": 0}, {"max_attribute_value_bytes": 0}, {"strategy": "round_robin"},
    ],
)
def test_writer_rejects(change):
    with pytest.raises(ConfigError):
        dataclasses.replace(W, **change).validate()


@pytest.mark.parametrize("change", [{"poll_interval": 0}, {"max_records": 10_001}, {"lease_backend": "file"}, {"lease_backend": "dynamodb"}, {"lease_duration": 0}, {"heartbeat_interval": 30_000}, {"discovery_interval": 0}])
def test_reader_rejects(change):
    with pytest.raises(ConfigError):
        dataclasses.replace(R, **change).validate()


def test_env_int():
    assert [env_int(v, 7) for v in ("3", "", None, "x")] == [3, 7, 7, 7]
