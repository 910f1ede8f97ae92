"""Session helpers: shared folder, scratch paths, byte sizes, split bounds."""

import os

from rampart.session import scratch_path, shared_dir
from rampart.sources.files import parse_bytes, split_bound


def test_parse_bytes():
    assert parse_bytes("134217728") == 134217728
    assert parse_bytes("128m") == 128 << 20
    assert parse_bytes("64MB") == 64 << 20
    assert parse_bytes("1g") == 1 << 30
    assert parse_bytes("512k") == 512 << 10


def test_shared_dir_uses_session_setting(spark):
    d = shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and configured.rstrip("/").endswith(d.rsplit("/", 1)[-1])
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d + "/rampart/x-")


def test_split_bound(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for i in range(3):
        with open(f"{tmp_dir}/in/f{i}.csv", "w") as fh:
            fh.write("id\n" + "1\n" * 1000)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        bound = split_bound(spark, [f"{tmp_dir}/in"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    total = 3 * len("id\n" + "1\n" * 1000)
    assert bound == 3 + -(-total // 1024)
