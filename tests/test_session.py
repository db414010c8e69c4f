import subprocess
import sys
from types import SimpleNamespace

import pytest
from conftest import ROOT

from vigia.session import SQL_SETTINGS, configure, scratch_path, scratch_root


def session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_the_named_shared_folder():
    named = session("spark://h:7077", **{"spark.checkpoint.dir": "hdfs://n/shared/"})
    assert scratch_root(named) == "hdfs://n/shared"
    assert scratch_path(named, "x") != scratch_path(named, "x")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session("spark://h:7077"))


def test_local_sessions_fall_back_to_a_temporary_folder(spark):
    assert scratch_root(spark) == scratch_root(spark)


def test_setting_is_read_from_a_real_session(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from vigia.session import scratch_root\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        f".config('spark.checkpoint.dir', '{tmp_path}/shared').getOrCreate()\n"
        "print('root', scratch_root(s))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert f"root {tmp_path}/shared" in out.stdout.replace("file:", "")


def test_settings_are_applied(spark):
    configure(spark)
    assert {k: spark.conf.get(k) for k in SQL_SETTINGS} == SQL_SETTINGS
