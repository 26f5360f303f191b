"""The shared folder: read from spark.checkpoint.dir; where it is unset, a local session
registers a private folder and a cluster's raises. Submitted settings are kept."""
import os
import subprocess
import sys

import pytest

from rentalmart import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):  # noqa: A003 - mirrors RuntimeConfig.set
        raise AssertionError("static setting must not be modified")


class _Context:
    def __init__(self, value, master="local[2]"):
        self.conf, self.dir, self.master = _Conf(value), None, master

    def getConf(self):  # noqa: N802 - SparkContext API
        return self.conf

    def getCheckpointDir(self):  # noqa: N802
        return self.dir

    def setCheckpointDir(self, d):  # noqa: N802
        self.dir = d


class _Session:
    def __init__(self, value, master="local[2]"):
        self.conf, self.sparkContext = _Conf(value), _Context(value, master)


def test_configured_folder_is_used():
    s = _Session("/shared/ckpt")
    assert session.shared_dir(s) == "/shared/ckpt"
    assert s.sparkContext.dir == "/shared/ckpt"


def test_unset_folder_falls_back_without_touching_the_setting():
    s = _Session(None)
    first = session.shared_dir(s)
    assert first.startswith("/") and s.sparkContext.dir == first
    assert session.shared_dir(s) == first  # stable for the session


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"])
def test_unset_folder_on_a_cluster_is_an_error(master):
    s = _Session(None, master)
    with pytest.raises(session.SharedFolderMissing):
        session.fresh_path(s, "x")
    assert session.shared_dir(_Session("/shared", master)) == "/shared"


def test_submitted_settings_are_kept():
    code = ("from rentalmart.session import get_session; s = get_session('local[1]'); "
            "print('GOT', s.conf.get('spark.sql.autoBroadcastJoinThreshold'), s.conf.get('spark.sql.files.maxPartitionBytes'), "
            "s.conf.get('spark.sql.session.timeZone'))")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.autoBroadcastJoinThreshold=-1 "
                                               "--conf spark.sql.files.maxPartitionBytes=268435456 pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "GOT -1 268435456 UTC" in out.stdout


def test_exists_asks_the_file_system(spark, scratch):
    assert not session.exists(spark, f"{scratch}/none")
    os.mkdir(f"{scratch}/empty")
    assert not session.exists(spark, f"{scratch}/empty")
    with open(f"{scratch}/file", "w") as f:
        f.write("x")
    assert session.exists(spark, f"{scratch}/file") and session.exists(spark, scratch)
    session.discard(spark, f"{scratch}/file")
    assert not session.exists(spark, f"{scratch}/file")
