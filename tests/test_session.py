import os

import pytest

from star_marts import session
from star_marts.session import drop_scratch, scratch_root, stage


@pytest.fixture
def shared(spark, tmp_path):
    """The session names a shared folder."""
    before = spark.conf.get("spark.checkpoint.dir", None)
    key = "spark.checkpoint.dir"
    # A core setting cannot be changed through the session, so its reader is replaced.
    original = spark.conf.get
    spark.conf.get = lambda name, *rest: str(tmp_path) if name == key else original(name, *rest)
    yield tmp_path
    spark.conf.get = original
    assert spark.conf.get(key, None) == before


def test_stage_uses_the_shared_folder_and_is_dropped(spark, shared):
    assert scratch_root(spark) == str(shared)
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert [name.split("-")[0] for name in os.listdir(shared)] == ["numbers"]
    assert drop_scratch(spark) >= 1
    assert os.listdir(shared) == []


def test_only_a_local_master_may_go_without(spark, monkeypatch):
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, name, default=None):
            return self.master if name == "spark.master" else default

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    monkeypatch.setattr(session, "_local_scratch", None)
    folder = scratch_root(Session("local[2]"))
    assert os.path.isdir(folder)
    assert scratch_root(Session("local[2]")) == folder
    with pytest.raises(ValueError):
        scratch_root(Session("spark://head:7077"))
