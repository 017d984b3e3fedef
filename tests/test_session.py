import pytest

from daymill import session


class Conf:
    def __init__(self, **settings):
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name, default)


class Session:
    def __init__(self, master, shared=None):
        self.conf = Conf(**{"spark.master": master, **({"spark.checkpoint.dir": shared} if shared else {})})


def test_the_cluster_names_the_shared_folder():
    assert session.shared_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("yarn"))


def test_local_runs_make_their_own():
    made = session.shared_dir(Session("local[2]"))
    assert made and made == session.shared_dir(Session("local[2]"))


def test_staged_rows_are_dropped(spark):
    with session.staged(spark.range(5), "x") as rows:
        assert rows.count() == 5
        (path,) = {f.rsplit("/", 1)[0] for f in rows.inputFiles()}
    assert spark.conf.get("spark.checkpoint.dir") in path
    assert not spark.catalog.listTables(session.SCRATCH_SCHEMA)
