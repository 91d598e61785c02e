"""The shared folder and how the package reaches the executors."""

import zipfile

import pytest

from tidewatch import session


class Elsewhere:
    """A session of a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: Elsewhere.conf)
        added: list = []
        addPyFile = added.append

        class _jsc:
            class sc:
                class getCheckpointDir:
                    isDefined = staticmethod(lambda: False)


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere)


def test_masters():
    assert all(map(session.is_local, ("local", "local[8]", "local[*]", "local[2, 3]")))
    assert not any(map(session.is_local, ("local-cluster[3,2,1000]", "yarn", "spark://host:7077", "k8s://x")))


def test_the_package_is_shipped():
    session.ship_package(Elsewhere)
    names = zipfile.ZipFile(Elsewhere.sparkContext.added[0]).namelist()
    assert "tidewatch/session.py" in names and "tidewatch/operators/nearest.py" in names
