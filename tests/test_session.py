from types import SimpleNamespace

import pytest

from namewire.session import shared_root


class Unset:
    """A session without a shared folder, on a cluster."""

    conf = SimpleNamespace(get=lambda key, default=None: default)
    sparkContext = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Unset)


def test_local_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
