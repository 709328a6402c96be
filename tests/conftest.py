import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from namewire.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", conf={
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def article(stamp="20240105130000", names="", serial=1, fields=27, key=None):
    cells = [""] * fields
    cells[0] = key or f"{stamp}-{serial}"
    cells[1] = stamp
    if fields > 23:
        cells[23] = names
    return "\t".join(cells)


def rows(df):
    return sorted(tuple(r) for r in df.collect())
