import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    conf = {"spark.checkpoint.dir": str(shared), "spark.sql.shuffle.partitions": "4"}
    return local_session("lexspark-tests", "4", **conf)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
