import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from kerbside.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session("tests", "4", **{"spark.checkpoint.dir": str(folder), "spark.sql.shuffle.partitions": "2"})
    yield session
    session.stop()
