import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8,
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()
