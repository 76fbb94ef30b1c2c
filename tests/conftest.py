import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from spanwatch.session import local_session

    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("stages")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
