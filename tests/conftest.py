import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from packetflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.exists(path):
        pytest.skip("no test data")
    return path


@pytest.fixture(scope="session")
def shared_models(spark):
    """One read model for all queries that only read it: queries themselves build one each."""
    from packetflow.plans import queries

    built = {}

    def once(make):
        def get(spark, sf_dir):
            if (make, sf_dir) not in built:
                built[make, sf_dir] = make(spark, sf_dir)
            return built[make, sf_dir]

        return get

    kept = queries.streamed_model, queries.stored_model
    queries.streamed_model, queries.stored_model = map(once, kept)
    yield
    queries.streamed_model, queries.stored_model = kept
