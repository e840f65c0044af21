import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ledgerloom-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def catalog_paths(tmp_path_factory):
    from tests.helpers import write_documents

    return write_documents(tmp_path_factory.mktemp("catalog"))


@pytest.fixture(scope="session")
def catalog(spark, catalog_paths):
    from ledgerloom.sources.catalog import load_catalog

    return load_catalog(spark, catalog_paths)
