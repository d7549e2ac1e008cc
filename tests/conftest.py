import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from shelfmark.session import local_session  # noqa: E402

TESTDATA = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, app="shelfmark-tests")
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    yield session


@pytest.fixture(scope="session")
def shop(spark):
    from shelfmark.plans.queries import shop_of

    return shop_of(spark, str(TESTDATA))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
