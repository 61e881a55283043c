import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from chronofold.session import get_session  # noqa: E402
from chronofold.sources.scratch import new_folder  # noqa: E402
from chronofold.sources.tables import prepare_schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def schema(spark):
    name = "t_" + uuid.uuid4().hex
    prepare_schema(spark, name, location=new_folder(spark, "tests"))
    return name


@pytest.fixture
def small_conf(spark):
    """Set session options for one test."""
    before = {}

    def setting(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield setting
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
