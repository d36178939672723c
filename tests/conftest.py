import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from oreflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "oreflow-tests",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        },
        master="local[8]",
        log_level="ERROR",
    )
    yield session
    session.stop()


@pytest.fixture
def warehouse(tmp_path):
    """Tables of one test, in namespaces of their own."""
    from oreflow.plans import Warehouse

    return Warehouse(str(tmp_path / "warehouse"), suffix=f"_{abs(hash(str(tmp_path))):x}")
