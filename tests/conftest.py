import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from couriermart.session import build_session, release_scratch  # noqa: E402
from support import TESTDATA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[*]",
        "couriermart-tests",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("TEST_DRIVER_MEMORY", "8g"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"
