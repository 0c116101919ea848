import logging
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from brassledger.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    logging.getLogger("py4j").setLevel(logging.ERROR)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"
