import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from querywright import session  # noqa: E402
from querywright.sources.tables import Tables  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = session.build("tests", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "8g",
                                                 "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, FOLDER)
