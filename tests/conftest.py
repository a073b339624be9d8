import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # A few rows per plan: compiling generated code would cost more than running without it.
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.sql.codegen.wholeStage": "false",
        "spark.sql.codegen.factoryMode": "NO_CODEGEN",
    }
    session = build_session("local[4]", "tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
