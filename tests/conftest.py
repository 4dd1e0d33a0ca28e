import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from corpuslens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    yield session
    session.stop()
