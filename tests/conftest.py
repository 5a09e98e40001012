from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from ionloom.session import local_session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session(4, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session
