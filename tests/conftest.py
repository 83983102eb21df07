import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from oracle_check import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(cpus=4, memory="4g")
    yield spark
    spark.stop()
