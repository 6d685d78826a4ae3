import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from docketweave.session import local_session

    session = local_session(4, 4, driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def as_rows():
    return rows
