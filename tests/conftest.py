import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import check  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = check.session()
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return make
