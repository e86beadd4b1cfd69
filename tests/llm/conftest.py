import random

import pytest


@pytest.fixture
def rows(spark):
    """Documents from (doc_id, text) pairs, over several partitions."""
    def make(pairs, parts=3):
        return spark.createDataFrame(list(pairs), "doc_id bigint, text string").repartition(parts)
    return make


@pytest.fixture
def rng():
    return random.Random(7)
