import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame of rows in a few partitions."""
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make
