import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerofolio.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture
def one(spark):
    """Value of a column expression over a single row."""
    from pyspark.sql import functions as F

    def value(make, *texts):
        row = spark.createDataFrame([tuple(texts) or ("",)], ", ".join(f"c{i} string" for i in range(max(1, len(texts)))))
        return row.select(make(*[F.col(c) for c in row.columns][: max(1, len(texts))])).first()[0]

    return value
