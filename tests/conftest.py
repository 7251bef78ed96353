import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.join(HERE, "..")]

from compare import session  # noqa: E402

from airloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = configure(session())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


def stamps(spark, rows, schema, *columns):
    """DataFrame whose named text columns become timestamps."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})
