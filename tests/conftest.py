import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from bizlens.session import build_session

    ckpt = tempfile.mkdtemp(prefix="bizlens-test-ckpt-")
    s = build_session("local[4]", app="bizlens-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g",
                             "spark.sql.warehouse.dir": os.path.join(ckpt, "warehouse")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


def col_values(spark, fn, values, dtype="string"):
    """Apply a Column builder to a one-column frame and return the results in input order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v")).alias("o"), "i").orderBy("i").collect()]
