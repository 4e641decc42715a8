import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lendspark.session import get_session
    s = get_session("local[4]", app="lendspark-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lendspark-test-ckpt-"))
    yield s
    s.stop()


def txns_df(spark, rows, with_category=True):
    """rows: (customer_id, 'YYYY-MM-DD', type, amount[, category])"""
    if with_category:
        df = spark.createDataFrame(rows, "customer_id string, d string, txn_type string, amount double, category string")
    else:
        df = spark.createDataFrame(rows, "customer_id string, d string, txn_type string, amount double")
    return df.selectExpr("*", "to_date(d) as txn_date").drop("d")
