import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tablens.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def micro(spark):
    """Edge-case micro tables (FIXTURES.md §3), built in the test process."""
    import math
    nan = float("nan")
    nulls = spark.createDataFrame(
        [(1, 1.0, 2.0, "x"), (2, None, 3.0, "x"), (3, 3.0, None, None), (4, nan, 5.0, "y"),
         (5, 5.0, 6.0, "y"), (6, 6.0, 7.0, "y")], "id int, a double, b double, g string")
    constant = spark.createDataFrame([(i, 5.0, float(i)) for i in range(1, 11)], "id int, a double, b double")
    zero_div = spark.createDataFrame([(1, 1.0, 0.0), (2, -1.0, 0.0), (3, 0.0, 0.0), (4, 5.0, 1.0), (5, 50.0, 2.0)],
                                     "id int, a double, b double")
    dups = spark.createDataFrame([(1, 1.0, "a"), (2, 1.0, "a"), (3, None, None), (4, None, None), (5, 2.0, "b")],
                                 "k int, a double, g string")
    mixed = spark.createDataFrame([(1, "1"), (2, "x"), (3, None), (4, "1d"), (5, "NaN"), (6, "1e3")],
                                  "id int, s string")
    return dict(nulls=nulls, constant=constant, zero_div=zero_div, dups=dups, mixed=mixed, math=math)
