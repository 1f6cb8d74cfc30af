import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tiermill import session
    s = session.build("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tiermill-test-"),
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tiermill-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def root(spark):
    from tiermill.plans.catalog import run_root
    return run_root(spark)
