import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tvlens.session import build_session

    s = build_session(
        master="local[4]",
        shuffle_partitions=8,
        app_name="tvlens-tests",
        extra_conf={
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "4000",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tvlens-test-ckpt-"),
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tvlens-test-warehouse-"),
        },
    )
    yield s
    s.stop()
