import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from windlass.session import build_session
    s = build_session("local[*]", 4, app_name="windlass-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def small_span(spark):
    """Force many blocks per group so cross-block prefixes are exercised."""
    spark.conf.set("windlass.scan.blockSpan", "3")
    yield 3
    spark.conf.unset("windlass.scan.blockSpan")


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="windlass-test-")
