import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session, clean_scratch
    scratch = tempfile.mkdtemp(prefix="ledgerline-tests-")
    s = build_session("local[4]", app_name="ledgerline-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": scratch})
    yield s
    clean_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from ledgerline.session import new_scratch_dir
    path = new_scratch_dir(spark, "test")
    os.makedirs(path)
    return path
