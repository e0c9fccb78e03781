import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from clickspark.session import ensure_checkpoint_dir, get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s
    from clickspark.session import drop_stage_tables
    drop_stage_tables(s)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF
