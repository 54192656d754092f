import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from costweave.session import clean_scratch, local_spark
    s = local_spark()
    yield s
    clean_scratch(s)
    s.stop()
