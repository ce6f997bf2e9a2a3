import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import get_spark
    from kestrel.session import checkpoint_dir
    s = get_spark("local[4]", shuffle_partitions=4)
    checkpoint_dir(s)          # unset in tests: a private folder
    yield s
